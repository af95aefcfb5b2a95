"""File listings as DataFrames and the discovery operators over them.

A listing is a DataFrame ``(path, length, mtime)`` — on a cluster from the
``binaryFile`` source with the content column pruned (only file metadata is
read), in tests from any table.  Directories are the ancestors of listed
files, so every discovery step is a projection, aggregate or semi-join over
the listing instead of per-path filesystem calls on the driver."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marisnow.schemas import (
    CROPS_METADATA_SUFFIX,
    DEFAULT_METADATA_PATTERNS,
    ECOTAXA_METADATA_NAME,
    ECOTAXA_SUFFIX,
)


def file_listing(spark: SparkSession, root: str, glob: str | None = None,
                 recursive: bool = True) -> DataFrame:
    """(path, length, mtime) of every file under ``root``.  Only the file
    metadata columns are selected, so the binary content is never read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(root)
    return df.select(F.regexp_replace("path", r"^file:(//)?", "").alias("path"),
                     F.col("length"), F.col("modificationTime").alias("mtime"))


def name_of(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract(c, r"([^/]*)$", 1)


def parent_of(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract(c, r"^(.*)/[^/]*$", 1)


def directories(listing: DataFrame) -> DataFrame:
    """(dir, parent, name) for every ancestor directory of a listed file."""
    parts = F.split(F.col("path"), "/")
    prefixes = F.transform(F.sequence(F.lit(2), F.size(parts) - 1),
                           lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    d = listing.select(F.explode(prefixes).alias("dir")).filter(F.col("dir") != "").distinct()
    return d.select("dir", parent_of("dir").alias("parent"), name_of("dir").alias("name"))


def _profiles_name(c) -> Column:
    return F.col(c).contains("Profiles")


def resolve_profile_bases(listing: DataFrame, source_root: str) -> DataFrame:
    """Directories that directly contain profile folders, as (base).

    root named *Profiles* -> itself; else every child named *Profiles*;
    else for each child directory the first (sorted) grandchild named
    *Profiles*; children without one are skipped.  Missing root -> empty."""
    root = source_root.rstrip("/") or "/"
    dirs = directories(listing)
    exists = dirs.filter(F.col("dir") == root)
    if "Profiles" in root.rsplit("/", 1)[-1]:
        return exists.select(F.col("dir").alias("base"))
    children = dirs.filter(F.col("parent") == root)
    prof_children = children.filter(_profiles_name("name"))
    any_child = F.coalesce(prof_children.agg(F.count(F.lit(1))).scalar(), F.lit(0))
    case2 = prof_children.select(F.col("dir").alias("base")).filter(any_child > 0)
    grand = (dirs.alias("g").join(children.select(F.col("dir").alias("cdir")), F.col("g.parent") == F.col("cdir"))
             .filter(_profiles_name("g.name")))
    first = grand.groupBy("cdir").agg(F.min("g.dir").alias("base"))
    case3 = first.select("base").filter(any_child == 0)
    return case2.union(case3).distinct()


def list_profiles(listing: DataFrame, bases: DataFrame) -> DataFrame:
    """(base, profile, profile_dir): children of a base that hold
    ``<p>/<p>_Results/EcoTaxa``."""
    dirs = directories(listing)
    eco = dirs.filter(F.col("name") == "EcoTaxa").select(
        parent_of(parent_of("dir")).alias("profile_dir"), name_of(parent_of("dir")).alias("results"))
    eco = eco.filter(F.col("results") == F.concat(name_of("profile_dir"), F.lit("_Results")))
    prof = eco.select("profile_dir", parent_of("profile_dir").alias("base"),
                      name_of("profile_dir").alias("profile")).distinct()
    return prof.join(bases, "base", "left_semi").select("base", "profile", "profile_dir")


def glob_to_regex(pattern: str) -> str:
    """fnmatch-style glob (``* ? [seq] [!seq]``) as an anchored Java regex."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "*":
            out.append("[^/]*")
        elif ch == "?":
            out.append("[^/]")
        elif ch == "[":
            j = pattern.find("]", i + 1)
            if j == -1:
                out.append(r"\[")
            else:
                body = pattern[i + 1:j]
                if body.startswith("!"):
                    body = "^" + body[1:]
                out.append("[" + body.replace("\\", "\\\\") + "]")
                i = j
        else:
            out.append(re.escape(ch))
        i += 1
    return "^" + "".join(out) + "$"


def pick_metadata_file(listing: DataFrame, profiles: DataFrame, choice: str = "auto",
                       patterns: Sequence[str] | None = None) -> DataFrame:
    """(profile_dir, profile, path): at most one metadata file per profile.

    Exact names first, in choice order — auto/crops: crops csv, ecotaxa
    metadata tsv, profile tsv; ecotaxa: profile tsv, metadata tsv, crops csv —
    then the user glob patterns, pattern-major, names in sorted order."""
    if choice not in {"auto", "crops", "ecotaxa"}:
        raise ValueError("metadata_choice must be one of: auto, crops, ecotaxa")
    patterns = tuple(patterns) if patterns is not None else DEFAULT_METADATA_PATTERNS
    files = listing.select("path", parent_of("path").alias("eco_dir"), name_of("path").alias("fname"))
    prof = profiles.select("profile_dir", "profile",
                           F.concat("profile_dir", F.lit("/"), "profile", F.lit("_Results/EcoTaxa")).alias("eco_dir"))
    j = files.join(prof, "eco_dir")
    crops = F.concat("profile", F.lit(CROPS_METADATA_SUFFIX))
    eco_tsv = F.concat("profile", F.lit(ECOTAXA_SUFFIX))
    meta_tsv = F.lit(ECOTAXA_METADATA_NAME)
    order = [eco_tsv, meta_tsv, crops] if choice == "ecotaxa" else [crops, meta_tsv, eco_tsv]
    prio = F.when(F.col("fname") == order[0], 0).when(F.col("fname") == order[1], 1) \
        .when(F.col("fname") == order[2], 2)
    for k, pat in enumerate(patterns):
        prio = prio.when(F.col("fname").rlike(glob_to_regex(pat)), 10 + k)
    ranked = j.withColumn("_prio", prio).filter(F.col("_prio").isNotNull())
    best = ranked.groupBy("profile_dir", "profile").agg(
        F.min(F.struct("_prio", "fname", "path")).alias("_b"))
    return best.select("profile_dir", "profile", F.col("_b.path").alias("path"))


def discover_metadata(listing: DataFrame, source_root: str, choice: str = "auto",
                      patterns: Sequence[str] | None = None) -> DataFrame:
    """Sorted unique metadata file paths selected from all profiles."""
    bases = resolve_profile_bases(listing, source_root)
    profiles = list_profiles(listing, bases)
    return pick_metadata_file(listing, profiles, choice, patterns).select("path").distinct()


def image_exists(df: DataFrame, listing: DataFrame, path_col: str, keep: bool = True) -> DataFrame:
    """Rows whose file is listed (left-semi), or is missing (left-anti)."""
    files = listing.select(F.col("path").alias("_lp")).distinct()
    how = "left_semi" if keep else "left_anti"
    return df.join(files, F.col(path_col) == F.col("_lp"), how)


def resolve_mask_dir(paths: DataFrame, listing: DataFrame, path_col: str = "image_path",
                     mask_names: Sequence[str] | None = None) -> DataFrame:
    """Most voted sibling mask folder of all paths' crop folders: (mask_dir,
    votes), at most one row.  Paths are counted per crop folder first, so
    only folders are exploded and joined."""
    from marisnow.schemas import MASK_DIR_NAMES
    names = list(mask_names or MASK_DIR_NAMES)
    folders = (paths.select(parent_of(path_col).alias("crop_dir"))
               .filter(F.lower(name_of("crop_dir")).isin("deconv_crops", "crops"))
               .groupBy("crop_dir").agg(F.count(F.lit(1)).alias("n")))
    cand = folders.select("n", F.explode(F.array(*[
        F.concat(parent_of("crop_dir"), F.lit("/" + n)) for n in names])).alias("mask_dir"))
    existing = directories(listing).select(F.col("dir").alias("mask_dir"))
    votes = cand.join(existing, "mask_dir", "left_semi").groupBy("mask_dir").agg(F.sum("n").alias("votes"))
    return votes.orderBy(F.desc("votes"), "mask_dir").limit(1)


def resolve_mask_path(df: DataFrame, listing: DataFrame, mask_dir: str, path_col: str = "image_path",
                      suffix: str = "", extension: str = ".png", out: str = "mask_path") -> DataFrame:
    """``<mask_dir>/<image stem><suffix><extension>`` when that file is
    listed, else null (a left join against the listing)."""
    stem = F.regexp_extract(name_of(path_col), r"^(.+?)(\.[^.]*)?$", 1)
    cand = F.concat(F.lit(mask_dir.rstrip("/") + "/"), stem, F.lit(suffix + extension))
    files = listing.select(F.col("path").alias("_mp")).distinct()
    j = df.withColumn("_cand", cand).join(files, F.col("_cand") == F.col("_mp"), "left")
    return j.withColumn(out, F.col("_mp")).drop("_cand", "_mp")
