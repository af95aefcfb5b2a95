"""Per-profile metadata readers (comma CSV / tab TSV) and their union.

Files are read once, as lines of splits, so a large file is parsed by many
tasks although quoted cells may hold line breaks:

* a line is a function of whether it begins inside a quoted cell (it keeps
  that, turns it round, or ends in a state of its own).  Functions are
  composed by running sums, first in every split, then over the splits of a
  file, which tells where records begin;
* records of one line are parsed where they are, only the lines of longer
  ones are brought together;
* each record is parsed by ``from_csv`` and its cells take the names of its
  file's header.  The distinct headers, not the files, are read on the driver,
  as they make the schema.

Every cell is read as text, pandas' NA spellings become null, and provenance
(``_source_file``, ``_block``, ``_row``) gives the (file, row) order that
"keep first" semantics need.  A file whose last quoted cell is not closed is
unreadable and left out, as a file without any line is."""

from __future__ import annotations

import csv
import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from marisnow.operators.graph import _cut
from marisnow.schemas import NA_TOKENS

log = logging.getLogger(__name__)

TAG_RE = r"^\[[A-Za-z]\]$"
TAG_RATIO = 0.6


def _sep_for(path: str) -> str:
    return "\t" if path.lower().endswith(".tsv") else ","


# ------------------------------------------------------------------ lines ----

def _opens(text: Column, sep: Column) -> Column:
    """Whether a line that begins outside of quotes ends inside of them: a
    quote opens only at the start of a cell, a doubled one is content."""
    closed = lambda s: F.regexp_replace(text, rf'(^|{s})"[^"]*+(?:""[^"]*+)*+"', "$1")
    return F.when(sep == "\t", closed("\t").rlike('(^|\t)"')).otherwise(closed(",").rlike('(^|,)"'))


def _closes(text: Column, sep: Column) -> Column:
    """The same for a line that begins inside of quotes."""
    end = r'^[^"]*+(?:""[^"]*+)*+"'
    # what follows the closing quote up to the separator is content: a letter in front keeps it from opening a cell
    return F.when(~text.rlike(end), F.lit(True)).otherwise(_opens(F.regexp_replace(text, end, "x"), sep))


def _lines(spark: SparkSession, paths: Sequence[str], sep: str | None) -> DataFrame:
    """(file, block, row, value, sep, flip, reset): the lines of all files;
    ``flip`` is 1 where a line turns the state round, ``reset`` the state it
    ends in whatever came before (null: none)."""
    name = F.regexp_replace(F.col("_metadata.file_path"), r"^file:/*", "/")
    t = (spark.read.option("ignoreCorruptFiles", "true").option("lineSep", "\n").text(list(paths))
         .select(name.alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), "value"))
    by_name = F.when(F.lower("file").endswith(".tsv"), "\t").otherwise(",")
    t = t.withColumn("sep", F.lit(sep) if sep else by_name)
    quoted = F.col("value").contains('"')
    t = (t.withColumn("_0", F.when(quoted, _opens(F.col("value"), F.col("sep"))).otherwise(F.lit(False)))
         .withColumn("_1", F.when(quoted, _closes(F.col("value"), F.col("sep"))).otherwise(F.lit(True))))
    return _cut(t.withColumn("flip", (F.col("_0") & ~F.col("_1")).cast("int"))
                .withColumn("reset", F.when(F.col("_0") == F.col("_1"), F.col("_0").cast("int"))).drop("_0", "_1"))


def _state(entry: Column, flips: Column, reset: Column) -> Column:
    """The state after ``flips`` turns, the last reset (value, flips by then)
    or the entry counting."""
    return F.when(reset.isNull(), entry.bitwiseXOR(flips.bitwiseAND(1))).otherwise(
        reset["reset"].bitwiseXOR((flips - reset["at"]).bitwiseAND(1)))


def _records(lines: DataFrame) -> DataFrame:
    """(file, block, row, value, sep, nth): the records of all files whose
    quotes are closed at the end; (block, row) are those of the first line,
    ``nth`` counts the records that begin in a block."""
    upto = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ran = lines.withColumn("flips", F.sum("flip").over(upto).cast("int"))
    mark = F.when(F.col("reset").isNotNull(), F.struct("reset", F.col("flips").alias("at")))
    ran = ran.withColumn("last", F.last(mark, ignorenulls=True).over(upto))

    # a split as one line: its turns, or the state it ends in
    ends = ran.groupBy("file", "block").agg(F.max("flips").alias("all"), F.max_by("last", "row").alias("l"))
    ends = ends.select("file", "block", F.when(F.col("l").isNull(), F.col("all")).otherwise(F.lit(0)).alias("flip"),
                       F.when(F.col("l").isNotNull(), _state(F.lit(0), F.col("all"), F.col("l"))).alias("reset"))
    blocks = Window.partitionBy("file").orderBy("block")
    through = blocks.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ends.withColumn("flips", F.sum("flip").over(through).cast("int"))
    ends = ends.withColumn("after", _state(F.lit(0), F.col("flips"), F.last(mark, ignorenulls=True).over(through)))
    whole = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("file", "block", F.coalesce(F.lag("after").over(blocks), F.lit(0)).alias("entry"),
                       F.last("after").over(whole).alias("open"))

    order = Window.partitionBy("file", "block").orderBy("row")
    ran = ran.join(ends.filter("open = 0"), ["file", "block"])
    ran = ran.withColumn("after", _state(F.col("entry"), F.col("flips"), F.col("last")))
    ran = ran.withColumn("before", F.coalesce(F.lag("after").over(order), F.col("entry")))
    bare = F.regexp_replace("value", "\r$", "")
    ran = ran.filter((F.col("before") == 1) | (bare != ""))  # empty lines between records
    run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begins = F.col("before") == 0
    ran = (ran.withColumn("nth", F.sum(begins.cast("int")).over(run))
           .withColumn("start", F.last(F.when(begins, F.struct("block", "row")), ignorenulls=True).over(run)))
    short = ran.filter("before = 0 and after = 0").select("file", "block", "row", bare.alias("value"), "sep", "nth")

    # longer records: lines without a start in their split belong to the last start of the splits before
    tails = ran.groupBy("file", "block").agg(F.max_by("start", "row").alias("tail"))
    tails = tails.select("file", "block", F.last("tail", ignorenulls=True).over(blocks.rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"))
    parts = ran.filter("before = 1 or after = 1").join(tails, ["file", "block"])
    parts = parts.select("file", F.coalesce("start", "earlier").alias("s"), "sep", F.struct("block", "row", "value").alias("p"),
                         F.when(begins, F.col("nth")).alias("nth"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["value"]), "\n")
    long = parts.groupBy("file", "s", "sep").agg(F.regexp_replace(joined, "\r$", "").alias("value"), F.max("nth").alias("nth"))
    return short.unionByName(long.select("file", "s.block", "s.row", "value", "sep", "nth"))


def _heads(records: DataFrame) -> DataFrame:
    """(file, header, head, second): each file's first record and the places
    of its first two; at most two records a split are looked at."""
    place = F.struct("block", "row")
    w = Window.partitionBy("file").orderBy("block", "row")
    two = records.filter("nth <= 2").withColumn("k", F.row_number().over(w)).filter("k <= 2")
    one = lambda k, c: F.max(F.when(F.col("k") == k, c))
    return two.groupBy("file").agg(one(1, F.col("value")).alias("header"), one(1, place).alias("head"), one(2, place).alias("second"))


def header_names(header: str, sep: str) -> list[str]:
    """Column names of a header; an empty one is ``_c<i>``, one that occurs
    again (in any case) gets its position."""
    cells = next(csv.reader([header], delimiter=sep), [])
    low = [c.lower() for c in cells]
    return [f"_c{i}" if not c else (f"{c}{i}" if low.count(c.lower()) > 1 else c) for i, c in enumerate(cells)]


def read_metadata(spark: SparkSession, paths: Sequence[str], infer_numeric: bool = True,
                  sep: str | None = None) -> DataFrame:
    """Union (by name, missing columns null) of all metadata files.

    Unreadable files are skipped; none readable -> error.  The first data
    record of a tab-separated file is dropped when >= 60 % of its cells are
    type tags like ``[f]`` / ``[t]`` (null cells count in the denominator).
    With ``infer_numeric`` a column whose every non-null value parses as a
    number becomes DOUBLE (pandas' per-column inference), else stays text."""
    paths = sorted(set(paths))
    if not paths:
        raise FileNotFoundError("no metadata files")
    records = _cut(_records(_lines(spark, paths, sep)))
    heads = _cut(_heads(records).join(records.select("file", "sep").distinct(), "file"))
    kinds = [(r["sep"], r["header"], header_names(r["header"], r["sep"]))
             for r in heads.groupBy("sep", "header").agg(F.min("file").alias("f")).orderBy("f").collect()]  # distinct headers
    if not kinds:
        raise RuntimeError("All metadata files were empty or unreadable.")
    names: dict[str, str] = {}
    for _s, _h, cols in kinds:
        for c in cols:
            names.setdefault(c.lower(), c)
    wide = max(len(cols) for *_, cols in kinds)
    schema = ", ".join(f"c{i} string" for i in range(wide))
    parsed = lambda s: F.from_csv("value", schema, {"sep": s, "quote": '"', "escape": '"', "mode": "PERMISSIVE",
                                                    "maxCharsPerColumn": "-1"})
    df = records.join(heads.drop("sep"), "file").filter(F.struct("block", "row") != F.col("head"))
    df = df.withColumn("cells", F.when(F.col("sep") == "\t", parsed("\t")).otherwise(parsed(",")))

    def cell(k: int, i: int) -> Column:
        x = F.col(f"cells.c{i}")
        return F.when((F.col("sep") == kinds[k][0]) & (F.col("header") == kinds[k][1]), F.when(~x.isin(*NA_TOKENS), x))

    columns, tags = [], []
    for low, name in names.items():
        at = [cell(k, [c.lower() for c in cols].index(low)) for k, (_s, _h, cols) in enumerate(kinds) if low in (c.lower() for c in cols)]
        columns.append(F.coalesce(*at).alias(name))
        tags.append(F.when(F.trim(F.coalesce(*at)).rlike(TAG_RE), 1).otherwise(0))
    width = F.coalesce(*[F.when((F.col("sep") == s) & (F.col("header") == h), F.lit(len(cols))) for s, h, cols in kinds])
    tagged = (F.col("sep") == "\t") & (F.struct("block", "row") == F.col("second")) & (sum(tags, F.lit(0)) / width >= TAG_RATIO)
    out = df.filter(~F.coalesce(tagged, F.lit(False))).select(
        *columns, F.col("file").alias("_source_file"), F.col("block").alias("_block"), F.col("row").alias("_row"))
    return infer_numeric_columns(out) if infer_numeric else out


def infer_numeric_columns(df: DataFrame) -> DataFrame:
    """Cast text columns whose non-null values all parse as integers to
    BIGINT, or all as numbers to DOUBLE (one aggregate decides all columns)."""
    cand = [f.name for f in df.schema.fields
            if not f.name.startswith("_") and not isinstance(f.dataType, NumericType)]
    if not cand:
        return df

    def bad(c, t):
        return F.sum(F.when(F.col(f"`{c}`").isNotNull() & F.expr(f"try_cast(`{c}` as {t})").isNull(), 1)
                     .otherwise(0))
    stats = df.agg(*[bad(c, "bigint").alias(f"i{k}") for k, c in enumerate(cand)],
                   *[bad(c, "double").alias(f"d{k}") for k, c in enumerate(cand)],
                   *[F.count(F.col(f"`{c}`")).alias(f"n{k}") for k, c in enumerate(cand)]).first()
    casts = {}
    for k, c in enumerate(cand):
        if not stats[f"n{k}"]:
            continue
        if (stats[f"i{k}"] or 0) == 0:
            casts[c] = F.expr(f"try_cast(`{c}` as bigint)")
        elif (stats[f"d{k}"] or 0) == 0:
            casts[c] = F.expr(f"try_cast(`{c}` as double)")
    return df.withColumns(casts) if casts else df


def resolve_columns(df: DataFrame, candidates: Sequence[str], out: str, coalesce: bool = False) -> DataFrame:
    """Canonical column ``out`` from the first present candidate (or, with
    ``coalesce``, the first non-null of all present candidates — rows whose
    file used another name keep their value)."""
    present = [c for c in candidates if c in df.columns]
    if not present:
        raise KeyError(f"none of {list(candidates)} present; columns: {df.columns[:15]}")
    expr = F.coalesce(*[F.col(f"`{c}`") for c in present]) if coalesce else F.col(f"`{present[0]}`")
    return df.withColumn(out, expr)
