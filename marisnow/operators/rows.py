"""Row-level relational operators: keep-first dedup, exact seeded sampling,
path token filter and the class-list augmentation.

Skew: dedup is a grouped ``min_by`` (partial aggregation on the map side),
so a key holding a third of all rows is combined before the shuffle instead
of being sorted in one task as a window would."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marisnow.functions import paths as P
from marisnow.functions import text as T
from marisnow.schemas import NOT_LIVING_VARIANT, PATH_TOKEN_OFF


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row per key in the total order ``order``.

    ``order`` must make rows unique within a key for a deterministic result
    (e.g. source file + row number); rows equal in every order column are
    interchangeable."""
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    ocols = [F.col(o) if isinstance(o, str) else o for o in order]
    ordk = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(ocols)])
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*payload), ordk).alias("_first"))
    return agg.select(*keys, *[F.col("_first")[c].alias(c) for c in payload]).select(*df.columns)


def sample_key(seed: int, key: str | Column) -> Column:
    """Engine-independent pseudo-random sort key: md5('<seed>:<key>')."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{int(seed)}:"), k.cast("string")))


def random_sample(df: DataFrame, n: int, seed: int = 42, key: str = "object_id") -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, reproducible on any
    engine: the ``n`` smallest md5(seed:key), ties by key.  Spark plans this
    as a per-partition top-n followed by one merge of at most ``n`` rows
    per partition (TakeOrderedAndProject) — bounded by ``n``, not the data."""
    if n <= 0:
        return df.limit(0)
    # a row without a key is drawn by its content, as likely as any other
    k = F.coalesce(F.col(key).cast("string"), F.to_json(F.struct(*df.columns)))
    return df.orderBy(sample_key(seed, k), k).limit(int(n))


def path_token_filter(df: DataFrame, path_col: str, token: str | None,
                      strict: bool = True) -> DataFrame:
    """Restrict rows by a path token.

    None/''/off/none/no -> unchanged.  'auto' -> rows containing
    deconv_crops if any exist, else rows with a crops folder if any, else all.
    Other tokens are case-insensitive regexes; zero hits raise (strict) or
    keep all rows (lax).  The 'any hits' decision is a one-row aggregate
    inlined as a scalar subquery, so the whole operator is one lazy plan."""
    raw = None if token is None else str(token).strip()
    if not raw or raw.lower() in PATH_TOKEN_OFF:
        return df
    if raw.lower() == "auto":
        deconv = P.path_contains(path_col, P.DECONV_TOKEN)
        crops = P.path_contains(path_col, P.CROPS_ANY_RE)
        # one scalar subquery (a single scan) decides which rule applies
        flags = df.agg(F.struct(F.max(deconv.cast("int")).alias("d"),
                                F.max(crops.cast("int")).alias("c"))).scalar()
        keep = (F.when(flags.getField("d") == 1, deconv)
                .when(flags.getField("c") == 1, crops)
                .otherwise(F.lit(True)))
        return df.filter(keep)
    hit = P.path_contains(path_col, raw.lower())
    hits = F.coalesce(df.agg(F.max(hit.cast("int"))).scalar(), F.lit(0))
    if strict:
        msg = f"No crop rows matched path token '{token}'"
        keep = F.when(hits == 0, F.raise_error(F.lit(msg))).otherwise(hit)
    else:
        keep = hit | (hits == 0)
    return df.filter(keep)


def augmented_non_living(df: DataFrame, category_col: str, classes: Sequence[str],
                         out: str = "non_living") -> DataFrame:
    """Non-living flag with the class-list augmentation: when the whole
    collection has no hit but some value reads 'not living', that variant
    joins the class list for this run.  Decided by scalar subqueries."""
    base = T.non_living(category_col, classes)
    aug = T.non_living(category_col, list(classes) + [NOT_LIVING_VARIANT])
    flags = df.agg(F.struct(F.max(base.cast("int")).alias("b"),
                            F.max(T.mentions_not_living(category_col).cast("int")).alias("v"))).scalar()
    any_base = F.coalesce(flags.getField("b"), F.lit(0))
    any_variant = F.coalesce(flags.getField("v"), F.lit(0))
    use_aug = (any_base == 0) & (any_variant == 1)
    return df.withColumn(out, F.when(use_aug, aug).otherwise(base))
