"""Aggregates over particles and label tables.  All are single hash
aggregates with map-side partial aggregation (skew-safe)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marisnow.functions import text as T
from marisnow.operators.rows import random_sample


def count_by(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """Rows per value; the null group is dropped (as a pandas groupby)."""
    if col not in df.columns:
        return df.sparkSession.createDataFrame([], f"`{col}` string, {out} bigint")
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(out))


def share(df: DataFrame, flag: str) -> DataFrame:
    """hits, total, percent of a boolean column."""
    hits = F.sum(F.col(flag).cast("int"))
    return df.agg(hits.cast("bigint").alias("hits"), F.count(F.lit(1)).alias("total"),
                  F.round(F.lit(100.0) * hits / F.count(F.lit(1)), 6).alias("pct"))


def cluster_stats(df: DataFrame, label: str) -> DataFrame:
    """clusters (labels other than -1), noise count, noise %, all-noise flag."""
    lab = F.col(label)
    n_clusters = F.count_distinct(F.when(lab != -1, lab))
    n_noise = F.sum(F.when(lab == -1, 1).otherwise(0))
    return df.agg(
        n_clusters.alias("n_clusters"),
        n_noise.cast("bigint").alias("n_noise"),
        F.round(F.lit(100.0) * n_noise / F.greatest(F.count(F.lit(1)), F.lit(1)), 6).alias("noise_pct"),
        (n_clusters == 0).alias("all_noise"),
    )


def cluster_histogram(df: DataFrame, label: str) -> DataFrame:
    """Size per cluster label (callers order by ``n`` descending to report)."""
    return df.groupBy(T.cluster_label(label).alias("cluster_label")).agg(F.count(F.lit(1)).alias("n"))


def run_summary(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("points"), F.count_distinct(label).alias("labels"))


def default_view_label(final: Column) -> Column:
    """Explorer fallback label from cluster_final; null -> 'unknown'."""
    return F.when(final.isNull(), F.lit("unknown")).otherwise(
        F.concat(F.lit("non_living/cluster_"), F.format_string("%02d", final.cast("int"))))


def train_subset(df: DataFrame, category_col: str, path_col: str, classes: Sequence[str],
                 cap: int | None = None, seed: int = 42, key: str = "object_id") -> DataFrame:
    """Non-living rows with a path: all of them, or at most ``cap`` if the
    caller asks for a cap, chosen by the seeded md5 order."""
    sel = df.filter(T.non_living(category_col, classes) & F.col(path_col).isNotNull())
    if cap is None:
        return sel
    return random_sample(sel, cap, seed=seed, key=key)
