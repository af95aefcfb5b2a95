"""Lookups keyed by object id: cluster labels, areas, path -> id.

The right side is first reduced to one row per key (last by an order column)
with a partial aggregate, so duplicate or hot keys never pile up in one task;
the join strategy is left to AQE, which broadcasts the side only once its
runtime size is known to be under the broadcast threshold."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marisnow.operators.graph import global_rank

log = logging.getLogger(__name__)

#: columns that hold a particle's area, the preferred one first
AREA_COLUMNS = ("object_area", "area")


def last_per_key(df: DataFrame, key: str, value: str, order_col: str | None = None,
                 out: str | None = None) -> DataFrame:
    """One row per key: the value of the row with the greatest order, or of
    the last row as read where no order column is given."""
    order = order_col or "_read_order"
    if order_col is None:
        df = df.withColumn(order, F.monotonically_increasing_id())
    return df.groupBy(key).agg(F.max_by(value, order).alias(out or value))


def apply_labels(df: DataFrame, labels: DataFrame, target: str = "object_annotation_category",
                 key: str = "object_id", label_col: str = "cluster_label",
                 order_col: str | None = None) -> DataFrame:
    """Left lookup by object id (both sides compared as text); a hit
    overwrites ``target``."""
    lab = labels.select(F.col(key).cast("string").alias("_lk"), F.col(label_col).alias("_lv"),
                        *([F.col(order_col).alias("_lo")] if order_col else []))
    lab = last_per_key(lab, "_lk", "_lv", "_lo" if order_col else None)
    joined = df.join(lab, F.col(key).cast("string") == F.col("_lk"), "left")
    return joined.withColumn(target, F.coalesce(F.col("_lv"), F.col(target))).drop("_lk", "_lv")


def _numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` plus its rows' numbers from 0, as read."""
    ranked = global_rank(df.withColumn("_read_order", F.monotonically_increasing_id()), ["_read_order"], name)
    return ranked.withColumn(name, F.col(name) - 1).drop("_read_order")


def lookup_area(features: DataFrame, particles: DataFrame, area_col: str | None = None,
                key: str = "object_id", order_col: str | None = None) -> DataFrame:
    """features ⟕ area by object id; a miss gives null (NaN upstream).

    The area column is ``area_col`` or the first present of AREA_COLUMNS;
    without one the features are returned as they are.  Particles without the
    key are matched by position if there are as many of them, else not."""
    area_col = area_col or next((c for c in AREA_COLUMNS if c in particles.columns), None)
    if area_col is None:
        log.warning("no area column; unchanged")
        return features
    value = F.expr(f"try_cast(`{area_col}` as double)").alias("_av")
    if key not in particles.columns:
        if particles.count() != features.count():
            log.warning("no %s and other row counts; unchanged", key)
            return features
        at = _numbered(particles.select(value), "_ap")
        return _numbered(features, "_fp").join(at, F.col("_fp") == F.col("_ap"), "left").withColumnRenamed("_av", "area").drop("_ap", "_fp")
    a = particles.select(F.col(key).cast("string").alias("_ak"), value,
                         *([F.col(order_col).alias("_ao")] if order_col else []))
    a = last_per_key(a, "_ak", "_av", "_ao" if order_col else None)
    return (features.join(a, F.col(key).cast("string") == F.col("_ak"), "left")
            .withColumnRenamed("_av", "area").drop("_ak"))


def path_to_object_id(paths: DataFrame, particles: DataFrame, path_col: str = "image_path",
                      src_path: str = "full_path", order_col: str | None = None, row_default: bool = False) -> DataFrame:
    """image path -> object_id (last wins); a miss is null, or with
    ``row_default`` the row's number as read, from 0, as text."""
    m = particles.select(F.col(src_path).alias("_pk"), F.col("object_id").cast("string").alias("_pv"),
                         *([F.col(order_col).alias("_po")] if order_col else []))
    m = last_per_key(m, "_pk", "_pv", "_po" if order_col else None)
    if row_default:
        found = _numbered(paths, "_pr").join(m, F.col(path_col) == F.col("_pk"), "left")
        return found.withColumn("object_id", F.coalesce("_pv", F.col("_pr").cast("string"))).drop("_pk", "_pv", "_pr")
    return (paths.join(m, F.col(path_col) == F.col("_pk"), "left")
            .withColumnRenamed("_pv", "object_id").drop("_pk"))
