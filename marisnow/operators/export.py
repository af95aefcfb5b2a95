"""Export table: rename to export names, defaults, labels, file names,
date/time text, column selection; export filters and counts.

One lazy chain: a left lookup of cluster labels, projections and a filter.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marisnow.functions import text as T
from marisnow.operators.labels import apply_labels
from marisnow.schemas import (
    CATEGORY_CANDIDATES,
    DEFAULT_NON_LIVING_CLASSES,
    EXPORT_COLUMNS,
    PATH_CANDIDATES,
    RAW_TO_EXPORT,
)

log = logging.getLogger(__name__)

CATEGORY = "object_annotation_category"


def first_present(df: DataFrame, candidates: Iterable[str]) -> str:
    cols = set(df.columns)
    for c in candidates:
        if c in cols:
            return c
    raise KeyError(f"none of {list(candidates)} in columns {df.columns[:15]}")


def path_column(df: DataFrame) -> str:
    return first_present(df, PATH_CANDIDATES)


def category_column(df: DataFrame) -> str:
    return first_present(df, CATEGORY_CANDIDATES)


def rename_export_columns(df: DataFrame) -> DataFrame:
    """Raw -> export names for present columns.  When both the raw and the
    export name exist the export column wins and the raw one is dropped."""
    cols = set(df.columns)
    drop = [raw for raw, exp in RAW_TO_EXPORT.items() if raw in cols and exp in cols]
    if drop:
        log.warning("raw columns %s shadowed by export columns; dropped", drop)
        df = df.drop(*drop)
    mapping = {raw: exp for raw, exp in RAW_TO_EXPORT.items() if raw in df.columns}
    return df.withColumnsRenamed(mapping) if mapping else df


def export_defaults(df: DataFrame) -> DataFrame:
    cols = set(df.columns)
    add = {}
    if CATEGORY not in cols:
        add[CATEGORY] = F.lit("unknown")
    if "object_annotation_status" not in cols:
        add["object_annotation_status"] = F.lit("predicted")
    if "object_depth_max" not in cols and "object_depth_min" in cols:
        add["object_depth_max"] = F.col("object_depth_min")
    if "sample_id" not in cols:
        add["sample_id"] = F.col("sample_cruise") if "sample_cruise" in cols else F.lit("unknown")
    return df.withColumns(add) if add else df


def build_export_table(df: DataFrame, labels: DataFrame | None = None,
                       keep_source: bool = False, label_order: str | None = None) -> DataFrame:
    """Particles (raw names) -> export table (28 columns, those present).

    ``labels``: DataFrame(object_id, cluster_label[, order]) — a hit replaces
    the category; duplicate ids keep the last by ``label_order``.
    ``keep_source`` keeps the original image path as ``_src``."""
    src_col = path_column(df)
    if keep_source:
        df = df.withColumn("_src", F.col(src_col))
    df = rename_export_columns(df)
    df = export_defaults(df)
    df = df.withColumn(CATEGORY, T.clean_category(CATEGORY))
    if labels is not None and "object_id" in df.columns:
        df = apply_labels(df, labels, target=CATEGORY, order_col=label_order)
    if "img_file_name" in df.columns:
        df = df.withColumn("img_file_name", T.base_name(T.as_text("img_file_name")))
    else:
        src = "object_full_path" if "object_full_path" in df.columns else src_col
        df = df.withColumn("img_file_name",
                           F.when(F.col(src).isNull(), F.lit("")).otherwise(T.base_name(src)))
    types = {f.name: f.dataType for f in df.schema.fields}
    if "object_date" in df.columns:
        df = df.withColumn("object_date", T.normalize_date("object_date", types["object_date"]))
    if "object_time" in df.columns:
        df = df.withColumn("object_time", T.normalize_time("object_time", types["object_time"]))
    keep = [c for c in EXPORT_COLUMNS if c in df.columns]
    if keep_source:
        keep.append("_src")
    return df.select(*keep)


def non_living_flag(df: DataFrame, classes=DEFAULT_NON_LIVING_CLASSES, literal: bool = False):
    if CATEGORY in df.columns:
        return T.non_living(CATEGORY, classes, literal)
    return F.lit(False)


def category_filter(df: DataFrame, mode: str | None = "all",
                    classes=DEFAULT_NON_LIVING_CLASSES) -> DataFrame:
    m = str(mode or "all").strip().lower()
    nl = non_living_flag(df, classes)
    if m == "living":
        return df.filter(~nl)
    if m in {"non_living", "non-living", "nonliving"}:
        return df.filter(nl)
    return df


def esd_range_filter(df: DataFrame, esd_min: float | None = None,
                     esd_max: float | None = None) -> DataFrame:
    """Inclusive bounds on the numeric value of object_esd; null/non-numeric
    values fail when any bound is set; a missing column skips the filter."""
    if esd_min is None and esd_max is None:
        return df
    if "object_esd" not in df.columns:
        log.warning("ESD filter requested but object_esd is missing; skipped")
        return df
    esd = F.expr("try_cast(object_esd as double)")
    cond = F.lit(True)
    if esd_min is not None:
        cond = cond & (esd >= F.lit(float(esd_min)))
    if esd_max is not None:
        cond = cond & (esd <= F.lit(float(esd_max)))
    return df.filter(F.coalesce(cond, F.lit(False)))


def export_filters(df: DataFrame, classes=DEFAULT_NON_LIVING_CLASSES, mode: str = "all",
                   esd_min: float | None = None, esd_max: float | None = None) -> DataFrame:
    return esd_range_filter(category_filter(df, mode, classes), esd_min, esd_max)


def count_export(df: DataFrame, labels: DataFrame | None = None,
                 classes=DEFAULT_NON_LIVING_CLASSES, mode: str = "all",
                 esd_min: float | None = None, esd_max: float | None = None,
                 existing: DataFrame | None = None) -> DataFrame:
    """One-row (total, living, non_living) after the export filters.

    ``existing``: optional file listing (column ``path``); rows whose source
    file is absent are dropped by a left-semi join before filtering."""
    et = build_export_table(df, labels, keep_source=existing is not None)
    if existing is not None:
        et = et.join(existing.select(F.col("path").alias("_src")).distinct(), "_src", "left_semi")
    et = export_filters(et, classes, mode, esd_min, esd_max)
    nl = non_living_flag(et, classes)
    return et.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.when(nl, 0).otherwise(1)).cast("bigint").alias("living"),
        F.sum(F.when(nl, 1).otherwise(0)).cast("bigint").alias("non_living"),
    ).select("total", F.coalesce("living", F.lit(0)).alias("living"),
             F.coalesce("non_living", F.lit(0)).alias("non_living"))


def split_by_category(df: DataFrame, split_mode: str | None = "none",
                      classes=DEFAULT_NON_LIVING_CLASSES) -> DataFrame:
    """Adds ``_group``: living / non_living, or 'all'."""
    key = str(split_mode or "none").strip().lower()
    if key == "living_non_living":
        nl = non_living_flag(df, classes)
        return df.withColumn("_group", F.when(nl, "non_living").otherwise("living"))
    return df.withColumn("_group", F.lit("all"))
