"""Exact k-nearest neighbours, nearest targets and medoids.

Neighbours come from the metric index (``metric``): cells that the triangle
inequality excludes are never met, no pair is materialised as a row, and every
winner's distance is exact."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marisnow.operators.metric import MetricIndex



def _matrix(s: pd.Series) -> np.ndarray:
    if len(s) == 0:
        return np.zeros((0, 0))
    return np.stack([np.asarray(x, dtype=np.float64) for x in s])


def _distances(q: np.ndarray, c: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        qn = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-12)
        cn = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        return 1.0 - qn @ cn.T
    if metric == "euclidean":
        d2 = (q * q).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2.0 * (q @ c.T)
        return np.sqrt(np.maximum(d2, 0.0))
    raise ValueError(f"unknown metric {metric}")


def knn(df: DataFrame, id_col: str, vec_col: str, k: int, metric: str = "cosine",
        include_self: bool = False, candidates: DataFrame | None = None,
        block_rows: int | None = None) -> DataFrame:
    """(id, nbr, rank, dist): the k nearest candidates of every point, ranked
    by (distance rounded to 1e-9, neighbour id).  ``candidates`` defaults to
    the points themselves (self pairs excluded unless ``include_self``);
    ``block_rows`` is the size of the index's cells."""
    if candidates is None:
        return MetricIndex(df, id_col, vec_col, metric, block_rows).knn(k, include_self)
    return MetricIndex(candidates, id_col, vec_col, metric, block_rows).knn(k, include_self, (df, id_col, vec_col))


def nearest(points: DataFrame, id_col: str, vec_col: str, targets: DataFrame, target_id: str,
            target_vec: str, metric: str = "euclidean") -> DataFrame:
    """Nearest target per point (id, nbr, dist): best-first search on an
    index of the targets."""
    t = targets.select(F.col(target_id).alias(id_col), F.col(target_vec).alias(vec_col))
    r = knn(points, id_col, vec_col, 1, metric, include_self=True, candidates=t)
    return r.select("id", "nbr", "dist")


def _dist_sum_fn(metric: str):
    def fn(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if len(left) == 0 or len(right) == 0:
            return pd.DataFrame({"id": [], "lbl": [], "s": []})
        d = _distances(_matrix(left["v"]), _matrix(right["v"]), metric)
        s = d.sum(axis=1)
        return pd.DataFrame({"id": left["id"].to_numpy(), "lbl": left["lbl"].to_numpy(), "s": s})
    return fn


def cluster_medoids(df: DataFrame, id_col: str, vec_col: str, label_col: str, metric: str = "euclidean",
                    block_rows: int = 2048) -> DataFrame:
    """(label, medoid id, medoid vector): the member with the least summed
    distance to the other members of its cluster (noise -1 excluded; ties
    -> smallest id).  Every cluster is dealt into blocks by its size and its
    blocks meet each other, so no pair is materialised even for a huge cluster
    and no distance between clusters is computed."""
    pts = df.filter(F.col(label_col) != -1)
    base = pts.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"),
                      F.col(label_col).cast("int").alias("lbl"))
    size = base.groupBy("lbl").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    base = base.join(size, "lbl").withColumn("blk", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    qx = base.select("id", "v", "lbl", F.col("blk").alias("qb"), partner.alias("cb"))
    cx = base.select(*[F.col(c).alias(c) for c in ("id", "v", "lbl")], partner.alias("qb"), F.col("blk").alias("cb"))
    sums = (qx.groupBy("lbl", "qb", "cb").cogroup(cx.groupBy("lbl", "qb", "cb"))
            .applyInPandas(_dist_sum_fn(metric), "id long, lbl int, s double")
            .groupBy("id", "lbl").agg(F.sum("s").alias("s")))
    best = sums.groupBy("lbl").agg(F.min(F.struct(F.round("s", 9).alias("s"), "id")).alias("m"))
    med = best.select(F.col("lbl").alias(label_col), F.col("m.id").alias("medoid_id"))
    return med.join(base.select(F.col("id").alias("medoid_id"), F.col("v").alias("medoid")), "medoid_id")
