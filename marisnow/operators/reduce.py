"""Dimension reduction of feature vectors.

``pca_reduce`` uses ``pyspark.ml.feature.PCA`` (a distributed covariance
aggregate; only the d x d matrix reaches the driver).  ``fuzzy_graph`` builds
the UMAP fuzzy simplicial set (McInnes et al. 2018) from the exact kNN table:
per-point rho/sigma by vectorised bisection in a grouped pandas function over
that point's k neighbours (a bounded group), then symmetrisation
w = a + b - a*b by a union of both directions and a grouped sum."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pca_reduce(df: DataFrame, vec: str, k: int, out: str = "embedding", normalize: bool = False) -> DataFrame:
    """Project ``vec`` onto its top-``k`` principal components; an empty
    table stays one."""
    src = df.withColumn("_pv", array_to_vector(F.col(vec).cast("array<double>")))
    dims = df.agg(F.max(F.size(vec))).first()[0]
    if dims is None:
        return df.withColumn(out, F.lit(None).cast("array<double>"))
    k = min(k, dims)
    model = PCA(k=k, inputCol="_pv", outputCol="_po").fit(src)
    res = model.transform(src).withColumn(out, vector_to_array("_po")).drop("_pv", "_po")
    if normalize:
        from marisnow.operators.vectors import l2_normalize
        res = res.withColumn(out, l2_normalize(out))
    return res


def _smooth_knn(dists: np.ndarray, k: int, n_iter: int = 64, tol: float = 1e-5):
    """rho = nearest non-zero distance; sigma solving
    sum_j exp(-max(0, d_j - rho) / sigma) = log2(k) by bisection."""
    target = math.log2(k)
    nz = dists[dists > 0]
    rho = float(nz.min()) if nz.size else 0.0
    lo, hi, mid = 0.0, np.inf, 1.0
    for _ in range(n_iter):
        psum = float(np.exp(-np.maximum(dists - rho, 0.0) / mid).sum())
        if abs(psum - target) < tol:
            break
        if psum > target:
            hi = mid
            mid = (lo + hi) / 2.0
        else:
            lo = mid
            mid = mid * 2 if hi == np.inf else (lo + hi) / 2.0
    mean_d = float(dists.mean()) if dists.size else 0.0
    sigma = max(mid, 1e-3 * mean_d) if rho > 0 else max(mid, 1e-3 * mean_d)
    return rho, sigma


def _smooth_knn_batch(d: np.ndarray, k: int, n_iter: int = 64, tol: float = 1e-5):
    """Vectorised rho/sigma for a batch of points (rows of sorted distances,
    NaN-padded): the same bisection as ``_smooth_knn`` on every row at once."""
    target = math.log2(k)
    pos = np.where(d > 0, d, np.inf)
    rho = np.min(pos, axis=1)
    rho = np.where(np.isfinite(rho), rho, 0.0)
    lo = np.zeros(len(d))
    hi = np.full(len(d), np.inf)
    mid = np.ones(len(d))
    done = np.zeros(len(d), dtype=bool)
    for _ in range(n_iter):
        psum = np.nansum(np.exp(-np.maximum(d - rho[:, None], 0.0) / mid[:, None]), axis=1)
        done |= np.abs(psum - target) < tol
        over = (psum > target) & ~done
        under = (psum <= target) & ~done
        hi = np.where(over, mid, hi)
        lo = np.where(under, mid, lo)
        mid = np.where(over, (lo + hi) / 2.0,
                       np.where(under, np.where(np.isinf(hi), mid * 2.0, (lo + hi) / 2.0), mid))
    mean_d = np.nanmean(d, axis=1)
    return rho, np.maximum(mid, 1e-3 * np.nan_to_num(mean_d))


def fuzzy_graph(knn_edges: DataFrame, k: int) -> DataFrame:
    """(a, b, w) symmetric membership strengths from kNN rows (id, nbr, dist).

    Each point's k distances (a bounded list) go through one vectorised
    pandas UDF per Arrow batch for rho/sigma; memberships and the
    symmetrisation w = a + b - ab are built-in expressions and one grouped
    aggregate over both directions."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("struct<rho double, sigma double>")
    def rho_sigma(ds: pd.Series) -> pd.DataFrame:
        width = max((len(x) for x in ds), default=0)
        mat = np.full((len(ds), max(width, 1)), np.nan)
        for i, x in enumerate(ds):
            mat[i, :len(x)] = x
        rho, sigma = _smooth_knn_batch(mat, k)
        return pd.DataFrame({"rho": rho, "sigma": sigma})

    per_point = knn_edges.groupBy("id").agg(F.sort_array(F.collect_list("dist")).alias("ds"))
    rs = per_point.select("id", rho_sigma("ds").alias("rs")).select("id", "rs.rho", "rs.sigma")
    directed = knn_edges.join(rs, "id").select(
        F.col("id").alias("a"), F.col("nbr").alias("b"),
        F.exp(-F.greatest(F.col("dist") - F.col("rho"), F.lit(0.0)) / F.col("sigma")).alias("p"))
    # each directed kNN edge once; a pair seen from both ends gets a + b - ab
    g = directed.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(
        F.sum("p").alias("s"), F.exp(F.sum(F.log(F.col("p")))).alias("prod"), F.count(F.lit(1)).alias("c"))
    # two directions present: a + b - ab; one: just that strength
    return g.select("a", "b", F.when(F.col("c") == 2, F.col("s") - F.col("prod")).otherwise(F.col("s")).alias("w"))


def sigma_residual(knn_edges: DataFrame, k: int) -> DataFrame:
    """Per point |sum exp(-(d - rho)/sigma) - log2 k| (should be ~0)."""
    def res(pdf: pd.DataFrame) -> pd.DataFrame:
        d = pdf["dist"].to_numpy(dtype=np.float64)
        rho, sigma = _smooth_knn(d, k)
        r = abs(float(np.exp(-np.maximum(d - rho, 0.0) / sigma).sum()) - math.log2(k))
        return pd.DataFrame({"id": [int(pdf["id"].iloc[0])], "residual": [r]})
    return knn_edges.groupBy("id").applyInPandas(res, "id long, residual double")
