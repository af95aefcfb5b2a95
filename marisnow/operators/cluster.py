"""Label finishing: noise assignment, KMeans fallback and label text."""

from __future__ import annotations

import logging

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marisnow.functions.text import cluster_label
from marisnow.operators.vectors import assign_noise
from marisnow.session import materialize

log = logging.getLogger(__name__)

#: points that the KMeans starts are drawn from
STARTING_ROWS = 16_384


def starting_centres(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++: each next centre is a row drawn with the squared distance
    to the centres so far as its weight."""
    rng = np.random.default_rng(seed)
    at = [int(rng.integers(len(x)))]
    left = ((x - x[at[0]]) ** 2).sum(1)
    for _ in range(k - 1):
        total = left.sum()
        at.append(int(rng.choice(len(x), p=left / total)) if total > 0 else int(rng.integers(len(x))))
        left = np.minimum(left, ((x - x[at[-1]]) ** 2).sum(1))
    return x[at]


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2.0 * (x @ c.T) + (c * c).sum(1)[None, :], 0.0)


def _packed(points: DataFrame) -> DataFrame:
    """(x): the vectors of an Arrow batch as one binary value, which a scan
    reads without a value a component."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                x = b.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary())], ["x"])

    return points.mapInArrow(run, "x binary")


def _step(points: DataFrame, starts: dict[int, np.ndarray], dims: int) -> dict[int, tuple[np.ndarray, float]]:
    """One scan of the packed points for all ``starts``: each one's new centres
    and its cost at the old ones.  A task sends one row for each start and cluster it has met."""

    every = np.concatenate(list(starts.values()))
    lengths, edges = (every * every).sum(1), np.cumsum([0] + [len(c) for c in starts.values()])

    def run(batches):
        sums = {s: (np.zeros(len(c)), np.zeros(c.shape), np.zeros(len(c))) for s, c in starts.items()}
        for b in batches:
            for pack in b.column(0).to_pylist():
                x = np.frombuffer(pack, np.float64).reshape(-1, dims)
                own, product = (x * x).sum(1)[:, None], x @ every.T  # one product for all starts
                for i, s in enumerate(starts):
                    here = slice(edges[i], edges[i + 1])
                    d = np.maximum(own - 2.0 * product[:, here] + lengths[here], 0.0)
                    at = d.argmin(1)
                    n, total, cost = sums[s]
                    n += np.bincount(at, minlength=len(n))
                    cost += np.bincount(at, d[np.arange(len(x)), at], len(n))
                    total += (at[None, :] == np.arange(len(n))[:, None]).astype(float) @ x
        rows = [(s, i, n[i], cost[i], (total[i] / n[i]).tolist()) for s, (n, total, cost) in sums.items() for i in np.flatnonzero(n)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64())))],
                                             ["s", "c", "n", "cost", "mean"])

    part = points.mapInArrow(run, "s int, c int, n double, cost double, mean array<double>")
    got = part.groupBy("s", "c").agg(F.sum("cost").alias("cost"), vector_to_array(Summarizer.mean(array_to_vector("mean"), F.col("n"))).alias("mean")).collect()
    out = {s: (c.copy(), 0.0) for s, c in starts.items()}  # a cluster without points keeps its centre
    for r in sorted(got, key=lambda r: (r["s"], r["c"])):
        centres, cost = out[r["s"]]
        centres[r["c"]] = r["mean"]
        out[r["s"]] = centres, cost + r["cost"]
    return out


def kmeans_fallback(df: DataFrame, vec: str, k: int, seed: int = 42, n_init: int = 20,
                    out: str = "cluster_final", max_iter: int = 300, tol: float = 1e-4,
                    sample: int = STARTING_ROWS) -> DataFrame:
    """KMeans labels on the embedding: the start of least cost out of
    ``n_init``.  Requires 2 <= k <= number of points; vectors of one length,
    null ones get no label.

    All starts run side by side, one scan of the points an iteration; a start
    leaves once no centre moves by more than ``tol``.  The starting centres
    are drawn by k-means++ from at most ``sample`` points in the order of a
    hash; the driver holds n_init x k centres."""
    if k is None or k < 2:
        raise ValueError("fallback k must be >= 2")
    points = materialize(df.select(F.col(vec).cast("array<double>").alias("v")).filter("v is not null"), df.sparkSession, "kmeans")
    n = points.count()
    if n < k:
        raise ValueError(f"fallback k={k} is larger than number of points={n}")
    first = points.orderBy(F.xxhash64("v"), "v").limit(max(sample, k)).toPandas()["v"]
    x = np.array([np.asarray(v, dtype=float) for v in first])
    packs = materialize(_packed(points), df.sparkSession, "kmeans-packs")
    running = {s: starting_centres(x, k, seed + s) for s in range(max(1, n_init))}
    done: dict[int, tuple[float, np.ndarray]] = {}
    for _ in range(max_iter):
        if not running:
            break
        moved = _step(packs, running, x.shape[1])
        for s, (centres, cost) in moved.items():
            if np.sqrt(((centres - running[s]) ** 2).sum(1)).max() <= tol:
                done[s] = cost, running.pop(s)
            else:
                running[s] = centres
    if running:  # those that still move at the limit
        done |= {s: (cost, running[s]) for s, (_, cost) in _step(packs, running, x.shape[1]).items()}
    least = min(c for c, _ in done.values())
    # equal costs differ by the order in which tasks are summed: the first start of those counts
    cost, centres = done[min(s for s, (c, _) in done.items() if c <= least * (1 + 1e-9))]
    log.info("kmeans: least cost %s of %d starts", cost, len(done))

    @F.pandas_udf("int")
    def label(v: pd.Series) -> pd.Series:
        has = v.notna()
        res = pd.Series([None] * len(v), index=v.index, dtype="Int32")
        if has.any():
            rows = np.array([np.asarray(r, dtype=float) for r in v[has]])
            res[has] = _squared(rows, centres).argmin(1).astype("int32")
        return res

    return df.withColumn(out, label(F.col(vec).cast("array<double>")))


def final_labels(df: DataFrame, vec: str, raw: str = "cluster_raw", keep_noise: bool = False,
                 fallback_on_all_noise: bool = False, fallback_k: int | None = None,
                 seed: int = 42) -> DataFrame:
    """cluster_final and cluster_label from raw labels.

    keep_noise -> final = raw; else noise goes to the nearest centroid.  When
    every point is noise, fallback is on, k is set and noise is not kept,
    KMeans labels replace the result."""
    if keep_noise:
        out = df.withColumn("cluster_final", F.col(raw))
    else:
        out = assign_noise(df, raw, vec, out="cluster_final")
    if fallback_on_all_noise and fallback_k is not None and not keep_noise:
        has_cluster = df.filter(F.col(raw) != -1).limit(1).count() > 0
        if not has_cluster:
            log.warning("all points are noise; KMeans fallback with k=%s", fallback_k)
            out = kmeans_fallback(df, vec, fallback_k, seed)
    return out.withColumn("cluster_label", cluster_label("cluster_final"))
