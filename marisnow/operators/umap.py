"""Neighbour-graph layout (UMAP, McInnes et al. 2018) as Spark jobs.

1. exact kNN (metric index) -> fuzzy simplicial set (``reduce.fuzzy_graph``);
2. initial layout: PCA of the inputs, scaled to [-10, 10] (distributed);
3. nodes get a dense index and are dealt into ranges of NODES; a range's
   edges are packed once, in parts of bounded size, and dealt to TASKS rows of
   tasks, where they are kept between epochs;
4. E epochs of full-batch optimisation.  An epoch exchanges coordinates only,
   as whole millionths: a range goes once to each task.  Where all coordinates
   exceed STATE_BYTES, tasks form a grid: edges are also dealt by the column of
   their other end, and a task gets the ranges of its column, of its nodes and
   of their negatives.  A part returns its nodes' weighted sums
   of pulls (attractive term of the low-dimensional membership curve
   1 / (1 + a d^2b)) and pushes, clipped to [-4, 4]; a range averages its
   parts' sums and moves with a learning rate decaying 1 -> 0.
   Negatives are chosen by a hash of (seed, epoch, edge, j) among the nodes of
   NEGATIVE_RANGES ranges, which change by epoch and range, so all nodes
   take their turn.  Coordinates are rounded each epoch and written to the
   checkpoint folder every few epochs.

Not bit-equal to the library's per-sample stochastic optimiser; checked by
neighbour preservation, determinism and a plain numpy version of the epochs."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from marisnow.operators.graph import _cut, global_rank
from marisnow.operators.knn import knn
from marisnow.operators.reduce import fuzzy_graph, pca_reduce

#: nodes in a range, edges in a part (on average), ranges that negatives come from, epochs between written states
NODES, EDGES, NEGATIVE_RANGES, KEEP_EVERY = 512, 32_768, 2, 5
#: edges that are moved at once
CHUNK = 8_192
#: rows of tasks (more where a task would get more than TASK_EDGES edges), bytes of coordinates in a column of tasks
TASKS, TASK_EDGES, STATE_BYTES = 16, 4 << 20, 32 << 20
#: coordinates are exchanged as multiples of 1 / UNIT
UNIT = 1e6


def curve_params(min_dist: float, spread: float = 1.0) -> tuple[float, float]:
    """Fit a, b of 1 / (1 + a x^2b) to the target membership curve
    (1 below min_dist, exp(-(x - min_dist) / spread) above) by Gauss-Newton."""
    x = np.linspace(0, spread * 3, 300)[1:]
    y = np.where(x < min_dist, 1.0, np.exp(-(x - min_dist) / spread))
    a, b = 1.0, 1.0
    for _ in range(200):
        xb = x ** (2 * b)
        f = 1.0 / (1.0 + a * xb)
        r = f - y
        da = -xb * f * f
        db = -a * xb * 2.0 * np.log(x) * f * f
        jac = np.stack([da, db], axis=1)
        step, *_ = np.linalg.lstsq(jac, -r, rcond=None)
        a, b = max(a + step[0], 1e-3), max(b + step[1], 1e-3)
        if np.abs(step).max() < 1e-10:
            break
    return float(a), float(b)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def draw(seed: int, epoch: int, u: np.ndarray, v: np.ndarray, j: int, among: int) -> np.ndarray:
    """Place of each edge's ``j``-th negative among as many nodes."""
    with np.errstate(over="ignore"):
        h = _mixed(u.astype(np.uint64) + np.uint64(seed * 1_000_003 + epoch * 8191 + j + 1))
        h = _mixed(h + v.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (h % np.uint64(among)).astype(np.int64)


def negative_ranges(seed: int, epoch: int, own: int, ranges: int) -> list[int]:
    """The ranges that a range draws its negatives from in an epoch."""
    picked = {int(draw(seed, epoch, np.array([own]), np.array([i]), 0, ranges)[0]) for i in range(NEGATIVE_RANGES)}
    return sorted(picked)


def forces(own: np.ndarray, there: np.ndarray, pool: np.ndarray, pool_ids: np.ndarray, local: np.ndarray, u: np.ndarray,
           v: np.ndarray, w: np.ndarray, a: float, b: float, seed: int, epoch: int, negatives: int):
    """Weighted sums of the clipped pulls and pushes on a range's nodes, and
    the sums of the weights.  ``local``: each edge's node in ``own``;
    ``there``: coordinates of its other end; ``u``, ``v``: the ends' numbers."""
    total, weight = np.zeros_like(own), np.zeros(len(own))

    def add(at, gap, factor, by):
        g = np.clip(factor[:, None] * gap, -4.0, 4.0) * by[:, None]
        for k in range(own.shape[1]):
            total[:, k] += np.bincount(at, g[:, k], len(own))
        weight[:] += np.bincount(at, by, len(own))

    for lo in range(0, len(u), CHUNK):
        s = slice(lo, lo + CHUNK)
        mine = own[local[s]]
        gap = mine - there[s]
        d2 = (gap * gap).sum(1)
        pull = np.zeros(len(d2))
        on = d2 > 0
        pull[on] = -2.0 * a * b * d2[on] ** (b - 1.0) / (1.0 + a * d2[on] ** b)
        add(local[s], gap, pull, w[s])
        for j in range(negatives):
            at = draw(seed, epoch, u[s], v[s], j, len(pool))
            other = np.flatnonzero(pool_ids[at] != u[s])
            gap = mine[other] - pool[at[other]]
            d2 = (gap * gap).sum(1)
            push = 2.0 * b / ((0.001 + d2) * (1.0 + a * d2 ** b))
            add(local[s][other], gap, push, w[s][other])
    return total, weight


def _packed(y: np.ndarray, whole: type) -> bytes:
    """Rounded coordinates as whole numbers; the least one stands for NaN."""
    lost = np.isnan(y)
    return np.where(lost, np.iinfo(whole).min, np.rint(np.where(lost, 0.0, y) * UNIT)).astype(whole).tobytes()


def _unpacked(y: bytes, whole: type, dims: int) -> np.ndarray:
    y = np.frombuffer(y, whole).reshape(-1, dims)
    return np.where(y == np.iinfo(whole).min, np.nan, y / UNIT)


@dataclass
class Grid:
    """The tasks of an epoch, by rows (of their edges' nodes) and columns (of
    the other ends)."""

    ranges: int
    rows: int
    columns: int

    def column(self, src: Column) -> Column:
        return F.floor(src * self.columns / self.ranges).cast("int")


def _edge_packs(graph: DataFrame, ids: DataFrame, n: int, dims: int, width: int) -> tuple[DataFrame, Grid]:
    """(task, col, range, part, u, v, w): the edges of every part, kept where
    its task runs (to be unpersisted), and the grid.  ``width``: bytes of a
    coordinate."""
    ranges = -(-n // NODES)
    grid = Grid(ranges, 1, max(1, min(ranges, -(-n * dims * width // STATE_BYTES))))
    number = lambda c: ids.select(F.col("id").alias(c), F.col("ix").alias("_" + c))
    both = graph.select("a", "b", "w").join(number("a"), "a").join(number("b"), "b")
    ends = both.select("w", F.explode(F.array(F.struct(F.col("_a").alias("u"), F.col("_b").alias("v")),
                                              F.struct(F.col("_b").alias("u"), F.col("_a").alias("v")))).alias("e"))
    edges = _cut(ends.select("e.u", "e.v", "w", F.floor(F.col("e.u") / NODES).cast("int").alias("range")))
    size = _cut(edges.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / EDGES).alias("parts")))
    most = size.agg(F.sum("n")).first()[0] or 0
    # a row of tasks has no more nodes than some share of a column, whose negatives are sent too
    grid.rows = min(max(ranges, 1), max(TASKS * -(-grid.columns // 5), -(-most // (TASK_EDGES * grid.columns))))
    col = grid.column(F.floor(F.col("v") / NODES))
    dealt = (edges.join(size.drop("n"), "range").withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int")).withColumn("col", col)
             .withColumn("task", F.pmod(F.col("range") + F.col("part"), F.lit(grid.rows)) * grid.columns + F.col("col")).drop("parts"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["u", "v"], kind="stable")
        return pd.DataFrame({**{c: [int(pdf[c].iloc[0])] for c in ("task", "col", "range", "part")},
                             **{c: [pdf[c].to_numpy(t).tobytes()] for c, t in (("u", np.int64), ("v", np.int64), ("w", np.float64))}})

    packs = dealt.groupBy("task", "col", "range", "part").applyInPandas(
        pack, "task int, col int, range int, part int, u binary, v binary, w binary")
    packs = packs.repartitionById(grid.rows * grid.columns, F.col("task")).persist(StorageLevel.DISK_ONLY)
    packs.count()  # how kept rows lie is known only then
    return packs, grid


def _epoch(state: DataFrame, packs: DataFrame, units: DataFrame, grid: Grid, dims: int, whole: type, a: float, b: float,
           seed: int, epoch: int, epochs: int, negatives: int) -> DataFrame:
    """The state (range, y) after an epoch; ``units``: (task, range) of the
    parts."""
    ranges, rows, columns = grid.ranges, grid.rows, grid.columns
    in_column = lambda c: F.explode(F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda r: (r * columns + c).cast("int"))).alias("task")
    if columns == 1:
        sent = state.select(in_column(F.lit(0)), "range", "y")
    else:
        drawn = F.udf(lambda own: [own, *negative_ranges(seed, epoch, own, ranges)], "array<int>")
        every = state.sparkSession.range(ranges).select(F.col("id").cast("int").alias("range"))
        wanted = (every.select(in_column(grid.column(F.col("range"))), "range")
                  .unionByName(units.select("task", F.explode(drawn("range")).alias("range"))).distinct())
        sent = state.join(wanted, "range").select("task", "range", "y")

    def move(edge: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        sums = []
        got = got.sort_values("range")
        ys = {int(r.range): _unpacked(r.y, whole, dims) for r in got.itertuples()}
        if len(edge):
            near, start = np.concatenate(list(ys.values())), np.zeros(ranges, dtype=np.int64)
            start[list(ys)] = np.cumsum([0, *map(len, ys.values())])[:-1]
        for part in edge.itertuples():
            u, v, w = (np.frombuffer(c, t) for c, t in ((part.u, np.int64), (part.v, np.int64), (part.w, np.float64)))
            pools = negative_ranges(seed, epoch, int(part.range), ranges)
            pool_ids = np.concatenate([r * NODES + np.arange(len(ys[r])) for r in pools])
            own = ys[int(part.range)]
            total, weight = forces(own, near[start[v // NODES] + v % NODES], np.concatenate([ys[r] for r in pools]), pool_ids, u % NODES,
                                   u, v, w, a, b, seed, epoch, negatives)
            sums.append((int(part.range), int(part.col), int(part.part), _packed(own, whole), total.tobytes(), weight.tobytes()))
        return pd.DataFrame(sums, columns=["range", "col", "part", "y", "total", "weight"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["col", "part"])
        y = _unpacked(pdf["y"].iloc[0], whole, dims)
        total = sum(np.frombuffer(t, np.float64).reshape(-1, dims) for t in pdf["total"])
        weight = sum(np.frombuffer(t, np.float64) for t in pdf["weight"])
        mean = total / np.where(weight > 0, weight, 1.0)[:, None]
        y = y + (1.0 - epoch / float(epochs)) * mean
        return pd.DataFrame({"range": [int(pdf["range"].iloc[0])], "y": [_packed(y, whole)]})

    moved = (packs.groupBy("task").cogroup(sent.repartitionById(rows * columns, F.col("task")).groupBy("task"))
             .applyInPandas(move, "range int, col int, part int, y binary, total binary, weight binary"))
    return moved.groupBy("range").applyInPandas(add, "range int, y binary")


def umap_reduce(df: DataFrame, id_col: str, vec_col: str, n_components: int = 20, n_neighbors: int = 30,
                min_dist: float = 0.0, metric: str = "cosine", seed: int = 42, n_epochs: int = 50,
                negative_rate: int = 5) -> DataFrame:
    """(id, embedding array<double>); ids are unique longs.  The dimensions
    are the vectors' where ``n_components`` is more; points without a
    neighbour keep their initial place, an empty table gives no rows."""
    points = _cut(df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("_v")))
    first = points.select(F.size("_v")).first()
    if first is None:
        return df.sparkSession.createDataFrame([], "id long, embedding array<double>")
    dims = min(n_components, first[0])
    a, b = curve_params(min_dist)
    graph = _cut(fuzzy_graph(knn(points, "id", "_v", n_neighbors, metric), n_neighbors))
    # dense index: node number = global rank of the id
    ids = _cut(global_rank(points.select("id"), ["id"], "ix").withColumn("ix", F.col("ix") - 1))
    n = ids.count()
    whole = np.int32 if n_epochs <= 1000 else np.int64  # an epoch moves a node by its rate times 4 at most, from within 10
    init = _cut(pca_reduce(points, "_v", n_components, "y").select("id", "y"))
    ext = init.select(F.explode("y").alias("v")).agg(F.max(F.abs("v"))).first()[0] or 1.0
    start = init.join(ids, "id").select("ix", F.transform("y", lambda v: F.round(v * 10.0 / ext, 6)).alias("y"))

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ix")
        return pd.DataFrame({"range": [int(pdf["range"].iloc[0])], "y": [_packed(np.array(pdf["y"].tolist(), dtype=np.float64), whole)]})

    state = _cut(start.withColumn("range", F.floor(F.col("ix") / NODES).cast("int")).groupBy("range").applyInPandas(gather, "range int, y binary"))
    packs, grid = _edge_packs(graph, ids, n, dims, np.dtype(whole).itemsize)
    try:
        units = _cut(packs.select("task", "range"))
        linked = units.select("range").distinct()
        still = _cut(state.join(linked, "range", "left_anti"))  # ranges without an edge stay
        state = state.join(linked, "range", "left_semi")
        for epoch in range(n_epochs):
            state = _epoch(state.unionByName(still), packs, units, grid, dims, whole, a, b, seed, epoch, n_epochs, negative_rate)
            if (epoch + 1) % KEEP_EVERY == 0 or epoch + 1 == n_epochs:
                state = _cut(state)
    finally:
        packs.unpersist()

    def spread(pdfs):
        for pdf in pdfs:
            for r in pdf.itertuples():
                y = _unpacked(r.y, whole, dims)
                yield pd.DataFrame({"ix": r.range * NODES + np.arange(len(y)), "embedding": list(y)})

    out = state.unionByName(still).mapInPandas(spread, "ix long, embedding array<double>")
    return ids.join(out, "ix").select("id", "embedding")


def neighbour_overlap(high: DataFrame, low: DataFrame, k: int = 10) -> float:
    """Mean fraction of each point's k input-space neighbours that are also
    among its k layout neighbours (1 = perfect preservation)."""
    a = high.select("id", "nbr")
    b = low.select("id", "nbr")
    hit = a.join(b, ["id", "nbr"]).count()
    tot = a.count()
    return hit / max(tot, 1)
