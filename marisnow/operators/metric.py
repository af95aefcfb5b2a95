"""Exact metric index: pivot cells with radii, searched by triangle inequality.

Build
-----
Pivots are the k-means centres of a bounded sample; every point goes to the
cell of its nearest pivot, and each cell knows its size and radius (one row
per cell, at most MAX_PIVOTS).  A cell is dealt into parts of bounded size,
each packed into one row of matrices.

Search
------
A part of query points meets other parts only where it has to.  For a query q
and a cell with pivot p and radius r no point of the cell is closer than

    max(d(q, p) - r, (d(q, p)^2 - d(q, own)^2) / (2 d(p, own)))

(``own`` is q's nearest pivot; the second term is the distance to the plane
between both pivots, which no point of the cell crosses).  ``knn`` visits the
nearest cells first and then every cell whose bound does not exceed the
query's k-th distance so far, where one product of single precision tells the
few pairs within it; ``outside`` visits the cells that may hold a
lighter edge out of the query's component.  Near parts form groups, about
GROUPS of them until a group would exceed GROUP_BYTES.  A task meets a group of
queries with a group of points: a query goes once to each group that has a part
it visits, and a part once to each group that asks for it, so what is shuffled
is the points times the groups at most.  A task gives each query's best only.

Cosine distance is half the squared chord of unit vectors, so its bounds are
those of the chord; a zero vector is at distance 1 from everything.  Distances
that are returned are computed from differences (or products) component by
component: both directions of a pair agree to the last bit."""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marisnow.session import materialize

log = logging.getLogger(__name__)

#: points in a cell on average: as many, or CELL_ROOT times the root of all, which balances the bounds' sharpness
#: against the copies that pairs of parts make; points in a part at most (on average), cells, values in the table of pivots
CELL_ROWS, CELL_ROOT, PART_ROWS, MAX_PIVOTS, MAX_PIVOT_VALUES = 512, 8, 2048, 4096, 4_000_000
#: groups of parts that the points are dealt into, values of their vectors in bytes at most (a part at least)
GROUPS, GROUP_BYTES = 8, 32 << 20
#: tasks that pairs of groups are dealt into at most
MAX_TASKS = 1024
#: points that the pivots are fitted on, in the order of a hash of the id
SAMPLE, ROUNDS = 16_384, 6
#: points that a query meets before it has a bound, at least
BUDGET = 1024
#: bounds are loosened by this share of the largest length (blocked products round)
SLACK = 1e-7
#: pairs a query within reach of it in a block, on average, that are looked at one by one
CLOSE = 64

PLACED = "id long, cell int, far double, vec binary"
ASKED = ("tg int, qg int, qc int, qp int, n int, met int, cells array<int>, wants binary, ids binary, vecs binary, reach binary, "
         "comps binary, cores binary")


def _rows(vecs: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(vecs, dtype=np.float64).reshape(-1, dims)


def _gaps(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Euclidean distances by one matrix product."""
    d2 = q @ c.T
    d2 *= -2.0
    d2 += (q * q).sum(1)[:, None]
    d2 += (c * c).sum(1)[None, :]
    np.maximum(d2, 0.0, out=d2)
    return np.sqrt(d2, out=d2)


def fast_distances(q: np.ndarray, c: np.ndarray, metric: str) -> np.ndarray:
    return 1.0 - q @ c.T if metric == "cosine" else _gaps(q, c)


def exact_distances(q: np.ndarray, c: np.ndarray, metric: str, rows: int = 20_000) -> np.ndarray:
    """Distances of paired rows, the same whichever side comes first."""
    out = np.empty(len(q))
    for lo in range(0, len(q), rows):
        a, b = q[lo:lo + rows], c[lo:lo + rows]
        out[lo:lo + rows] = 1.0 - (a * b).sum(1) if metric == "cosine" else np.sqrt(((a - b) ** 2).sum(1))
    return out


def centres(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 1) -> np.ndarray:
    """k-means centres; one that loses all points takes the farthest point."""
    c = x[np.random.default_rng(seed).permutation(len(x))[:k]].astype(float)
    for _ in range(rounds):
        d = _gaps(x, c)
        at = d.argmin(1)
        size = np.bincount(at, minlength=len(c))
        order = np.argsort(at, kind="stable")
        has = np.flatnonzero(size)
        heads = np.r_[0, np.cumsum(size[has])[:-1]]
        c[has] = np.add.reduceat(x[order], heads, axis=0) / size[has][:, None]
        empty = np.flatnonzero(size == 0)
        c[empty] = x[np.argsort(-d.min(1), kind="stable")[:len(empty)]]
    return c


def nearest_ties(d: np.ndarray, ids: np.ndarray, k: int, cap: np.ndarray, slack: float):
    """(row, column) of entries that may be among a row's ``k`` least and do
    not exceed its ``cap``, both loosened by ``slack``."""
    near = d <= (cap + slack)[:, None]
    many = np.flatnonzero(np.count_nonzero(near, axis=1) > k)
    if len(many):
        high = np.minimum(cap[many], np.partition(d[many], k - 1, axis=1)[:, k - 1])
        near[many] = d[many] <= (high + slack)[:, None]
    return np.nonzero(near)


def within(q: np.ndarray, c: np.ndarray, cap: np.ndarray):
    """(row, column) of all pairs of Euclidean distance ``cap`` (of the row) at
    most, and a few beyond; None where these are more than CLOSE a query, or
    lengths beyond single precision.  One product of that precision, its error
    added to the caps."""
    mid = c.mean(axis=0)
    q, c = q - mid, c - mid
    qq, cc = (q * q).sum(1), (c * c).sum(1)
    if not max(qq.max(initial=0.0), cc.max(initial=0.0)) < 1e30:  # also where a component is no number
        return None
    error = (q.shape[1] + 8) * 2.0 ** -22 * (qq + cc.max(initial=0.0)) + 1e-36
    # d^2 - |q|^2 = |c|^2 - 2 q c, the norm as one more component
    d = np.column_stack([-2.0 * q, np.ones(len(q))]).astype(np.float32) @ np.column_stack([c, cc]).astype(np.float32).T
    near = d <= (cap * cap - qq + error).astype(np.float32)[:, None]
    return np.nonzero(near) if np.count_nonzero(near) <= CLOSE * len(q) else None


@dataclass
class Cells:
    """What a task needs to know of the index: one row per cell."""

    pivots: np.ndarray
    count: np.ndarray
    radius: np.ndarray
    metric: str
    dims: int
    slack: float

    def unit(self, x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12) if self.metric == "cosine" else x

    def parts(self) -> np.ndarray:
        return _parts(self.count)

    def reach(self, distance: np.ndarray) -> np.ndarray:
        """A distance as a length in the space of the bounds."""
        return np.sqrt(2.0 * np.maximum(distance, 0.0)) if self.metric == "cosine" else distance

    def least(self, q: np.ndarray) -> np.ndarray:
        """Lower bounds (queries x cells)."""
        d = _gaps(q, self.pivots)
        own = d.argmin(1)
        between = _gaps(self.pivots, self.pivots)[own]
        plane = (d ** 2 - d[np.arange(len(q)), own][:, None] ** 2) / (2.0 * np.maximum(between, 1e-300))
        plane[between <= 0] = 0.0
        return np.maximum(np.maximum(d - self.radius, plane), 0.0)

    def around(self, cell: int, budget: int) -> np.ndarray:
        """Cells around a pivot that hold at least ``budget`` points."""
        order = np.argsort(_gaps(self.pivots[cell:cell + 1], self.pivots)[0], kind="stable")
        order = np.r_[cell, order[order != cell]]
        order = order[self.count[order] > 0]
        return order[:int(np.searchsorted(np.cumsum(self.count[order]), budget)) + 1]


def _parts(count: np.ndarray) -> np.ndarray:
    return np.maximum(1, -(-count // PART_ROWS))


def _along(x: np.ndarray) -> np.ndarray:
    """An order of the rows that keeps near ones together: halves along the
    widest dimension, down to pairs."""
    out, left = [], [np.arange(len(x))]
    while left:
        at = left.pop()
        if len(at) <= 2:
            out.append(at)
            continue
        at = at[np.argsort(x[at, int(x[at].var(0).argmax())], kind="stable")]
        left += [at[len(at) // 2:], at[:len(at) // 2]]
    return np.concatenate(out)


class Groups:
    """Near parts dealt into groups, from the cells' pivots and sizes."""

    def __init__(self, pivots: np.ndarray, count: np.ndarray, dims: int):
        self.count, self.parts = count, _parts(count)
        order = _along(pivots) if len(pivots) else np.zeros(0, dtype=int)
        self.start = np.zeros(len(count))
        self.start[order] = np.cumsum(count[order]) - count[order]
        self.rows = max(1, min(max(PART_ROWS, math.ceil(count.sum() / GROUPS)), GROUP_BYTES // (8 * max(dims, 1))))
        self.n = max(1, math.ceil(count.sum() / self.rows))

    def of(self, cell: int, part: int) -> int:
        return int((self.start[cell] + part * self.count[cell] / self.parts[cell]) // self.rows)

    def columns(self) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """For each group its cells, and how many parts of each it has."""
        have: dict[int, dict[int, int]] = {}
        for cell in np.flatnonzero(self.count):
            for part in range(int(self.parts[cell])):
                at = have.setdefault(self.of(cell, part), {})
                at[int(cell)] = at.get(int(cell), 0) + 1
        return {g: (np.array(list(c), dtype=int), np.array(list(c.values()))) for g, c in have.items()}


class MetricIndex:
    """Index of the points ``(id_col, vec_col)``; ids are longs, vectors of
    one length."""

    def __init__(self, df: DataFrame, id_col: str, vec_col: str, metric: str = "euclidean", cell_rows: int | None = None):
        if metric not in ("euclidean", "cosine"):
            raise ValueError(f"unknown metric {metric}")
        self.spark, self.metric = df.sparkSession, metric
        self._searches: list[tuple[str, DataFrame, DataFrame]] = []
        rows = self._points(df, id_col, vec_col)
        first = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
        self.n, self.dims = int(first["n"]), int(first["d"] or 0)
        most = max(1, min(MAX_PIVOTS, MAX_PIVOT_VALUES // max(self.dims, 1)))
        cell_rows = cell_rows or max(CELL_ROWS, int(CELL_ROOT * self.n ** 0.5))
        k = max(1, min(most, math.ceil(self.n / cell_rows)))
        x = rows.orderBy(F.xxhash64("id"), "id").limit(max(k, SAMPLE) if k > 1 else 1).select("v").toPandas()["v"]
        cells = Cells(np.zeros((0, self.dims)), np.zeros(0), np.zeros(0), metric, self.dims, 0.0)
        x = cells.unit(np.array([np.asarray(v, dtype=float) for v in x]).reshape(len(x), self.dims))
        cells.pivots = centres(x, k) if len(x) > 1 else x
        self.cells = cells
        self.base = self._placed(rows)
        cells.count, cells.radius = self._counted(self.base)
        cells.slack = SLACK * (1.0 + float((np.linalg.norm(cells.pivots, axis=1) + cells.radius).max(initial=0.0)))
        self.base = self._parted(self.base, cells.count)
        self.groups = Groups(cells.pivots, cells.count, self.dims)
        self._packs = None

    # ------------------------------------------------------------ building --

    @staticmethod
    def _points(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))

    def _placed(self, rows: DataFrame) -> DataFrame:
        """(id, cell, far, vec, salt): each point's nearest pivot."""
        pivots, dims, unit = self.cells.pivots, self.dims, self.cells.unit

        def run(batches):
            for b in batches:
                x = unit(b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.float64))
                at = _gaps(x, pivots).argmin(1) if len(x) else np.zeros(0, dtype=int)
                far = np.sqrt(((x - pivots[at]) ** 2).sum(1)) if len(x) else np.zeros(0)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at.astype(np.int32)), pa.array(far),
                                                  pa.array([r.tobytes() for r in np.ascontiguousarray(x)], pa.binary())],
                                                 ["id", "cell", "far", "vec"])

        out = rows.select("id", "v").mapInArrow(run, PLACED).withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
        return materialize(out, self.spark, "metric-points")

    def _counted(self, placed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        k = len(self.cells.pivots)
        count, radius = np.zeros(k, dtype=np.int64), np.zeros(k)
        for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect():
            count[r["cell"]], radius[r["cell"]] = r["n"], r["far"]
        return count, radius

    def _parted(self, placed: DataFrame, count: np.ndarray) -> DataFrame:
        parts = _parts(count)
        split = [(int(c), int(parts[c])) for c in np.flatnonzero(parts > 1)]
        if not split:
            return placed.withColumn("part", F.lit(0))
        many = self.spark.createDataFrame(split, "cell int, parts int")  # one row per large cell
        return (placed.join(F.broadcast(many), "cell", "left")
                .withColumn("part", F.pmod("salt", F.coalesce("parts", F.lit(1)).cast("long")).cast("int")).drop("parts"))

    def _pack(self, points: DataFrame, groups: Groups | None = None) -> DataFrame:
        """One row per (cell, part), with its group; points by id."""
        have, groups = set(points.columns), groups or self.groups

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("id", kind="stable")
            column = lambda c, t: pdf[c].to_numpy(t).tobytes() if c in have else b""
            cell, part = int(pdf["cell"].iloc[0]), int(pdf["part"].iloc[0])
            return pd.DataFrame({"grp": [groups.of(cell, part)], "cell": [cell], "part": [part], "n": [len(pdf)],
                                 "ids": [column("id", np.int64)], "vecs": [b"".join(pdf["vec"])], "reach": [column("reach", np.float64)],
                                 "comps": [column("comp", np.int64)], "cores": [column("core", np.float64)]})

        return points.groupBy("cell", "part").applyInPandas(
            run, "grp int, cell int, part int, n int, ids binary, vecs binary, reach binary, comps binary, cores binary")

    @property
    def packs(self) -> DataFrame:
        if self._packs is None:
            self._packs = materialize(self._pack(self.base.select("cell", "part", "id", "vec")), self.spark, "metric-packs")
        return self._packs

    @property
    def visited(self) -> list[tuple[str, int, int]]:
        """For each search its name, the pairs of parts that it met, and how
        many there are in all (counted when asked for)."""
        parts = int(self.cells.parts()[self.cells.count > 0].sum())
        return [(name, asked.agg(F.sum("met")).first()[0] or 0, parts * queries.count()) for name, asked, queries in self._searches]

    # -------------------------------------------------------------- search --

    def _ask(self, queries: DataFrame, choose, name: str) -> DataFrame:
        """The groups that packed queries ask for: ``choose(cell, row, vecs)``
        says which query wants which cell (queries x cells)."""
        dims, columns = self.dims, self.groups.columns()

        def run(pdfs):
            for pdf in pdfs:
                for row in pdf.itertuples():
                    vecs = _rows(row.vecs, dims)
                    given = [np.frombuffer(c, t) for c, t in ((row.ids, np.int64), (row.reach, np.float64), (row.comps, np.int64), (row.cores, np.float64))]
                    wants, out = choose(int(row.cell), row, vecs), []
                    for group, (cells, parts) in columns.items():
                        here = wants[:, cells]
                        used, at = here.any(0), np.flatnonzero(here.any(1))
                        if len(at):
                            ids, reach, comps, cores = (c[at].tobytes() if len(c) else b"" for c in given)
                            bits = np.packbits(here[np.ix_(at, np.flatnonzero(used))], axis=0).tobytes()
                            out.append((group, int(row.grp), int(row.cell), int(row.part), len(at), int(parts[used].sum()), cells[used].tolist(),
                                        bits, ids, vecs[at].tobytes(), reach, comps, cores))
                    if out:
                        yield pd.DataFrame(out, columns=[c.split()[0] for c in ASKED.split(", ")])

        asked = materialize(queries.mapInPandas(run, ASKED), self.spark, "metric-asked")
        self._searches.append((name, asked, queries))
        return asked

    def _meet(self, asked: DataFrame, targets: DataFrame, fn, ddl: str) -> DataFrame:
        """``fn(parts, queries)`` for each pair of groups that meet."""
        wanted = asked.select(F.col("tg").alias("grp"), F.col("qg").alias("by"), F.explode("cells").alias("cell")).distinct()
        left = targets.join(F.broadcast(wanted), ["grp", "cell"])  # a row of ``wanted`` per cell and group of queries at most
        tasks = min(MAX_TASKS, self.groups.n ** 2)
        keyed = lambda df, *by: df.repartition(tasks, *by).groupBy(*by)
        return keyed(left, "grp", "by").cogroup(keyed(asked, "tg", "qg")).applyInPandas(fn, ddl)

    def knn(self, k: int, include_self: bool = False, queries: tuple[DataFrame, str, str] | None = None) -> DataFrame:
        """(id, nbr, rank, dist): the ``k`` nearest indexed points of every
        query (default: of every indexed point), ranked by (distance rounded
        to 1e-9, id); a point of the query's id counts if ``include_self``."""
        empty = self.spark.createDataFrame([], "id long, nbr long, rank int, dist double")
        if not self.n or k < 1:
            return empty
        cells, dims, metric, slack = self.cells, self.dims, self.metric, self.cells.slack
        if queries is None:
            asking, packs, groups = self.base, self.packs, self.groups
        else:
            asking = self._placed(self._points(*queries))
            count = self._counted(asking)[0]
            asking, groups = self._parted(asking, count), Groups(cells.pivots, count, dims)
            packs = materialize(self._pack(asking.select("cell", "part", "id", "vec"), groups), self.spark, "metric-queries")
        budget = max(BUDGET, 2 * (k + 1))

        def meet(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
            found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
            for row in q.itertuples():
                q_ids, q_vecs = np.frombuffer(row.ids, np.int64), _rows(row.vecs, dims)
                cap = np.frombuffer(row.reach, np.float64).copy() if len(row.reach) else np.full(len(q_ids), np.inf)
                best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)  # row, id, distance; k a row at most
                for block, at in _asked_blocks(x, row, cells.pivots):
                    ids, vecs = np.frombuffer(block.ids, np.int64), _rows(block.vecs, dims)
                    bound = cap[at] + slack
                    close = within(q_vecs[at], vecs, cells.reach(bound) + slack) if np.isfinite(bound).all() else None
                    if close is not None:
                        r, c = close
                        ok = (q_ids[at[r]] != ids[c]) | include_self
                    else:
                        d = fast_distances(q_vecs[at], vecs, metric)
                        if not include_self:
                            d[q_ids[at][:, None] == ids[None, :]] = np.inf
                        r, c = nearest_ties(d, ids, k, cap[at], slack)
                        ok = np.isfinite(d[r, c])
                    r, c = at[r[ok]], c[ok]
                    if not len(r):
                        continue
                    dist = exact_distances(q_vecs[r], vecs[c], metric)
                    ok = dist <= cap[r] + slack
                    r, c, dist = r[ok], c[ok], dist[ok]
                    r, nbr, dist = (np.concatenate(p) for p in zip(best, (r, ids[c], dist)))
                    order = np.lexsort((nbr, np.round(dist, 9), r))
                    r, nbr, dist = r[order], nbr[order], dist[order]
                    place = np.arange(len(r)) - np.searchsorted(r, r, side="left")
                    keep, last = place < k, place == k - 1
                    cap[r[last]] = np.minimum(cap[r[last]], dist[last] + 2e-9)
                    best = r[keep], nbr[keep], dist[keep]
                found.append((q_ids[best[0]], *best[1:]))
            return pd.DataFrame({n: np.concatenate(v) for n, v in zip(("id", "nbr", "dist"), zip(*found))})

        ddl = "id long, nbr long, dist double"

        def everyone(cell, row, vecs):
            wants = np.zeros((len(vecs), len(cells.pivots)), dtype=bool)
            wants[:, cells.around(cell, budget)] = True
            return wants

        if len(cells.pivots) == 1:  # nothing is left for a second round
            return _ranked(self._meet(self._ask(packs, everyone, f"knn {k}"), self.packs, meet, ddl), k)
        early = materialize(_ranked(self._meet(self._ask(packs, everyone, f"knn {k}, first cells"), self.packs, meet, ddl), k),
                            self.spark, "metric-found")
        tau = early.filter(F.col("rank") == k).select("id", F.col("dist").alias("reach"))
        capped = self._pack(asking.select("cell", "part", "id", "vec").join(tau, "id", "left")
                            .withColumn("reach", F.coalesce("reach", F.lit(float("inf")))), groups)
        capped = materialize(capped, self.spark, "metric-capped")

        def rest(cell, row, vecs):
            cap = cells.reach(np.frombuffer(row.reach, np.float64) + 2e-9) + slack
            may = cells.least(vecs) <= cap[:, None]
            may[:, cells.count == 0] = False
            may[:, cells.around(cell, budget)] = False
            return may

        late = self._meet(self._ask(capped, rest, f"knn {k}, bounded"), self.packs, meet, ddl)
        return _ranked(early.drop("rank").unionByName(late), k)

    def outside(self, state: DataFrame, need: DataFrame, budget: int | None = None, name: str = "outside") -> DataFrame:
        """(id, w, a, b): for each point of ``need`` (id, reach) its lightest
        edge to a point of another component, of weight ``reach`` at most;
        weight max(core, core, distance), ties by (a, b).  ``state``: (id,
        comp, core) of all points.  With ``budget`` only the nearest cells
        that hold as many points and not the own component alone."""
        points = self.base.select("cell", "part", "id", "vec").join(state, "id")
        info = points.groupBy("cell").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("core").alias("core")).collect()
        alone = np.full(len(self.cells.pivots), np.iinfo(np.int64).min)  # the component of cells that hold but one
        least_core = np.full(len(self.cells.pivots), np.inf)
        for r in info:
            least_core[r["cell"]] = r["core"]
            if r["lo"] == r["hi"]:
                alone[r["cell"]] = r["lo"]
        targets = materialize(self._pack(points), self.spark, "metric-state")
        queries = materialize(self._pack(points.join(need, "id")), self.spark, "metric-need")
        cells, dims, metric, slack = self.cells, self.dims, self.metric, self.cells.slack

        def choose(cell, row, vecs):
            reach, comps = np.frombuffer(row.reach, np.float64), np.frombuffer(row.comps, np.int64)
            least = cells.least(vecs)
            may = (cells.count > 0)[None, :] & (alone[None, :] != comps[:, None])
            if budget is None:
                may &= (least <= cells.reach(reach)[:, None] + slack) & (least_core[None, :] <= reach[:, None])
            else:
                for i in range(len(vecs)):
                    order = np.argsort(np.where(may[i], least[i], np.inf), kind="stable")[:int(may[i].sum())]
                    may[i] = False
                    may[i, order[:int(np.searchsorted(np.cumsum(cells.count[order]), budget)) + 1]] = True
            return may

        def meet(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
            out = []
            for row in q.itertuples():
                ids, vecs, comps = np.frombuffer(row.ids, np.int64), _rows(row.vecs, dims), np.frombuffer(row.comps, np.int64)
                own, reach = np.frombuffer(row.cores, np.float64), np.frombuffer(row.reach, np.float64).copy()
                for block, at in _asked_blocks(x, row, cells.pivots):
                    there = [np.frombuffer(block.ids, np.int64), _rows(block.vecs, dims), np.frombuffer(block.comps, np.int64),
                             np.frombuffer(block.cores, np.float64)]
                    value, times = np.unique(there[2], return_counts=True)
                    most = value[times.argmax()]  # queries of the block's largest component meet the other points only
                    for mine, foreign in ((at[comps[at] == most], there[2] != most), (at[comps[at] != most], np.ones(len(there[0]), bool))):
                        mine = mine[reach[mine] >= there[3].min()]
                        if not len(mine):
                            continue
                        seen = np.flatnonzero(foreign & (there[3] <= reach[mine].max()))
                        if not len(seen):
                            continue
                        got = lightest(ids[mine], vecs[mine], comps[mine], own[mine], reach[mine], *(t[seen] for t in there), metric, slack)
                        at_row = mine[got.pop("row").to_numpy(int)]
                        reach[at_row] = np.minimum(reach[at_row], got["w"])
                        out.append(got)
            if not out:
                return pd.DataFrame({"id": [], "w": [], "a": [], "b": []})
            return pd.concat(out).sort_values(["id", "w", "a", "b"]).drop_duplicates("id")

        found = self._meet(self._ask(queries, choose, name), targets, meet, "id long, w double, a long, b long")
        best = found.groupBy("id").agg(F.min(F.struct("w", "a", "b")).alias("e"))
        return best.select("id", "e.w", "e.a", "e.b")


def _asked_blocks(x: pd.DataFrame, row, pivots: np.ndarray):
    """(part, query numbers) for the parts of ``x`` that a row of ASKED wants,
    nearest cells first."""
    cells = np.asarray(row.cells, dtype=int)
    wants = np.unpackbits(np.frombuffer(row.wants, np.uint8).reshape(-1, len(cells)), axis=0, count=int(row.n)).astype(bool)
    far = dict(zip(cells.tolist(), _gaps(pivots[int(row.qc)][None, :], pivots[cells])[0]))
    column = {c: i for i, c in enumerate(cells.tolist())}
    blocks = [b for b in x.itertuples() if b.cell in column]
    for block in sorted(blocks, key=lambda b: (far[b.cell], b.cell, b.part)):
        yield block, np.flatnonzero(wants[:, column[block.cell]])


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("id").orderBy(F.round("dist", 9), "nbr")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("id", "nbr", "rank", "dist")


def lightest(q_ids, q_vecs, q_comps, q_cores, reach, ids, vecs, comps, cores, metric: str, slack: float) -> pd.DataFrame:
    """Per query its least edge in the order (w, a, b) to a row of another
    component, where that is at most ``reach``.  Weights that the cores decide
    are exact at once; those that the distance decides are computed anew where
    they may be the least."""
    d = fast_distances(q_vecs, vecs, metric)
    core = np.maximum(q_cores[:, None], cores[None, :])
    w = np.maximum(d, core)
    w[q_comps[:, None] == comps[None, :]] = np.inf
    least = np.minimum(w.min(axis=1), reach)
    near = (w <= (least + slack)[:, None]) & np.isfinite(w)
    r, c = np.nonzero(near & (d > core - slack))
    if len(r):
        w[r, c] = np.maximum(exact_distances(q_vecs[r], vecs[c], metric), core[r, c])
    w[~near] = np.inf
    least = w.min(axis=1)
    r, c = np.nonzero((w == least[:, None]) & (w <= reach[:, None]) & np.isfinite(w))
    a, b = np.minimum(q_ids[r], ids[c]), np.maximum(q_ids[r], ids[c])
    order = np.lexsort((b, a, r))
    first = order[np.flatnonzero(np.r_[True, r[order][1:] != r[order][:-1]])] if len(order) else order
    return pd.DataFrame({"row": r[first], "id": q_ids[r[first]], "w": least[r[first]], "a": a[first], "b": b[first]})
