"""Graph operators as joins and aggregates: connected components
(alternating large-star / small-star, Kiveris et al. 2014), a global
distributed rank, and the minimum spanning forest of the complete
mutual-reachability graph by bounded Borůvka rounds on a metric index.

Every iterative loop cuts lineage by writing its state as parquet under
``spark.checkpoint.dir`` (reliable, shared storage), so a lost executor
recomputes one round, not the whole history."""

from __future__ import annotations

import logging

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marisnow.operators.metric import BUDGET, MetricIndex
from marisnow.session import materialize

log = logging.getLogger(__name__)

#: neighbours of each point that the spanning tree starts from
NEAR = 12
#: rows of a range in passes over a total order, about
RANGE_ROWS = 131_072
#: points of a tree, or pointers, that one task takes together (beyond, they are joined), and edges beside them
LOCAL_POINTS, LOCAL_EDGES = 1 << 20, 3 << 20


def _cut(df: DataFrame) -> DataFrame:
    """Cut lineage: write the frame as parquet under the shared checkpoint
    folder and read it back (one job; ``Dataset.checkpoint`` would compute
    its input twice — once for the action, once to write the checkpoint)."""
    return materialize(df, name="cut")


def _whole(df: DataFrame, fn, ddl: str) -> DataFrame:
    """``fn`` of all rows of a written frame of bounded size, in one task."""

    def run(batches):
        rows = [b for b in batches if len(b)]
        if rows:
            yield fn(pd.concat(rows, ignore_index=True))

    return df.coalesce(1).mapInPandas(run, ddl)


def followed(ids: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Where the pointers ``ids -> to`` end: at one that points at itself, or
    at an id without a pointer."""
    order = np.argsort(ids, kind="stable")
    at = np.minimum(np.searchsorted(ids[order], to), max(len(ids) - 1, 0))
    step = np.where(ids[order[at]] == to, order[at], np.arange(len(ids)))
    while True:
        far = step[step]
        if (far == step).all():
            return to[step]
        step = far


def ranges_for(rows: int) -> int:
    """Ranges that so many rows are dealt into, each for one task."""
    return max(1, -(-rows // RANGE_ROWS))


def _sym(e: DataFrame) -> DataFrame:
    return e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) \
        .filter(F.col("u") != F.col("v")).distinct()


def _mark(e: DataFrame):
    """Row count and hash sum of a round's edges: equal marks, equal rounds."""
    return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst",
                         vertices: DataFrame | None = None, vertex_col: str = "id") -> DataFrame:
    """(id, component) with component = smallest vertex id in the component.

    Edges are undirected; ids are integers.  Isolated ``vertices`` map to
    themselves.  Rounds are O(log^2 n); each is a few hash aggregates and
    joins, with AQE splitting the hub partition of a large star."""
    e = edges.select(F.col(src).cast("long").alias("u"), F.col(dst).cast("long").alias("v"))
    e = _cut(e.filter(F.col("u") != F.col("v")).distinct())
    mark = _mark(e)
    while True:
        s = _sym(e)
        # large star: link every larger neighbour of u to the min of u's neighbourhood
        m = s.groupBy("u").agg(F.min("v").alias("mv")).select("u", F.least("mv", "u").alias("m"))
        large = (s.join(m, "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        # used twice below; cached for the round only (the round's output is cut)
        large = large.filter(F.col("u") != F.col("v")).distinct().persist()
        # small star: link u and its smaller neighbours to the min of them
        s2 = _sym(large).filter(F.col("v") < F.col("u"))
        m2 = s2.groupBy("u").agg(F.min("v").alias("m"))
        small = (s2.join(m2, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(m2.select("u", F.col("m").alias("v"))))
        small = _cut(small.filter(F.col("u") != F.col("v")).distinct())
        large.unpersist()
        e, seen, mark = small, mark, _mark(small)
        if mark == seen:
            break
    # converged: each edge is (node, root) with root the component minimum
    comp = e.groupBy("u").agg(F.min("v").alias("component"))
    roots = e.select(F.col("v").alias("u")).distinct().join(comp, "u", "left_anti") \
        .select("u", F.col("u").alias("component"))
    out = comp.union(roots).select(F.col("u").alias(vertex_col), "component")
    if vertices is not None:
        iso = vertices.select(F.col(vertex_col).cast("long").alias(vertex_col)).distinct() \
            .join(out, vertex_col, "left_anti").withColumn("component", F.col(vertex_col))
        out = out.union(iso)
    return out


def global_rank(df: DataFrame, order: list[str], out: str = "rank") -> DataFrame:
    """1-based dense position in a total order, computed without a single
    task: range-partition by the order, count rows per partition, add the
    running offset of the (few) partition counts, then number rows inside
    each partition."""
    sorted_df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    tagged = sorted_df.withColumn("_pid", F.spark_partition_id())
    tagged = _cut(tagged)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.withColumn(
        "_off", F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
    w = Window.partitionBy("_pid").orderBy(*order)
    return (tagged.join(F.broadcast(offs.select("_pid", F.coalesce("_off", F.lit(0)).alias("_off"))), "_pid")
            .withColumn(out, F.row_number().over(w) + F.col("_off"))
            .drop("_pid", "_off"))


# ---------------------------------------------------------------- MST -------

def merge_roots(ptr: DataFrame) -> DataFrame:
    """(c, root) from Borůvka parent pointers (c -> p).  Every tree of
    pointers has one 2-cycle (two components that chose the same edge); its
    smaller id becomes the root, then pointer jumping p <- p(p) halves the
    depth each round until every pointer reaches its root."""
    back = ptr.select(F.col("comp").alias("p"), F.col("p").alias("pp"))
    p = (ptr.join(back, "p", "left")
         .select(F.col("comp").alias("c"),
                 F.when((F.col("pp") == F.col("comp")) & (F.col("comp") < F.col("p")), F.col("comp"))
                 .otherwise(F.col("p")).alias("root")))
    def twice(q: DataFrame) -> DataFrame:
        far = q.select(F.col("c").alias("root"), F.col("root").alias("far"))
        return q.join(far, "root", "left").select("c", F.coalesce("far", "root").alias("root"))

    p = _cut(p)
    if p.count() <= LOCAL_POINTS:
        return _cut(_whole(p, lambda x: x.assign(root=followed(x["c"].to_numpy(), x["root"].to_numpy())), "c long, root long"))
    while True:  # a round follows four pointers at once
        was = p.select("c", F.col("root").alias("was"))
        step = _cut(twice(twice(p)).join(was, "c").select("c", "root", (F.col("root") != F.col("was")).alias("moved")))
        p = step.select("c", "root")
        if step.filter("moved").isEmpty():
            return p


def mst_edges(points: DataFrame, id_col: str, vec_col: str, core_col: str | None = None,
              metric: str = "euclidean", block_rows: int | None = None, index: MetricIndex | None = None,
              near: DataFrame | None = None) -> DataFrame:
    """Minimum spanning tree (a, b, w) of the complete graph with weight
    max(core(a), core(b), d(a, b)) (plain distance when ``core_col`` is None),
    in the total order (w, a, b).

    Bounded Borůvka.  ``near``, the points' neighbours (``index.knn``, of one
    length), are the first edges.  Every point keeps a lower bound of the
    edges that are not listed: at first its last neighbour's distance.  In a
    round a component's lightest listed edge is its reach; only points whose
    bound does not exceed it search the index for a lighter edge, within the
    reach, and what they find (or the reach) is their new bound.  A component
    without a listed edge first gets a reach from one point's nearest foreign
    cells.  The chosen edges join the tree and the components merge by
    pointer jumping (``merge_roots``)."""
    spark = points.sparkSession
    index = index or MetricIndex(points, id_col, vec_col, metric, block_rows)
    near = near if near is not None else _cut(index.knn(NEAR, include_self=False))
    core = F.col(core_col).cast("double") if core_col else F.lit(0.0)
    cores = _cut(points.select(F.col(id_col).cast("long").alias("id"), core.alias("core")))
    k = near.agg(F.max("rank")).first()[0] or 0
    full = F.when(F.max("rank") == k, F.max("dist") - 1e-9).otherwise(F.lit(float("inf")))  # fewer: all are listed
    low = near.groupBy("id").agg((full if k < index.n - 1 else F.lit(float("inf"))).alias("low"))
    low = _cut(cores.join(low, "id", "left").select("id", F.greatest("core", F.coalesce("low", F.lit(0.0))).alias("low")))
    other = cores.select(F.col("id").alias("nbr"), F.col("core").alias("other"))
    edges = (near.filter(F.col("id") != F.col("nbr")).join(cores, "id").join(other, "nbr")
             .select(F.least("id", "nbr").alias("a"), F.greatest("id", "nbr").alias("b"), F.greatest("dist", "core", "other").alias("w")).distinct())
    if index.n <= LOCAL_POINTS:
        return _bounded_tree(cores.join(low, "id"), _thinned(_cut(edges)), index)  # a point without an id has no edges
    comp = cores.select("id", F.col("id").alias("comp"))
    rounds: list[DataFrame] = []
    while True:  # each round at least halves the components
        end = lambda c: comp.select(F.col("id").alias(c), F.col("comp").alias("c" + c))
        listed = _cut(edges.join(end("a"), "a").join(end("b"), "b").filter("ca <> cb"))
        best = _lightest(listed)
        state = _cut(comp.join(cores, "id").join(low, "id").join(best.select("comp", F.col("e.w").alias("reach")), "comp", "left"))
        blind = state.filter("reach is null")
        if not blind.isEmpty():  # no listed edge: a reach from one point of the component
            probe = blind.groupBy("comp").agg(F.min_by("id", F.struct("low", "id")).alias("id"))
            probe = probe.select("id", F.lit(float("inf")).alias("reach"))
            seen = _cut(index.outside(state.select("id", "comp", "core"), probe, BUDGET, "mst probe"))
            listed = _cut(listed.unionByName(_ends(seen, comp)))
            best = _lightest(listed)
            state = _cut(state.drop("reach").join(best.select("comp", F.col("e.w").alias("reach")), "comp", "left"))
        need = state.filter("low <= reach").select("id", "reach")
        if not need.isEmpty():
            found = _cut(index.outside(state.select("id", "comp", "core"), need, None, f"mst round {len(rounds) + 1}"))
            listed = _cut(listed.unionByName(_ends(found, comp)).distinct())
            best = _lightest(listed)
            better = need.join(found.select("id", "w"), "id", "left").select("id", F.coalesce("w", "reach").alias("now"))
            low = _cut(low.join(better, "id", "left").select("id", F.coalesce("now", "low").alias("low")))
        picked = _cut(best.select("comp", "e.a", "e.b", "e.w", "e.ca", "e.cb"))
        if picked.isEmpty():
            break  # one component left: no edge leaves it
        rounds.append(picked.select("a", "b", "w"))
        # each component chose exactly one edge: parent pointer to the component across it
        ptr = picked.select("comp", F.when(F.col("ca") == F.col("comp"), F.col("cb")).otherwise(F.col("ca")).alias("p"))
        roots = merge_roots(ptr)
        comp = _cut(comp.join(roots.withColumnRenamed("c", "comp"), "comp", "left")
                    .select("id", F.coalesce("root", "comp").alias("comp")))
        edges = listed.select("a", "b", "w")
    tree = spark.createDataFrame([], "a long, b long, w double")
    for r in rounds:
        tree = tree.union(r)
    return tree.distinct()


STATE = "kind int, id long, a long, b long, w double, core double, reach double"
#: kinds of rows of STATE: a listed edge (a, b, w); a point (id, its component a, its bound w, core, its component's reach); an edge
#: (a, b, w) that a search found for the point id; an edge (a, b, w) of the tree
LISTED, POINT, FOUND, CHOSEN = range(4)


def _rows(df: DataFrame, kind: int, **columns) -> DataFrame:
    return df.select(F.lit(kind).alias("kind"), *[F.coalesce(columns.get(c, F.lit(None)).cast(t), F.lit(0).cast(t)).alias(c)
                                                  for c, t in (x.split() for x in STATE.split(", ")[1:])])


def _edge_rows(df: DataFrame, kind: int, **more) -> DataFrame:
    return _rows(df, kind, a=F.col("a"), b=F.col("b"), w=F.col("w"), **more)


def _thinned(edges: DataFrame) -> DataFrame:
    """The written ``edges``; of more than LOCAL_EDGES each group's minimum
    spanning forest, where an edge that is the lightest of all between two sets
    of points always is."""

    def forest(e: pd.DataFrame) -> pd.DataFrame:
        ids = np.unique(e[["a", "b"]].to_numpy(np.int64))
        a, b, w = (np.searchsorted(ids, e["a"]), np.searchsorted(ids, e["b"]), e["w"].to_numpy(float))
        _, _, got = merged(len(ids), np.arange(len(ids)), a, b, w, np.full(len(ids), np.inf))
        return pd.DataFrame({"a": ids[got[0]], "b": ids[got[1]], "w": got[2]})

    groups = -(-2 * edges.count() // LOCAL_EDGES)
    if groups <= 2:
        return edges
    return _cut(edges.withColumn("_g", F.pmod(F.xxhash64("a"), F.lit(groups))).groupBy("_g").applyInPandas(forest, "a long, b long, w double"))


def merged(n: int, comp: np.ndarray, a: np.ndarray, b: np.ndarray, w: np.ndarray, low: np.ndarray, searched: bool = False):
    """Borůvka steps on the listed edges as far as they are certain: a
    component merges along its lightest listed edge while that is less than
    the bounds ``low`` of its points' other edges, or in the first step if all
    have been ``searched``.  Components are numbers of points.  Returns the
    components, the edges left (the lightest of each two components) and those
    chosen, both as (a, b, w) in the order (w, a, b)."""
    order = np.lexsort((b, a, w))
    a, b, w = a[order], b[order], w[order]
    chosen = [(a[:0], b[:0], w[:0])]
    while True:
        ca, cb = comp[a], comp[b]
        _, first = np.unique(np.minimum(ca, cb) * n + np.maximum(ca, cb), return_index=True)
        first.sort()
        first = first[ca[first] != cb[first]]
        a, b, w, ca, cb = a[first], b[first], w[first], ca[first], cb[first]
        best, least = np.full(n, len(a)), np.full(n, np.inf)
        np.minimum.at(best, ca, np.arange(len(a)))
        np.minimum.at(best, cb, np.arange(len(a)))
        np.minimum.at(least, comp, low)
        pick = np.flatnonzero(best < len(a))
        if not searched:
            pick = pick[least[pick] > w[best[pick]]]
        searched = False
        if not len(pick):
            reach = np.full(n, np.inf)
            has = np.flatnonzero(best < len(a))
            reach[has] = w[best[has]]
            return comp, (a, b, w, reach[comp]), tuple(np.concatenate(c) for c in zip(*chosen))
        at = best[pick]
        used = np.unique(at)
        chosen.append((a[used], b[used], w[used]))
        to = np.arange(n)
        to[pick] = ca[at] + cb[at] - pick
        to = np.where((to[to] == np.arange(n)) & (np.arange(n) < to), np.arange(n), to)  # two that chose one edge: the smaller is the root
        comp = followed(np.arange(n), to)[comp]


def _merge_step(searched: bool, merge: bool = True):
    """STATE rows -> STATE rows: what was found becomes listed and bounds the
    point's other edges, and components merge as far as that is certain."""

    def step(x: pd.DataFrame) -> pd.DataFrame:
        kind = x["kind"].to_numpy()
        p = x[kind == POINT].sort_values("id")
        e, found = x[(kind == LISTED) | (kind == FOUND)], x[kind == FOUND]
        ids, core, low, reach = (p[c].to_numpy().copy() for c in ("id", "core", "w", "reach"))
        if searched:
            low = np.where(low <= reach, reach, low)
            low[np.searchsorted(ids, found["id"])] = found["w"]
        at = lambda c: np.searchsorted(ids, c.to_numpy())
        comp, left, got = merged(len(ids), at(p["a"]), at(e["a"]), at(e["b"]), e["w"].to_numpy(), low if merge else np.full(len(ids), -np.inf), searched)
        zero = lambda n: np.zeros(n)
        frames = [pd.DataFrame({"kind": POINT, "id": ids, "a": ids[comp], "b": 0, "w": low, "core": core, "reach": left[3]})]
        for k, (a, b, w) in ((LISTED, left[:3]), (CHOSEN, got)):
            frames.append(pd.DataFrame({"kind": k, "id": 0, "a": ids[a], "b": ids[b], "w": w, "core": zero(len(a)), "reach": zero(len(a))}))
        return pd.concat(frames)

    return step


def _bounded_tree(points: DataFrame, edges: DataFrame, index: MetricIndex) -> DataFrame:
    """``mst_edges`` from points (id, core, low) and listed edges, while one
    task holds them all (LOCAL_POINTS): the components merge there as far as
    the listed edges make certain, so only what is left needs a search."""
    state = _cut(_rows(points, POINT, id=F.col("id"), a=F.col("id"), w=F.col("low"), core=F.col("core")).unionByName(_edge_rows(edges, LISTED)))
    tree: list[DataFrame] = []
    searched = False
    while True:
        state = _cut(_whole(state, _merge_step(searched), STATE))
        tree.append(state.filter(F.col("kind") == CHOSEN).select("a", "b", "w"))
        state = state.filter(F.col("kind") != CHOSEN)
        point = F.col("kind") == POINT
        one, blind = state.filter(point).agg(F.min("a") == F.max("a"), F.max(F.col("reach") == float("inf"))).first()
        if one is None or one:
            break
        known = lambda: state.filter(point).select("id", F.col("a").alias("comp"), "core")
        if blind:  # no listed edge: a reach from one point of the component
            probe = state.filter(point & (F.col("reach") == float("inf"))).groupBy("a").agg(F.min_by("id", F.struct("w", "id")).alias("id"))
            seen = _cut(index.outside(known(), probe.select("id", F.lit(float("inf")).alias("reach")), BUDGET, "mst probe"))
            state = _cut(_whole(state.unionByName(_edge_rows(seen, LISTED)), _merge_step(False, False), STATE))
        need = state.filter(point & (F.col("w") <= F.col("reach"))).select("id", "reach")
        found = _cut(index.outside(known(), need, None, f"mst round {len(tree)}"))
        state = state.unionByName(_edge_rows(found, FOUND, id=F.col("id")))
        searched = True
    out = tree[0]
    for t in tree[1:]:
        out = out.unionByName(t)
    return out


def _ends(found: DataFrame, comp: DataFrame) -> DataFrame:
    """Edges (a, b, w) with the components of both ends."""
    e = found.select("a", "b", "w").distinct()
    for c in ("a", "b"):
        e = e.join(comp.select(F.col("id").alias(c), F.col("comp").alias("c" + c)), c)
    return e.select("a", "b", "w", "ca", "cb")


def _lightest(listed: DataFrame) -> DataFrame:
    """(comp, e): each component's lightest edge that leaves it."""
    both = listed.select("w", "a", "b", "ca", "cb", F.explode(F.array("ca", "cb")).alias("comp"))
    return both.groupBy("comp").agg(F.min(F.struct("w", "a", "b", "ca", "cb")).alias("e"))
