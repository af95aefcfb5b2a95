"""Density clustering (HDBSCAN, Campello et al. 2013; McInnes & Healy 2017)
as relational work.

1. core distance = distance of the ``min_samples``-th neighbour, the point
   itself counting as the first (exact kNN on a metric index);
2. minimum spanning tree of the mutual-reachability graph: bounded Borůvka
   rounds on the neighbours and the same index;
3. the MST edges, ranked by (w, a, b), become the single-linkage dendrogram by
   tree contraction (``dendrogram``): log2 N rounds, whatever its depth;
4. edges with ``min_cluster_size`` points below them form the cluster tree;
   stability, EOM / leaf selection and the epsilon climb are aggregates and
   pointer jumps on it (EOM goes up the cluster tree chain by chain);
5. every edge points at the nearest selected cluster above it, and points
   take the label of their lowest edge.

Every rank is a level of the hierarchy, and nothing of it passes through the
driver.  Labels are numbered by the smallest point of each selected cluster
(in the dense index, i.e. id order)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marisnow.operators import graph
from marisnow.operators.graph import NEAR, _cut, _whole, followed, global_rank, merge_roots, mst_edges
from marisnow.operators.knn import knn
from marisnow.operators.metric import MetricIndex

#: clusters of a chain that one group folds at once
CHAIN = 65_536


def core_distances(points: DataFrame, id_col: str, vec_col: str, min_samples: int,
                   metric: str = "euclidean", block_rows: int | None = None) -> DataFrame:
    """(id, core): distance to the min_samples-th neighbour, self included."""
    return _core(knn(points, id_col, vec_col, min_samples, metric, include_self=True, block_rows=block_rows), min_samples)


def _core(near: DataFrame, min_samples: int) -> DataFrame:
    return near.filter(F.col("rank") <= min_samples).groupBy("id").agg(F.max("dist").alias("core"))


def mutual_reachability(points: DataFrame, id_col: str, vec_col: str, min_samples: int,
                        k: int | None = None, metric: str = "euclidean") -> DataFrame:
    """kNN edges (a, b, d, w) with w = max(core(a), core(b), d); one pass
    over the index gives core distances and neighbours."""
    k = k or min_samples
    near = _cut(knn(points, id_col, vec_col, max(min_samples, k + 1), metric, include_self=True))
    core = _cut(_core(near, min_samples))
    ca = core.select(F.col("id").alias("a"), F.col("core").alias("ca"))
    cb = core.select(F.col("id").alias("b"), F.col("core").alias("cb"))
    e = near.filter("id <> nbr").select(F.col("id").alias("a"), F.col("nbr").alias("b"), F.col("dist").alias("d"), "rank")
    # without the point itself a neighbour's rank falls by one where the point comes first
    place = F.row_number().over(Window.partitionBy("a").orderBy("rank"))
    e = e.withColumn("_place", place).filter(F.col("_place") <= k).drop("_place", "rank")
    return e.join(ca, "a").join(cb, "b").select("a", "b", "d", F.greatest("ca", "cb", "d").alias("w"))


def reachability_tree(points: DataFrame, id_col: str, vec_col: str, min_samples: int, metric: str = "euclidean",
                      block_rows: int | None = None) -> DataFrame:
    """Minimum spanning tree (a, b, w) of the mutual-reachability graph; one
    pass over the index gives core distances and the first rounds' edges."""
    index = MetricIndex(points, id_col, vec_col, metric, block_rows)
    near = _cut(index.knn(max(min_samples, NEAR + 1), include_self=True))
    withcore = _cut(points.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).join(_core(near, min_samples), "id"))
    return mst_edges(withcore, "id", "v", "core", metric, block_rows, index, near)


# ---------------------------------------------------------- the hierarchy ----

def _jump(ptr: DataFrame) -> DataFrame:
    """``(id, to)`` for pointers ``(id, p)`` whose stops point at themselves:
    the stop that each id reaches; a round follows four pointers at once, so
    log4(depth) rounds."""
    cur = _cut(ptr.select("id", F.col("p").alias("to")))
    if cur.count() <= graph.LOCAL_POINTS:
        return _cut(_whole(cur, lambda x: x.assign(to=followed(x["id"].to_numpy(), x["to"].to_numpy())), "id long, to long"))
    while True:
        def twice(df):
            return df.join(df.select(F.col("id").alias("to"), F.col("to").alias("far")), "to").select("id", F.col("far").alias("to"))
        before = cur.select("id", F.col("to").alias("was"))
        step = _cut(twice(twice(cur)).join(before, "id").select("id", "to", (F.col("to") != F.col("was")).alias("moved")))
        if step.filter("moved").isEmpty():
            return step.select("id", "to")
        cur = step.select("id", "to")


def _running(df: DataFrame, order: list[str], value: str, ranges: int | None = None) -> DataFrame:
    """``df`` plus ``pos`` (1-based) and ``cum`` (sum of ``value`` so far) in
    a total order: range partitions (``ranges``, or as many as the session
    makes), each with the totals of those before."""
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    tagged = _cut(dealt.sortWithinPartitions(*order).withColumn("_pid", F.spark_partition_id()))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offs = (tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"))
            .select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"),
                    F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s")))
    w = Window.partitionBy("_pid").orderBy(*order)
    own = tagged.repartitionById(ranges, F.col("_pid")) if ranges else tagged  # a range is a task's, not several
    return (own.join(F.broadcast(offs), "_pid")
            .withColumn("pos", F.row_number().over(w) + F.col("_n"))
            .withColumn("cum", F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_s"))
            .drop("_pid", "_n", "_s"))


def _merges(x: pd.DataFrame) -> pd.DataFrame:
    """``dendrogram`` of a tree that one task holds: the edges by rank, each
    joins the clusters of its ends."""
    x = x.sort_values("rank")
    ids = np.unique(x[["a", "b"]].to_numpy(np.int64))
    ranks = x["rank"].tolist()
    over = list(range(len(ids)))
    size, top, edge, parent = [1] * len(ids), [-1] * len(ids), [0] * len(ids), [None] * len(x)
    sizes = []
    for i, ends in enumerate(zip(np.searchsorted(ids, x["a"]).tolist(), np.searchsorted(ids, x["b"]).tolist())):
        heads = []
        for at in ends:
            head = at
            while over[head] != head:
                over[head] = over[over[head]]
                head = over[head]
            if top[head] < 0:
                edge[head] = ranks[i]
            else:
                parent[top[head]] = ranks[i]
            heads.append(head)
        small, large = sorted(heads, key=lambda h: size[h])
        over[small] = large
        size[large] += size[small]
        top[large] = i
        sizes.append(size[large])
    null = lambda n: pd.array([None] * n, dtype="Int64")
    return pd.concat([
        pd.DataFrame({"id": pd.array(ids, dtype="Int64"), "edge": pd.array(edge, dtype="Int64"), "rank": null(len(ids)), "w": np.nan,
                      "size": null(len(ids)), "parent": null(len(ids))}),
        pd.DataFrame({"id": null(len(x)), "edge": null(len(x)), "rank": pd.array(ranks, dtype="Int64"), "w": x["w"].to_numpy(),
                      "size": pd.array(sizes, dtype="Int64"), "parent": pd.array(parent, dtype="Int64")})])


def dendrogram(ranked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Single-linkage dendrogram of a spanning tree ``(a, b, w, rank)``:
    ``(rank, w, size, parent)`` per edge - the points below it and the rank of
    the edge above, null at the root - and ``(id, edge)``, each point's lowest
    edge.

    Each round every vertex's lowest edge is contracted, which leaves at most
    half the vertices.  A contracted edge belongs to the chain of the first
    (round, vertex) around it whose lowest outgoing edge ranks above it; that
    edge is the parent of the chain's top, and inside a chain the parent is the
    next edge by rank."""
    if ranked.count() < graph.LOCAL_POINTS:
        both = _cut(_whole(ranked.select("rank", "a", "b", "w"), _merges, "id long, edge long, rank long, w double, size long, parent long"))
        return both.filter("id is null").select("rank", "w", "size", "parent"), both.filter("id is not null").select("id", "edge")
    edges = _cut(ranked.select("rank", "a", "b"))
    pending = None  # contracted edges without a chain: (rank, v)
    placed: list[DataFrame] = []
    leaves = None
    while True:
        low = _cut(edges.select(F.explode(F.array("a", "b")).alias("v"), "rank").groupBy("v").agg(F.min("rank").alias("top")))
        if pending is None:
            leaves = low.select(F.col("v").alias("id"), F.col("top").alias("edge"))
        else:
            here = pending.join(low, "v", "left").withColumn("in", F.coalesce(F.col("rank") < F.col("top"), F.lit(True)))
            here = _cut(here)
            placed.append(here.filter("in").select("rank", F.lit(len(placed)).alias("level"), "v", "top"))
            pending = here.filter("not in").select("rank", "v")
        if low.isEmpty():
            break
        ends = edges.select("rank", F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")),
                                                      F.struct(F.col("b").alias("x"), F.col("a").alias("y")))).alias("e"))
        ptr = (ends.select(F.col("rank").alias("top"), F.col("e.x").alias("v"), F.col("e.y").alias("p"))
               .join(low, ["v", "top"]).select(F.col("v").alias("comp"), "p"))
        roots = merge_roots(_cut(ptr))
        to = lambda c: roots.select(F.col("c").alias(c), F.col("root").alias(c + "r"))
        chosen = low.select(F.col("top").alias("rank"), F.lit(True).alias("gone")).distinct()
        moved = _cut(edges.join(chosen, "rank", "left").join(to("a"), "a").join(to("b"), "b")
                     .select("rank", F.col("ar").alias("a"), F.col("br").alias("b"), F.col("gone").isNotNull().alias("gone")))
        new = moved.filter("gone").select("rank", F.col("a").alias("v"))
        if pending is not None:
            new = new.unionByName(pending.join(to("v"), "v").select("rank", F.col("vr").alias("v")))
        pending = _cut(new)
        edges = moved.filter("not gone").select("rank", "a", "b")
    # points that enter the chains, from the lowest level up
    points = leaves.groupBy(F.col("edge").alias("rank")).agg(F.count(F.lit(1)).alias("n"))
    chains = []
    for part in placed:
        own = points.groupBy("rank").agg(F.sum("n").alias("n"))
        part = _cut(part.join(own, "rank", "left").withColumn("own", F.coalesce("n", F.lit(0))).drop("n"))
        chains.append(part)
        total = part.groupBy("v").agg(F.first("top").alias("rank"), F.sum("own").alias("n"))
        points = _cut(points.unionByName(total.filter("rank is not null").select("rank", "n")))
    every = chains[0]
    for part in chains[1:]:
        every = every.unionByName(part)
    run = _cut(_running(every, ["level", "v", "rank"], "own"))
    base = run.groupBy("level", "v").agg(F.min(F.col("cum") - F.col("own")).alias("base"))
    above = run.select((F.col("pos") - 1).alias("pos"), F.col("rank").alias("up"), F.col("level").alias("l2"), F.col("v").alias("v2"))
    same = (F.col("level") == F.col("l2")) & (F.col("v") == F.col("v2"))
    out = (run.join(above, "pos", "left").join(base, ["level", "v"])
           .select("rank", (F.col("cum") - F.col("base")).alias("size"), F.when(same, F.col("up")).otherwise(F.col("top")).alias("parent")))
    return _cut(out.join(ranked.select("rank", "w"), "rank")), leaves


# ------------------------------------------------------- the cluster tree ----

def _lam(w: Column) -> Column:
    return F.when(w > 0, 1.0 / F.greatest(w, F.lit(1e-300))).otherwise(F.lit(1e300))


def cluster_tree(tree: DataFrame, min_cluster_size: int) -> DataFrame:
    """``(c, up, birth, stability)`` of the condensed tree: ``c`` is the rank
    of a cluster's top edge, ``up`` its parent cluster (null: the root)."""
    big = _cut(tree.filter(F.col("size") >= min_cluster_size))
    kids = big.filter("parent is not null").groupBy(F.col("parent").alias("rank")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("below"))
    big = _cut(big.join(kids, "rank", "left").withColumn("split", F.coalesce(F.col("n") == 2, F.lit(False))))
    over = big.select(F.col("rank").alias("parent"), F.col("split").alias("born"), F.col("w").alias("w_up"))
    big = _cut(big.join(over, "parent", "left").withColumn("head", F.coalesce("born", F.lit(True))))
    at = _jump(big.select(F.col("rank").alias("id"), F.when(F.col("head"), F.col("rank")).otherwise(F.col("parent")).alias("p")))
    at = at.select(F.col("id").alias("rank"), F.col("to").alias("c"))
    heads = big.filter("head").select(F.col("rank").alias("c"), "parent",
                                      F.when(F.col("parent").isNull(), 0.0).otherwise(_lam(F.col("w_up"))).alias("birth"))
    left = F.col("size") - F.when(F.col("n") == 1, F.col("below")).otherwise(0)
    mass = (big.join(at, "rank").join(heads.select("c", "birth"), "c")
            .groupBy("c").agg(F.sum(left * (_lam(F.col("w")) - F.col("birth"))).alias("stability")))
    up = at.select(F.col("rank").alias("parent"), F.col("c").alias("up"))
    return _cut(heads.join(mass, "c").join(up, "parent", "left").select("c", "up", "birth", "stability"))


def _nearest(tree: DataFrame, flagged: DataFrame) -> DataFrame:
    """``(c, above)``: each non-root cluster's nearest proper ancestor that is
    flagged, or the root."""
    stop = flagged.select("c", F.lit(True).alias("stop"))
    ptr = tree.join(stop, "c", "left").select(
        F.col("c").alias("id"), F.when(F.col("stop") | F.col("up").isNull(), F.col("c")).otherwise(F.col("up")).alias("p"))
    reach = _jump(ptr).select(F.col("id").alias("up"), F.col("to").alias("above"))
    return tree.filter("up is not null").join(reach, "up").select("c", "above")


def _topmost(tree: DataFrame, flagged: DataFrame) -> DataFrame:
    """Flagged clusters without a flagged proper ancestor."""
    root = tree.filter("up is null").select(F.col("c").alias("above"))
    return flagged.join(_nearest(tree, flagged).join(root, "above", "left_semi"), "c", "left_semi").select("c")


def _excess(inner: DataFrame, leaf: DataFrame) -> DataFrame:
    """``(c, up, value, wins)``: each cluster's best total of stabilities, and
    whether its own is no less than its children's.

    A round takes every chain at once: a cluster with both children done, and
    above it those that wait for this one child alone.  A chain is folded upward
    in one group, CHAIN clusters at most (the rest in the next round), so rounds
    are the logarithm of the clusters, not the levels of the tree."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("c")  # a parent's rank is greater
        value, values, wins = 0.0, [], []
        for own, known in zip(pdf["stability"], pdf["known"]):
            total = known + value
            value = max(own, total)
            values.append(value)
            wins.append(own >= total)
        return pd.DataFrame({"c": pdf["c"], "up": pdf["up"], "value": values, "wins": wins})

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        known: dict[int, float] = {}
        rows = []
        pdf = pdf.sort_values("c")
        for c, up, own, is_leaf in zip(pdf["c"].tolist(), pdf["up"].tolist(), pdf["stability"].tolist(), pdf["leaf"].tolist()):
            total = known.get(c, 0.0)
            value = own if is_leaf else max(own, total)
            known[up] = known.get(up, 0.0) + value
            rows.append((c, up, value, is_leaf or own >= total))
        return pd.DataFrame(rows, columns=["c", "up", "value", "wins"])

    both = _cut(inner.join(leaf.select("c", F.lit(True).alias("leaf")), "c", "left")
                .select("c", "up", "stability", F.coalesce("leaf", F.lit(False)).alias("leaf")))
    if both.count() <= CHAIN:  # all chains in one group
        return _cut(_whole(both, whole, "c long, up long, value double, wins boolean"))
    fresh = _cut(leaf.select("c", "up", F.col("stability").alias("value"), F.lit(True).alias("wins")))
    left = inner.join(leaf, "c", "left_anti").select("c", "up", "stability", F.lit(0.0).alias("known"), F.lit(0).cast("long").alias("n"))
    every = fresh
    while True:
        told = fresh.groupBy(F.col("up").alias("c")).agg(F.sum("value").alias("more"), F.count(F.lit(1)).alias("m"))
        left = _cut(left.join(fresh.select("c"), "c", "left_anti").join(told, "c", "left")
                    .select("c", "up", "stability", (F.col("known") + F.coalesce("more", F.lit(0.0))).alias("known"),
                            (F.col("n") + F.coalesce("m", F.lit(0))).alias("n")))
        if left.isEmpty():
            return every
        kids = left.select(F.col("up").alias("c"), F.col("c").alias("kid"))
        ptr = (left.filter("n = 1").join(kids, "c").select(F.col("c").alias("id"), F.col("kid").alias("p"))
               .unionByName(left.filter("n <> 1").select(F.col("c").alias("id"), F.col("c").alias("p"))))
        low = _jump(ptr).select(F.col("id").alias("c"), F.col("to").alias("low"))
        ready = left.filter("n = 2").select(F.col("c").alias("low"))
        place = F.row_number().over(Window.partitionBy("low").orderBy("c"))
        chain = left.join(low, "c").join(ready, "low", "left_semi").withColumn("place", place).filter(F.col("place") <= CHAIN)
        fresh = _cut(chain.groupBy("low").applyInPandas(fold, "c long, up long, value double, wins boolean"))
        every = every.unionByName(fresh)


def select_clusters(tree: DataFrame, method: str = "eom", epsilon: float = 0.0) -> DataFrame:
    """``(c)``: the selected clusters (never the root)."""
    inner = tree.filter("up is not null")
    parents = inner.select(F.col("up").alias("c")).distinct()
    leaf = inner.join(parents, "c", "left_anti")
    if method == "leaf":
        chosen = _cut(leaf.select("c"))
    elif method == "eom":
        every = _excess(inner, leaf)
        chosen = _cut(_topmost(tree, every.filter("wins").select("c")))
    else:
        raise ValueError("cluster_selection_method must be 'eom' or 'leaf'")
    if epsilon and epsilon > 0:
        root = tree.filter("up is null").select(F.col("c").alias("up"), F.lit(True).alias("at_root"))
        climb = F.col("at_root").isNull() & (F.col("birth") > 0) & (1.0 / F.col("birth") < epsilon)
        ptr = inner.join(root, "up", "left").select(F.col("c").alias("id"), F.when(climb, F.col("up")).otherwise(F.col("c")).alias("p"))
        lifted = _jump(ptr).join(chosen.select(F.col("c").alias("id")), "id", "left_semi").select(F.col("to").alias("c")).distinct()
        chosen = _cut(_topmost(tree, _cut(lifted)))
    return chosen


def hdbscan(points: DataFrame, id_col: str, vec_col: str, min_cluster_size: int = 100,
            min_samples: int | None = None, cluster_selection_epsilon: float = 0.0,
            cluster_selection_method: str = "eom", metric: str = "euclidean", block_rows: int | None = None) -> DataFrame:
    """(id, cluster_raw): density clusters, -1 = noise."""
    if min_cluster_size < 2:
        raise ValueError("min_cluster_size must be >= 2")
    ms = min_samples or min_cluster_size
    # dense point index 0..N-1 in id order (any id domain); original ids are joined back at the end
    raw = points.select(F.col(id_col).cast("long").alias("orig"), F.col(vec_col).alias("v"))
    dense = _cut(global_rank(raw, ["orig"], "id").withColumn("id", F.col("id") - 1))
    pts = dense.select("id", "v")
    tree = _cut(reachability_tree(pts, "id", "v", ms, metric, block_rows))
    ids = dense.select("id", "orig")
    if tree.isEmpty():
        return ids.select(F.col("orig").alias("id"), F.lit(-1).alias("cluster_raw"))
    ranked = _cut(global_rank(tree, ["w", "a", "b"]))
    linkage, leaves = dendrogram(ranked)
    chosen = select_clusters(cluster_tree(linkage, min_cluster_size), cluster_selection_method, cluster_selection_epsilon)
    stop = chosen.select(F.col("c").alias("rank"), F.lit(True).alias("stop"))
    ptr = linkage.join(stop, "rank", "left").select(
        F.col("rank").alias("id"), F.when(F.col("stop") | F.col("parent").isNull(), F.col("rank")).otherwise(F.col("parent")).alias("p"))
    reach = _jump(ptr).select(F.col("id").alias("edge"), F.col("to").alias("c"))
    member = _cut(leaves.join(reach, "edge").join(chosen, "c", "left_semi").select("id", "c"))
    number = global_rank(member.groupBy("c").agg(F.min("id").alias("least")), ["least"], "n")
    label = member.join(number.select("c", (F.col("n") - 1).cast("int").alias("cluster_raw")), "c").select("id", "cluster_raw")
    return ids.join(label, "id", "left").select(F.col("orig").alias("id"), F.coalesce("cluster_raw", F.lit(-1)).alias("cluster_raw"))
