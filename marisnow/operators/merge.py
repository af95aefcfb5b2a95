"""Merging clusters by their closest centroids, for any number of clusters.

The rule is greedy: the closest pair of mean centroids, ties by (a, b), is
merged into its smaller id, the mean is taken anew, and so on until
``max_clusters`` remain.  Merges of clusters that never come near each other
do not depend on one another, so a round does many of them at once:

1. a limit is chosen among the weights of the centroids' spanning tree
   (``graph.mst_edges`` on the metric index); the tree's edges up to it give
   groups, and centroids of different groups are further apart than the limit;
2. every group makes its own greedy merges up to the limit, in one task of at
   most ``GROUP`` clusters;
3. a mean can move towards another group.  The index is asked whether any
   mean that arose comes within the limit of another group; groups that do
   are joined and merged anew.  Without such a pair the groups' merges are
   those of the whole;
4. the whole order is the groups' sequences merged by their least next pair,
   which is the order of each merge's running maximum (w, a, b) in its group.
   Where fewer merges are wanted than were made, the first of these stay.

Limits at which a group would be too large are lowered; where the lightest
pairs alone make one (thousands of equal centroids) a round does one merge.
Up to ``GROUP`` clusters are a single group without a limit.  Summaries stay
in tables of the checkpoint folder; the driver sees counts and limits."""

from __future__ import annotations

import logging

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marisnow.operators.graph import _cut, connected_components, global_rank, mst_edges
from marisnow.operators.metric import MetricIndex

log = logging.getLogger(__name__)

#: clusters of a group at most: a task holds their distances, GROUP x GROUP doubles
GROUP = 2048

MERGES = "comp long, seq long, a long, b long, w double, pw double, pa long, pb long, n long, vsum array<double>"


def greedy_merges(ids: np.ndarray, n: np.ndarray, sums: np.ndarray, most: int, limit: float = np.inf):
    """Yields (a, b, w, n, sum) of up to ``most`` greedy merges of weight
    ``limit`` at most; ``ids`` ascend.  Every row keeps its least distance to
    a larger id, and only rows whose least was touched are searched again."""
    n, sums = n.astype(np.int64), sums.astype(np.float64)
    mean = sums / n[:, None]
    size = len(ids)
    far = np.full((size, size), np.inf)
    for i in range(size - 1):
        far[i, i + 1:] = np.sqrt(((mean[i + 1:] - mean[i]) ** 2).sum(1))
    at = far.argmin(1)
    least = far[np.arange(size), at]
    alive = np.ones(size, dtype=bool)
    for _ in range(min(most, size - 1)):
        a = int(least.argmin())  # the first row, and in it the first column
        b, w = int(at[a]), float(least[a])
        if not w <= limit:
            return
        n[a] += n[b]
        sums[a] += sums[b]
        mean[a] = sums[a] / n[a]
        alive[b] = False
        yield int(ids[a]), int(ids[b]), w, int(n[a]), sums[a].copy()
        now = np.where(alive, np.sqrt(((mean - mean[a]) ** 2).sum(1)), np.inf)
        far[b, :] = far[:, b] = np.inf
        far[a, a + 1:], far[:a, a] = now[a + 1:], now[:a]
        again = alive & ((at == a) | (at == b))
        again[a] = True
        closer = (np.arange(size) < a) & ~again & ((now < least) | ((now == least) & (a < at)))
        at[closer], least[closer] = a, now[closer]
        rows = np.flatnonzero(again)
        at[rows] = far[rows].argmin(1)
        least[rows] = far[rows, at[rows]]
        least[b] = np.inf


def _merged(members: DataFrame, limit: float, most: int) -> DataFrame:
    """The merges of every group of ``members`` (comp, id, n, vsum), numbered
    by ``seq``, with the largest (w, a, b) up to each as (pw, pa, pb)."""
    names = [c.split()[0] for c in MERGES.split(", ")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        out, peak = [], (-np.inf, 0, 0)
        steps = greedy_merges(pdf["id"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64), np.stack(pdf["vsum"].to_numpy()), most, limit)
        for seq, (a, b, w, n, total) in enumerate(steps):
            peak = max(peak, (w, a, b))
            out.append((int(pdf["comp"].iloc[0]), seq, a, b, w, *peak, n, total))
        return pd.DataFrame(out, columns=names)

    return members.select("comp", "id", "n", "vsum").groupBy("comp").applyInPandas(run, MERGES)


def _mean(n="n", vsum="vsum"):
    return F.transform(F.col(vsum), lambda x: x / F.col(n))


def _apart(trial: DataFrame, state: DataFrame, groups: DataFrame, limit: float) -> DataFrame:
    """(a, b): groups of which a mean that arose comes within the limit of
    another group's first or later means."""
    first = state.join(groups, "id").select("comp", _mean().alias("centroid"), F.lit(False).alias("arose"))
    later = trial.select("comp", _mean().alias("centroid"), F.lit(True).alias("arose"))
    points = _cut(first.unionByName(later).withColumn("pid", F.monotonically_increasing_id()))
    index = MetricIndex(points, "pid", "centroid")
    near = index.outside(points.select(F.col("pid").alias("id"), "comp", F.lit(0.0).alias("core")),
                         points.filter("arose").select(F.col("pid").alias("id"), F.lit(limit).alias("reach")), name="merge groups")
    end = lambda c: points.select(F.col("pid").alias(c), F.col("comp").alias("c" + c))
    return _cut(near.join(end("a"), "a").join(end("b"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())


def _round(state: DataFrame, alive: int, left: int, group: int) -> DataFrame:
    """Merges that the greedy rule makes next, at least one, as ``_merged``
    gives them; all of them up to some limit, or the first one."""
    if alive <= group:
        return _merged(state.withColumn("comp", F.lit(0)), float("inf"), left)
    tree = _cut(mst_edges(state.select("id", _mean().alias("centroid")), "id", "centroid"))
    share = min(0.5, left / (alive - 1))
    while True:
        limit, least = tree.agg(F.percentile_approx("w", share, 100_000), F.min("w")).first()
        reach = limit * (1 + 1e-12)
        links = tree.filter(F.col("w") <= reach).select("a", "b")
        while True:
            groups = _cut(connected_components(links, "a", "b", state.select("id")).withColumnRenamed("component", "comp"))
            sizes = groups.groupBy("comp").agg(F.count(F.lit(1)).alias("size"))
            largest = sizes.agg(F.max("size")).first()[0]
            if largest > group:
                break
            several = groups.join(sizes.filter("size > 1"), "comp")
            trial = _cut(_merged(state.join(several, "id"), reach, left))
            near = _apart(trial, state, groups, reach)
            if near.isEmpty():
                return trial
            links = _cut(links.unionByName(near))
        log.info("merge: a group of %d clusters at limit %s, lowered", largest, limit)
        if limit <= least:
            pair = tree.orderBy("w", "a", "b").limit(1).select(F.explode(F.array("a", "b")).alias("id"))
            return _merged(state.join(pair, "id").withColumn("comp", F.lit(0)), float("inf"), 1)
        share /= 4


def merge_map(summaries: DataFrame, label: str, max_clusters: int, group: int | None = None) -> DataFrame:
    """(old, new) for every cluster of ``summaries`` (label, n, vsum): its
    number, from 0 in id order, after merging to ``max_clusters``."""
    group = group or GROUP
    first = _cut(summaries.select(F.col(label).cast("long").alias("id"), F.col("n").cast("long").alias("n"), "vsum"))
    state, alive, edges = first, first.count(), None
    while alive > max_clusters:
        left = alive - max_clusters
        made = _cut(_round(state, alive, left, group))
        total = made.count()
        if total > left:
            made = _cut(global_rank(made, ["pw", "pa", "pb", "seq"], "place").filter(F.col("place") <= left).drop("place"))
        last = made.groupBy("a").agg(F.max_by(F.struct("n", "vsum"), "seq").alias("s")).select(F.col("a").alias("id"), "s")
        state = _cut(state.join(made.select(F.col("b").alias("id")), "id", "left_anti").join(last, "id", "left")
                     .select("id", F.coalesce("s.n", "n").alias("n"), F.coalesce("s.vsum", "vsum").alias("vsum")))
        edges = made.select("a", "b") if edges is None else edges.unionByName(made.select("a", "b"))
        alive -= min(total, left)
        log.info("merge: %d clusters remain", alive)
    kept = global_rank(state.select("id"), ["id"], "place").select(F.col("id").alias("owner"), (F.col("place") - 1).cast("int").alias("new"))
    if edges is None:
        return kept.withColumnRenamed("owner", "old")
    # a merge keeps the smaller id, so a cluster's owner is the least id that its merges reach
    owner = connected_components(edges, "a", "b", first.select("id")).select(F.col("id").alias("old"), F.col("component").alias("owner"))
    return owner.join(kept, "owner").select("old", "new")
