"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marisnow.llm.common import discard, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on ``edges`` (u > v).

    The large star hangs every larger neighbour of a node on the smallest
    member of the node's neighbourhood, the small star does so with the node
    and its smaller neighbours.  The minimum is a partial aggregate; the join
    back is a plain equi-join, so a hub's rows can be split among tasks."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(low, "u").select(
            F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return out.filter("u != v").distinct()


def _mark(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)).alias("n"),
                     F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node that has an edge to another node;
    ``component`` is the smallest node reachable.

    Nodes may have any ordered type.  Loops and rows with a null end are
    ignored, repeated edges count once, no edges give no rows.  Rounds go on
    until the edge set stands still (count and hash sum of the written
    rounds); there is no round limit.  Each round is written to the shared
    folder and the one before is deleted."""
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    state = written(pairs, "components")
    mark = _mark(state)
    while mark["n"]:
        nxt = written(_star(_star(state, True), False), "components")
        seen, mark = mark, _mark(nxt)
        discard(state)
        state = nxt
        if seen == mark:
            break
    stars = state.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
