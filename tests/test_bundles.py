"""The size cut against the greedy loop."""

import random

import pytest
from pyspark.sql import functions as F

from marisnow.operators.bundles import bundle_plan


def greedy(rows, limit):
    """(group, key) -> part, row by row."""
    out, state = {}, {}
    for g, key, size in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        part, running = state.get(g, (1, 0.0))
        size = max(size or 0.0, 0.0)
        if running > 0 and running + size > limit:
            part, running = part + 1, 0.0
        state[g] = part, running + size
        out[g, key] = part
    return out


def cases():
    rng = random.Random(7)
    sizes = {"mixed": lambda: rng.choice([0, 0, 1, 5, 9, 30]), "zeros": lambda: rng.choice([0, 0, 0, 0, 40]),
             "oversized": lambda: rng.choice([3, 200]), "even": lambda: 10, "odd": lambda: rng.choice([None, -4, 7])}
    for name, draw in sizes.items():
        yield name, [(rng.choice(["a", "b", "b", "b", None]), i, draw()) for i in range(150)]
    yield "skewed", [("hot" if i % 50 else f"g{i}", i, rng.randint(0, 12)) for i in range(400)]
    yield "all zero", [("a", i, 0) for i in range(20)]


@pytest.mark.parametrize("name,rows", list(cases()))
def test_parts_equal_the_greedy_cut(spark, name, rows):
    df = spark.createDataFrame(rows, "g string, k long, size long").repartition(6)
    got = bundle_plan(df, "size", ["k"], 25.0, group_col="g").collect()
    assert {(r.g, r.k): r.part for r in got} == greedy(rows, 25.0) and len(got) == len(rows)
    assert sorted(r["_row"] for r in got) == list(range(1, len(rows) + 1))


def test_plan_without_groups_or_rows(spark):
    rows = [("x", i, 3 + i % 4) for i in range(60)]
    df = spark.createDataFrame(rows, "g string, k long, size long")
    got = {("x", r.k): r.part for r in bundle_plan(df, "size", ["k"], 11.0).collect()}
    assert got == greedy(rows, 11.0)
    none = bundle_plan(df.limit(0), "size", ["k"], 11.0)
    assert none.count() == 0 and "part" in none.columns and "_g" not in none.columns


def test_nothing_passes_through_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    def refuse(self):
        raise AssertionError("rows collected")
    df = spark.createDataFrame([("x", i, 4) for i in range(30)], "g string, k long, size long")
    with monkeypatch.context() as m:
        m.setattr(DataFrame, "toPandas", refuse)
        calls = []
        real = DataFrame.collect
        m.setattr(DataFrame, "collect", lambda self: calls.append(1) or real(self))
        plan = bundle_plan(df, "size", ["k"], 9.0)
        assert not calls
    assert plan.agg(F.max("part")).first()[0] == 15


def test_rows_of_a_group_are_many_tasks(spark, monkeypatch):
    """Ranges of few rows: the same parts, and the group's rows do not meet in
    one task, where a join's kind depends on what Spark knows beforehand."""
    from marisnow.operators import graph
    monkeypatch.setattr(graph, "RANGE_ROWS", 40)
    rows = [("x", i, (i * 7) % 13) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, k long, size long").repartition(5)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = bundle_plan(df, "size", ["k"], 25.0, group_col="g").withColumn("task", F.spark_partition_id())
        got = plan.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert {(r.g, r.k): r.part for r in got} == greedy(rows, 25.0) and len(got) == 1000
    tasks = [r.task for r in got]
    assert max(map(tasks.count, set(tasks))) < 500


@pytest.mark.parametrize("local", [True, False])
@pytest.mark.parametrize("name,rows", [c for c in cases() if c[0] in ("zeros", "oversized", "skewed")])
def test_parts_that_go_on_over_many_ranges(spark, monkeypatch, name, rows, local):
    from marisnow.operators import bundles, graph
    monkeypatch.setattr(graph, "RANGE_ROWS", 7)
    if not local:
        monkeypatch.setattr(graph, "LOCAL_POINTS", 0)
        monkeypatch.setattr(bundles, "BROADCAST_MARKS", 0)
    df = spark.createDataFrame(rows, "g string, k long, size long").repartition(6)
    got = bundle_plan(df, "size", ["k"], 25.0, group_col="g").collect()
    assert {(r.g, r.k): r.part for r in got} == greedy(rows, 25.0)
    assert sorted(r["_row"] for r in got) == list(range(1, len(rows) + 1))


def test_rows_are_written_once_and_only_what_is_kept(spark, monkeypatch):
    from marisnow.operators import graph
    written, write = [], graph.materialize
    monkeypatch.setattr(graph, "materialize", lambda df, **k: written.append((df.columns, write(df, **k))) or written[-1][1])
    rows = [("x", i, 3 + i % 4, "pad" * 9) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, k long, size long, pad string")
    plan = bundle_plan(df, "size", ["k"], 11.0)
    assert {r.k: r.part for r in plan.collect()} == {k: p for (_, k), p in greedy([r[:3] for r in rows], 11.0).items()}
    assert sum("pad" in c for c, _ in written) == 1
    assert sum(f.count() == 600 for _, f in written) == 1 and len(written) < 12
    written.clear()
    small = bundle_plan(df, F.col("size") * 2, ["k", "pad"], 22.0, keep=["size"])
    assert small.columns == ["size", "_row", "part"] and not any("pad" in c for c, _ in written)
    assert sorted((r["_row"], r.part) for r in small.collect()) == sorted((r["_row"], r.part) for r in plan.collect())
