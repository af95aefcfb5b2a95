"""Whitening, hard negatives and the quality classifier, against brute force
in numpy and on edge rows."""

import math
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from marisnow.llm import hardneg, quality, queries, whitening

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


def dense_whitening(rows, k=4, scale=256):
    """The definition, with the whole covariance and numpy's solver."""
    x = {i: [math.floor(scale * float(np.float32(c))) for c in v] for i, v in rows}
    d = max(map(len, x.values()))
    x = {i: v + [0] * (d - len(v)) for i, v in x.items()}
    fit = np.array(sorted(set(map(tuple, x.values()))), dtype=float)
    n, s = len(fit), fit.sum(0)
    c = fit - s / n
    value, vec = np.linalg.eigh(c.T @ c / n)
    value, vec = value[::-1][:k], vec[:, ::-1][:, :k]
    ok = value > 1e-12 * value[0] if value[0] > 0 else np.zeros(len(value), bool)
    out = {}
    for i, v in x.items():
        dev = sum((n * a - int(b)) ** 2 for a, b in zip(v, s))
        for j in np.flatnonzero(ok):
            out[i, j + 1] = (n, dev, (np.array(v) - s / n) @ vec[:, j] / math.sqrt(value[j]), value[j] / np.trace(c.T @ c / n))
    return out


def same_whitening(got, want):
    assert {(r.vec_id, r.component) for r in got} == set(want)
    sign = {}
    for r in sorted(got, key=lambda r: -abs(r.whitened)):
        n, dev, w, e = want[r.vec_id, r.component]
        s = sign.setdefault(r.component, 1 if w * r.whitened >= 0 else -1)
        assert (r.n, int(r.deviation)) == (n, dev)
        assert r.whitened == pytest.approx(s * w, abs=1e-8)
        assert r.explained == pytest.approx(e, rel=1e-9)
        assert r.identity_error < 1e-9


def test_whitening_equals_the_dense_solution(spark):
    rng = np.random.default_rng(5)
    spread = np.linspace(3, 0.2, 40)
    rows = [(i, [float(x) for x in rng.standard_normal(40) * spread]) for i in range(700)]
    rows += [(1000 + i, rows[i][1]) for i in range(50)]  # repeated vectors count once
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).repartition(7)
    same_whitening(whitening.whiten(df).collect(), dense_whitening(rows))


def test_whitening_of_the_given_table(spark):
    got = queries.queries()["op12_embedding_whitening"](spark, SF).collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    same_whitening(got, dense_whitening(rows))


def test_filtered_iteration_on_a_nearly_flat_spectrum():
    rng = np.random.default_rng(0)
    q, _ = np.linalg.qr(rng.standard_normal((90, 90)))
    value = np.r_[5.0, 1.003, 1.002, 1.001, np.linspace(1.0, 0.9, 86)]
    a = (q * value) @ q.T
    got, basis, residual = whitening.top_pairs(a, 90, 4)
    assert np.allclose(got, value[:4], rtol=1e-12)
    assert np.abs(np.abs((basis * q[:, :4]).sum(0)) - 1).max() < 1e-10
    assert residual.max() < 1e-12


def test_whitening_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25, -1.0], 0), (2, [0.5], 0), (None, [1.0, 2.0, 3.0], 0), (4, None, 0), (5, [nan, 1.0, 1.0], 0),
            (6, [inf, 1.0, 1.0], 0), (7, [None, 1.0, 1.0], 0), (1, [0.5, 0.25, -1.0], 0), (9, [-0.001, 0.0, 0.0], 0)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("_V", F.lit("x")).withColumn("N", F.lit(1)).withColumn("component", F.lit(2))
    got = whitening.whiten(df).collect()
    assert {r.vec_id for r in got} == {1, 2, None, 9}
    assert len(got) == 5 * 3  # three dimensions; the repeated row twice
    assert {r.n for r in got} == {4}
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.filter("vec_id = 1")).collect() == []  # no variance
    assert whitening.whiten(spark.createDataFrame([(1, [], 0)], VECTORS)).collect() == []


def test_deviation_is_exact_beyond_longs():
    x = np.array([[2 ** 30, -(2 ** 30)]], dtype=np.int64)
    n, total = 10 ** 6, [3, 5]
    want = sum((n * int(a) - b) ** 2 for a, b in zip(x[0], total))
    assert whitening._deviation(x, n, total) == [want] and want > 2 ** 63


def brute_negatives(rows, anchors, positives=5, negatives=10, low=30, high=90, scale=256):
    x = {i: (lab, [math.floor(scale * float(np.float32(c))) for c in v]) for i, v, lab in rows}
    out = []
    for a in anchors:
        if a not in x:
            continue
        score = {i: sum(p * q for p, q in zip(x[a][1], v)) for i, (_, v) in x.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if x[i][0] == x[a][0]][:positives]:
            hard = [i for i in order if x[i][0] != x[a][0] and low * score[p] <= 100 * score[i] <= high * score[p]][:negatives]
            out += [(a, p, r, i, score[p], score[i]) for r, i in enumerate(hard, 1)]
    return sorted(out)


def clustered(n, seed=3, dims=9):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((6, dims))
    return [(i, [float(c) for c in centre[i % 6] + 0.4 * rng.standard_normal(dims)], int(rng.integers(0, 4))) for i in range(n)]


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    for name, value in (("CELL_ROWS", 8), ("BLOCK", 5), ("PART", 12), ("GROUP", 7), ("BUDGET", 20)):
        monkeypatch.setattr(hardneg, name, value)
    rows = clustered(600)
    rows += [(2000 + i, rows[0][1], 1) for i in range(40)]  # one hot cell, all ties
    df = spark.createDataFrame(rows, VECTORS)
    src = hardneg.mine(df, F.col("vec_id") % 20 == 0)
    got = sorted(map(tuple, src.collect()))
    assert got == brute_negatives(rows, [i for i, _, _ in rows if i % 20 == 0])


def test_hard_negatives_of_the_given_table(spark):
    got = sorted(map(tuple, queries.queries()["op13_hard_negatives"](spark, SF).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    assert got == sorted(con.sql(queries.oracle_sql()["op13_hard_negatives"]).fetchall()) and got


def test_multi_sequence_yields_every_cell_by_falling_bound():
    rng = np.random.default_rng(2)
    u, v = rng.integers(-5, 5, 7).astype(float), rng.integers(-5, 5, 4).astype(float)
    got = list(hardneg.multi_sequence(u, v))
    assert {(i, j) for _, i, j in got} == {(i, j) for i in range(7) for j in range(4)} and len(got) == 28
    assert all(a[0] >= b[0] for a, b in zip(got, got[1:]))
    assert all(b == u[i] + v[j] for b, i, j in got)


def test_second_round_skips_cells_that_no_window_gains_from(spark):
    rows = clustered(3000)
    df = spark.createDataFrame([(i, v, lab) for i, v, lab in rows], VECTORS)
    src = hardneg.whole_vectors(df.select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("label"), "embedding"),
                                "embedding", 256, "v")
    index = hardneg.Index(src, 9, cell_rows=16)
    books = index.books
    assert books.count.sum() == len(rows)
    q = np.array([math.floor(256 * c) for c in rows[0][1]], dtype=float)
    x = np.array([[math.floor(256 * c) for c in v] for _, v, _ in rows], dtype=float)
    floor = np.sort(x @ q)[-10]
    lo, hi = np.array([hardneg.NONE]), np.array([hardneg.ALL])
    late = hardneg.visits(books, q, lo, hi, np.array([floor]), budget=64)
    early = hardneg.visits(books, q, lo, hi, None, budget=64)
    assert not set(late) & set(early)
    seen = set(late) | set(early)
    assert 0 < len(seen) < 0.7 * (books.count > 0).sum()
    # every row that reaches the floor lies in a visited cell
    c1, _ = hardneg.nearest(x[:, :books.half], books.first)
    c2, _ = hardneg.nearest(x[:, books.half:], books.second)
    assert set((c1 * books.words + c2)[x @ q >= floor].tolist()) <= seen
    index.close()


def test_hard_negative_edge_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 0.9], 1), (2, [0.6, 0.5], 2), (3, [0.5, 0.5], None), (None, [0.6, 0.5], 2), (4, None, 2),
            (5, [nan, 1.0], 2), (6, [], 2), (7, [1.0], 2), (2, [0.6, 0.5], 2), (0, [1.0, 1.0], 1)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("CELL", F.lit(1)).withColumn("w", F.lit("x")).withColumn("asked", F.lit(0))
    got = sorted(map(tuple, hardneg.mine(df, F.col("vec_id") == 0).collect()))
    # one positive (1), its window holds both rows of id 2 and row 7; rows of the anchor's own id take no part
    assert [(r[1], r[2], r[3]) for r in got] == [(1, 1, 2), (1, 2, 2), (1, 3, 7)]
    assert hardneg.mine(df.limit(0), F.col("vec_id") == 0).collect() == []
    assert hardneg.mine(df, F.lit(None).cast("boolean")).collect() == []


# ------------------------------------------------------------- quality ----

def test_quality_holds_out_a_fold_and_tells_it(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.queries()["op11_quality_classifier"](spark, sf).collect()}
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
               for i, r in got.items())
    held = [(r.quality, got[r.doc_id]) for r in labels.collect() if r.doc_id in got and got[r.doc_id].held_out]
    good, bad = ([r for q, r in held if q == v] for v in (1, 0))
    assert np.mean([r.predicted for r in good]) > 0.97
    assert np.mean([1 - r.predicted for r in bad]) > 0.7
    # held-out labels have no influence
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit(docs, labels), quality.fit(docs.repartition(5), flipped)
    assert np.array_equal(a.table, b.table) and a.temperature == b.temperature
    assert all(np.allclose(x, y) for x, y in zip(a.layers, b.layers))


def test_context_sums_equal_a_word_by_word_count(spark, monkeypatch):
    texts = ["Alpha beta, GAMMA 12!! beta", "", None, "x " * 50 + "### alpha", "beta"]
    place, sign = quality.index_vectors()
    total, count = np.zeros((quality.BUCKETS, quality.DIMS)), np.zeros(quality.BUCKETS)
    known = quality._Buckets()
    for t in texts:
        ids = [known[w] for w in quality.TOKEN.findall(t or "")]
        for i, w in enumerate(ids):
            count[w] += 1
            for j in range(max(0, i - quality.REACH), min(len(ids), i + quality.REACH + 1)):
                if j != i:
                    total[w, place[ids[j]]] += sign[ids[j]]
    monkeypatch.setattr(quality, "PIECE", 7)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = quality.count_contexts(df)
    assert np.array_equal(got[0], total) and np.array_equal(got[1], count)


def test_network_gradients_and_temperature():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)  # no linear rule tells these
    layers = quality.train(x, y, hidden=16, steps=800)
    z = np.tanh(x @ layers[0] + layers[1]) @ layers[2] + layers[3]
    assert ((z > 0) == y).mean() > 0.95
    true = rng.standard_normal(20_000) * 2
    label = (rng.random(20_000) < 1 / (1 + np.exp(-true))).astype(float)
    assert quality.best_temperature(true * 3, label) == pytest.approx(3.0, rel=0.1)


def test_quality_edge_rows(spark):
    model = quality.fit(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, quality int"))
    rows = [(1, None), (1, ""), (None, " \n"), (2, "word " * 300_000), (2, "$$$")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("SCORE", F.lit("x")).withColumn("_text", F.lit("keep"))
    got = quality.score(df, model)
    assert got.columns.count("score") == 1 and "SCORE" not in got.columns
    assert [r.score for r in got.collect()] == [0.5] * 5
    docs = spark.createDataFrame([(i, "good plain words here" if i % 2 else "### $$$ ###") for i in range(60)] + [(3, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (5, None), (7, 0), (9, 3)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = {r.text: r.predicted for r in quality.score(docs, model).collect()}
    assert got["good plain words here"] == 1 and got["### $$$ ###"] == 0
    assert quality.score(docs.limit(0), model).collect() == []
