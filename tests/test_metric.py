"""The metric index and the bounded spanning tree against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marisnow.operators import graph, hdbscan, metric
from marisnow.operators.knn import knn, nearest
from marisnow.operators.metric import MetricIndex


def frame(spark, x, first=0):
    rows = [(first + i, [float(a) for a in v]) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id long, v array<double>").repartition(5)


def blobs(n, dims, groups, seed=0, spread=0.1):
    rng = np.random.default_rng(seed)
    return np.concatenate([c + spread * rng.standard_normal((n // groups, dims)) for c in rng.standard_normal((groups, dims)) * 4])


def distances(x, y, kind):
    if kind == "cosine":
        u, v = (a / np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-12) for a in (x, y))
        return 1 - u @ v.T
    return np.sqrt(((x[:, None] - y[None]) ** 2).sum(-1))


def brute(x, y, k, kind, drop_self):
    d = np.round(distances(x, y, kind), 9)
    if drop_self:
        np.fill_diagonal(d, np.inf)
    return np.lexsort((np.broadcast_to(np.arange(len(y)), d.shape), d), axis=1)[:, :k]


@pytest.mark.parametrize("kind", ["euclidean", "cosine"])
def test_neighbours_equal_brute_force(spark, kind):
    x = np.concatenate([blobs(300, 4, 6), np.random.default_rng(1).standard_normal((150, 4)), np.zeros((3, 4))])
    x = np.concatenate([x, x[:40]])  # copies: ties by id
    got = MetricIndex(frame(spark, x), "id", "v", kind, cell_rows=25).knn(6).toPandas().sort_values(["id", "rank"])
    assert (got["nbr"].to_numpy().reshape(-1, 6) == brute(x, x, 6, kind, True)).all()
    d = distances(x, x, kind)[got["id"], got["nbr"]]
    assert np.allclose(got["dist"], d, atol=3e-8)


def test_other_queries_and_few_points(spark):
    x, q = blobs(200, 3, 5), np.random.default_rng(4).standard_normal((70, 3)) * 4
    got = knn(frame(spark, q), "id", "v", 4, "euclidean", include_self=True, candidates=frame(spark, x), block_rows=20).toPandas()
    got = got.sort_values(["id", "rank"])["nbr"].to_numpy().reshape(-1, 4)
    assert (got == brute(q, x, 4, "euclidean", False)).all()
    one = nearest(frame(spark, q), "id", "v", frame(spark, x[:1]), "id", "v").toPandas()
    assert set(one["nbr"]) == {0} and len(one) == 70
    assert knn(frame(spark, x[:3]), "id", "v", 9, "euclidean").count() == 6  # all there are
    assert knn(frame(spark, x).limit(0), "id", "v", 3).count() == 0


def test_clustered_points_meet_few_cells(spark, monkeypatch):
    monkeypatch.setattr(metric, "BUDGET", 60)
    x = blobs(1200, 5, 24)
    index = MetricIndex(frame(spark, x), "id", "v", "euclidean", cell_rows=30)
    got = index.knn(5).toPandas().sort_values(["id", "rank"])
    assert (got["nbr"].to_numpy().reshape(-1, 5) == brute(x, x, 5, "euclidean", True)).all()
    met, every = sum(v[1] for v in index.visited), index.visited[0][2]
    assert met < 0.25 * every


def test_a_large_cell_is_dealt_into_parts(spark, monkeypatch):
    monkeypatch.setattr(metric, "PART_ROWS", 16)
    x = np.concatenate([np.random.default_rng(0).normal(0, 1e-3, (200, 3)), blobs(60, 3, 3)])
    index = MetricIndex(frame(spark, x), "id", "v", "euclidean", cell_rows=60)
    assert index.packs.groupBy("cell").count().agg(F.max("count")).first()[0] > 3
    got = index.knn(5).toPandas().sort_values(["id", "rank"])
    assert (got["nbr"].to_numpy().reshape(-1, 5) == brute(x, x, 5, "euclidean", True)).all()


def least_tree(w):
    """Prim over the total order (w, a, b)."""
    n = len(w)
    inside, best, out = {0}, {j: (w[0, j], 0, j) for j in range(1, n)}, set()
    while best:
        j = min(best, key=best.get)
        out.add(best.pop(j)[1:])
        inside.add(j)
        for i in best:
            best[i] = min(best[i], (w[i, j], min(i, j), max(i, j)))
    return out


@pytest.mark.parametrize("kind", ["euclidean", "cosine"])
def test_spanning_tree_is_that_of_the_total_order(spark, kind, monkeypatch):
    monkeypatch.setattr(graph, "NEAR", 4)
    x = np.concatenate([blobs(160, 3, 8, spread=0.05), np.random.default_rng(2).uniform(-5, 5, (40, 3))])
    x = np.concatenate([x, x[:12]])
    df = frame(spark, x)
    core = hdbscan.core_distances(df, "id", "v", 4, kind, 20)
    pts = df.join(core, "id")
    got = graph.mst_edges(pts, "id", "v", "core", kind, 20).toPandas()
    c = pts.toPandas().set_index("id")["core"].loc[range(len(x))].to_numpy()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    i, j = np.triu_indices(len(x), 1)
    d = np.zeros((len(x), len(x)))
    d[i, j] = d[j, i] = metric.exact_distances(unit[i] if kind == "cosine" else x[i], unit[j] if kind == "cosine" else x[j], kind)
    w = np.maximum(d, np.maximum(c[:, None], c[None]))
    assert set(zip(got["a"], got["b"])) == least_tree(w)
    assert np.allclose(got["w"], w[got["a"], got["b"]])


def test_mutual_reachability_in_one_pass(spark):
    x = np.concatenate([blobs(90, 3, 3), np.zeros((7, 3))])  # seven copies of one point
    got = hdbscan.mutual_reachability(frame(spark, x), "id", "v", 4, 3).toPandas()
    d = np.round(distances(x, x, "euclidean"), 9)
    core = np.sort(d, axis=1)[:, 3]
    want = brute(x, x, 3, "euclidean", True)
    assert {(r.a, r.b) for r in got.itertuples()} == {(i, int(j)) for i, row in enumerate(want) for j in row}
    assert all(abs(r.w - max(core[r.a], core[r.b], r.d)) < 1e-6 for r in got.itertuples())


def test_assign_noise_beyond_the_inlined_table(spark, monkeypatch):
    from marisnow.operators import vectors as V
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.standard_normal(3)], int(i % 9) - 1) for i in range(180)]
    df = spark.createDataFrame(rows, "id long, v array<double>, lbl int")
    small = {r.id: r.cluster_final for r in V.assign_noise(df, "lbl", "v").collect()}
    monkeypatch.setattr(V, "MAX_INLINE_CENTROID_VALUES", 6)
    large = {r.id: r.cluster_final for r in V.assign_noise(df, "lbl", "v").collect()}
    assert small == large and all(v >= 0 for v in large.values())


def test_closest_pair_and_medoids_by_brute_force(spark):
    from marisnow.operators import vectors as V
    from marisnow.operators.knn import cluster_medoids
    rng = np.random.default_rng(9)
    x = rng.integers(0, 6, (60, 2)).astype(float)  # many ties
    cents = spark.createDataFrame([(i, [float(a) for a in r]) for i, r in enumerate(x)], "label int, centroid array<double>")
    want = min((float(np.linalg.norm(x[i] - x[j])), i, j) for i in range(60) for j in range(i + 1, 60))
    assert tuple(V.closest_pair(cents).first()) == (want[1], want[2], want[0])
    assert V.closest_pair(cents.limit(1)).count() == 0
    y, lab = rng.standard_normal((150, 3)), rng.integers(-1, 4, 150)
    df = spark.createDataFrame([(i, [float(a) for a in r], int(c)) for i, (r, c) in enumerate(zip(y, lab))], "id long, v array<double>, lbl int")
    got = {r.lbl: r.medoid_id for r in cluster_medoids(df, "id", "v", "lbl", block_rows=16).collect()}
    for c in range(4):
        m = np.flatnonzero(lab == c)
        s = np.linalg.norm(y[m][:, None] - y[m][None], axis=-1).sum(1)
        assert got[c] == m[int(s.argmin())]
    assert set(got) == set(range(4))


@pytest.mark.parametrize("shift", [0.0, 1e4])
def test_pairs_within_reach_are_never_missed(shift):
    """Single precision loosens the caps by its error: also far from the
    origin, at distance zero, and with the cap at the very distance."""
    rng = np.random.default_rng(6)
    q, c = rng.standard_normal((60, 20)) + shift, rng.standard_normal((80, 20)) + shift
    q[:10] = c[:10]
    d = np.sqrt(((q[:, None] - c[None]) ** 2).sum(-1))
    cap = np.sort(d, axis=1)[:, 3]
    r, col = metric.within(q, c, cap)
    got = np.zeros(d.shape, bool)
    got[r, col] = True
    assert got[d <= cap[:, None]].all() and len(r) < 2 * (d <= cap[:, None]).sum()
    assert metric.within(q, np.repeat(c[:1], 90, axis=0), np.full(60, 1e6)) is None  # too many to look at
    c[0, 0] = np.nan
    assert metric.within(q, c, cap) is None


@pytest.mark.parametrize("kind", ["euclidean", "cosine"])
def test_neighbours_with_and_without_the_single_product(spark, kind, monkeypatch):
    x = np.concatenate([np.random.default_rng(7).standard_normal((240, 3)), blobs(60, 3, 2)])
    x = np.concatenate([x, x[:15]])
    monkeypatch.setattr(metric, "BUDGET", 30)
    for close in (64, 0):
        monkeypatch.setattr(metric, "CLOSE", close)
        got = MetricIndex(frame(spark, x), "id", "v", kind, cell_rows=20).knn(5).toPandas().sort_values(["id", "rank"])
        assert (got["nbr"].to_numpy().reshape(-1, 5) == brute(x, x, 5, kind, True)).all()
