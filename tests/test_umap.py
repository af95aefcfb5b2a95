import numpy as np
from pyspark.sql import functions as F

from marisnow.operators.knn import knn
from marisnow.operators.umap import curve_params, neighbour_overlap, umap_reduce


def test_curve_params_match_published_values():
    a, b = curve_params(0.1)
    assert abs(a - 1.577) < 0.01 and abs(b - 0.895) < 0.01


def test_layout_preserves_neighbours_and_is_deterministic(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 0.2, (30, 6)) for c in (0.0, 3.0, 6.0)])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, v array<double>")
    y1 = umap_reduce(df, "id", "v", n_components=2, n_neighbors=8, metric="euclidean", n_epochs=10)
    y2 = umap_reduce(df, "id", "v", n_components=2, n_neighbors=8, metric="euclidean", n_epochs=10)
    a = {r.id: list(r.embedding) for r in y1.collect()}
    b = {r.id: list(r.embedding) for r in y2.collect()}
    assert a == b
    hi = knn(df, "id", "v", 8, "euclidean")
    lo = knn(y1, "id", "embedding", 8, "euclidean")
    assert neighbour_overlap(hi, lo) > 0.5


def test_fuzzy_graph_sigma_and_symmetry(spark):
    from marisnow.operators.reduce import _smooth_knn, _smooth_knn_batch, fuzzy_graph
    rng = np.random.default_rng(5)
    d = np.sort(rng.uniform(0.1, 2.0, (20, 8)), axis=1)
    rho, sig = _smooth_knn_batch(d, 8)
    for i in range(20):
        r1, s1 = _smooth_knn(d[i], 8)
        assert abs(r1 - rho[i]) < 1e-12 and abs(s1 - sig[i]) < 1e-9
        resid = np.exp(-np.maximum(d[i] - rho[i], 0) / sig[i]).sum() - np.log2(8)
        assert abs(resid) < 1e-4
    x = rng.normal(0, 1, (40, 5))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, v array<double>")
    g = fuzzy_graph(knn(df, "id", "v", 6, "euclidean"), 6).collect()
    assert all(r.a < r.b and 0 < r.w <= 1.0 + 1e-12 for r in g)


def test_queries_keep_the_operators_defaults(spark, monkeypatch):
    from marisnow.operators import umap as U
    from marisnow.plans import q_cluster as Q
    sf, calls = "/root/testdata/sf0.001", []

    def layout(df, id_col, vec_col, **kw):
        calls.append(kw)
        return df.selectExpr(f"{id_col} as id", "array(0.5D, 0.25D) as embedding")
    monkeypatch.setattr(U, "umap_reduce", layout)
    assert Q.q_umap_reduce(spark, sf).first().embedding == [0.5, 0.25]
    Q.q_umap_2d(spark, sf)
    monkeypatch.setattr(Q, "kmeans_fallback", lambda df, vec, **kw: calls.append(kw) or df.selectExpr("vec_id", "0 as cluster_final"))
    Q.q_kmeans_fallback(spark, sf)
    assert len(calls) == 3 and not any({"n_epochs", "n_neighbors", "n_init"} & set(kw) for kw in calls)


def test_layout_equals_plain_epochs_over_ranges_and_parts(spark, monkeypatch):
    """Ranges, parts and exchanges give what one loop over all edges gives,
    with one node in most edges."""
    from marisnow.operators import umap
    for name, value in (("NODES", 16), ("EDGES", 40), ("KEEP_EVERY", 2)):
        monkeypatch.setattr(umap, name, value)
    rng = np.random.default_rng(5)
    n, dims, epochs = 45, 3, 5
    pairs = {(0, i) for i in range(1, n)} | {tuple(sorted(p)) for p in rng.integers(0, n - 3, (70, 2)).tolist() if p[0] != p[1]}
    pairs = sorted(p for p in pairs if max(p) < n - 2)  # the last two nodes have no edge
    rows = [(10 * a, 10 * b, float(w)) for (a, b), w in zip(pairs, rng.uniform(0.1, 1.0, len(pairs)))]
    points = [(10 * i, [float(x) for x in rng.standard_normal(4)]) for i in range(n)]
    df = spark.createDataFrame(points, "id long, v array<double>")
    monkeypatch.setattr(umap, "fuzzy_graph", lambda nn, k: spark.createDataFrame(rows, "a long, b long, w double"))
    got = {r.id: r.embedding for r in umap.umap_reduce(df.repartition(3), "id", "v", dims, 5, 0.1, "euclidean", 7, epochs, 2).collect()}
    a, b = umap.curve_params(0.1)
    init = {r.id: r.y for r in umap.pca_reduce(df.withColumnRenamed("v", "_v"), "_v", dims, "y").collect()}
    ext = max(abs(x) for y in init.values() for x in y)
    y = np.round(np.array([init[10 * i] for i in range(n)]) * 10.0 / ext, 6)
    ranges = -(-n // 16)
    for epoch in range(epochs):
        total, weight = np.zeros_like(y), np.zeros(n)
        for (i, j), (_, _, w) in zip(pairs, rows):
            for u, v in ((i, j), (j, i)):
                def add(other, factor):
                    total[u] += w * np.clip(factor * (y[u] - y[other]), -4, 4)
                    weight[u] += w
                d2 = ((y[u] - y[v]) ** 2).sum()
                add(v, -2 * a * b * d2 ** (b - 1) / (1 + a * d2 ** b) if d2 > 0 else 0.0)
                pool = [k for r in umap.negative_ranges(7, epoch, u // 16, ranges) for k in range(16 * r, min(n, 16 * r + 16))]
                for t in range(2):
                    c = pool[umap.draw(7, epoch, np.array([u]), np.array([v]), t, len(pool))[0]]
                    if c != u:
                        d2 = ((y[u] - y[c]) ** 2).sum()
                        add(c, 2 * b / ((0.001 + d2) * (1 + a * d2 ** b)))
        y = np.round(y + (1 - epoch / epochs) * total / np.where(weight > 0, weight, 1)[:, None], 6)
    assert set(got) == {10 * i for i in range(n)}
    assert np.abs(np.array([got[10 * i] for i in range(n)]) - y).max() < 1e-4


def test_layout_of_nothing_and_of_one_point(spark):
    df = spark.createDataFrame([(4, [1.0, 2.0])], "id long, v array<double>")
    from marisnow.operators.umap import umap_reduce
    assert umap_reduce(df.limit(0), "id", "v").count() == 0


def test_an_epoch_sends_a_range_once_to_a_task(spark, monkeypatch):
    """A grid of tasks gives what one column gives, kept edges are not sent
    again, and no range goes twice to a task."""
    from pyspark.sql.classic.dataframe import DataFrame

    from marisnow.operators import umap
    for name, value in (("NODES", 8), ("EDGES", 60), ("TASKS", 3)):
        monkeypatch.setattr(umap, name, value)
    x = np.random.default_rng(6).standard_normal((70, 5))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, v array<double>")
    sent, real = [], DataFrame.repartitionById

    def layout():
        out = umap.umap_reduce(df, "id", "v", 3, 6, 0.1, "euclidean", 7, 3, 2)
        return np.array([r.embedding for r in out.orderBy("id").collect()])

    def deal(self, n, by):
        sent.append((n, real(self, n, by)))
        return sent[-1][1]

    monkeypatch.setattr(DataFrame, "repartitionById", deal)
    whole = layout()
    tasks, last = sent[-1]
    assert tasks == 3 and len(sent) == 4 and sorted(last.columns) == ["range", "task", "y"]  # the edges, then three epochs
    assert last.count() == last.select("task", "range").distinct().count() == 3 * 9
    sent.clear()
    monkeypatch.setattr(umap, "STATE_BYTES", 300)
    grid = layout()
    tasks, last = sent[-1]
    assert tasks == 3 * 3 and last.count() == last.select("task", "range").distinct().count() < 9 * 9
    assert np.abs(grid - whole).max() < 1e-3


def test_coordinates_as_whole_numbers():
    from marisnow.operators.umap import _packed, _unpacked
    y = np.array([[0.1, -9.999999], [np.nan, 123.456789], [-0.0000004, 1e-6]])
    for whole in (np.int32, np.int64):
        assert np.array_equal(_unpacked(_packed(y, whole), whole, 2), np.round(y, 6), equal_nan=True)
