"""KMeans starts side by side against a plain loop over them."""

import numpy as np
import pytest

from marisnow.operators import cluster


def frame(spark, x):
    return spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "id long, v array<double>").repartition(4)


def plain(x, k, seed, n_init, tol=1e-4):
    """Every start by itself: (cost, centres) of the least."""
    best = None
    for s in range(n_init):
        c = cluster.starting_centres(x, k, seed + s)
        for _ in range(300):
            d = ((x[:, None] - c[None]) ** 2).sum(-1)
            at = d.argmin(1)
            new = np.array([x[at == j].mean(0) if (at == j).any() else c[j] for j in range(k)])
            cost = d.min(1).sum()
            if np.sqrt(((new - c) ** 2).sum(1)).max() <= tol:
                break
            c = new
        if best is None or cost < best[0]:
            best = (cost, c)
    return best


def test_least_cost_of_all_starts(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([c + 0.6 * rng.standard_normal((40, 3)) for c in rng.standard_normal((6, 3)) * 3])
    # the order in which the starts see the points
    first = np.array(frame(spark, x).selectExpr("v", "xxhash64(v) h").orderBy("h", "v").toPandas()["v"].tolist())
    cost, centres = plain(first, 6, 42, 8)
    got = cluster.kmeans_fallback(frame(spark, x), "v", 6, n_init=8).toPandas().sort_values("id")
    label = got["cluster_final"].to_numpy()
    mine = sum(((x[label == j] - x[label == j].mean(0)) ** 2).sum() for j in range(6))
    assert mine == pytest.approx(cost, rel=1e-3)
    want = ((x[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
    assert (label == want).all()
    assert label.dtype.kind in "iu" and set(label) == set(range(6))


def test_refusals_and_null_vectors(spark):
    df = frame(spark, np.arange(12.0).reshape(6, 2))
    for k in (None, 1, 7):
        with pytest.raises(ValueError):
            cluster.kmeans_fallback(df, "v", k)
    some = df.unionByName(spark.createDataFrame([(99, None)], "id long, v array<double>"))
    got = {r.id: r.cluster_final for r in cluster.kmeans_fallback(some, "v", 2, n_init=3).collect()}
    assert got[99] is None and {v for i, v in got.items() if i != 99} == {0, 1}
    same = frame(spark, np.ones((5, 2)))
    assert {r.cluster_final for r in cluster.kmeans_fallback(same, "v", 2, n_init=2).collect()} == {0}


def test_a_scan_reads_packed_vectors(spark, monkeypatch):
    from marisnow.operators import cluster
    seen, step = [], cluster._step
    monkeypatch.setattr(cluster, "_step", lambda points, *rest: seen.append(points.dtypes) or step(points, *rest))
    rows = [(i, [float(i % 3) * 10, float(i % 2)]) for i in range(60)]
    df = spark.createDataFrame(rows + [(60, None)], "id long, v array<double>")
    got = {r.id: r.c for r in cluster.kmeans_fallback(df, "v", 3, n_init=2, out="c").collect()}
    assert {tuple(d) for d in seen} == {(("x", "binary"),)}  # a vector's components are no values of the scan
    assert got[60] is None and len({(i % 3, got[i]) for i in range(60)}) == 3
