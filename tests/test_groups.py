"""The metric index with many groups of parts, against brute force."""

import numpy as np
import pytest
from test_metric import blobs, brute, frame, least_tree

from marisnow.operators import graph, hdbscan, metric
from marisnow.operators.metric import MetricIndex


@pytest.fixture
def small_groups(monkeypatch):
    monkeypatch.setattr(metric, "GROUP_BYTES", 8 * 3 * 40)  # forty vectors of three components
    monkeypatch.setattr(metric, "PART_ROWS", 16)
    monkeypatch.setattr(metric, "BUDGET", 30)


def test_neighbours_over_groups(spark, small_groups):
    x = np.concatenate([np.random.default_rng(1).standard_normal((180, 3)), blobs(40, 3, 2)])
    x = np.concatenate([x, x[:15]])
    index = MetricIndex(frame(spark, x), "id", "v", "euclidean", cell_rows=20)
    assert index.groups.n > 4
    got = index.knn(5).toPandas().sort_values(["id", "rank"])
    assert (got["nbr"].to_numpy().reshape(-1, 5) == brute(x, x, 5, "euclidean", True)).all()
    for _, asked, queries in index._searches:  # a part of the queries goes to a group once
        assert asked.groupBy("tg", "qc", "qp").count().filter("count > 1").isEmpty()
        assert asked.count() <= index.groups.n * queries.count()


def test_spanning_tree_over_groups(spark, small_groups, monkeypatch):
    monkeypatch.setattr(graph, "NEAR", 4)
    x = np.concatenate([blobs(80, 3, 4, spread=0.05), np.random.default_rng(2).uniform(-5, 5, (30, 3))])
    x = np.concatenate([x, x[:6]])
    got = hdbscan.reachability_tree(frame(spark, x), "id", "v", 4, block_rows=20).toPandas()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    core = np.sort(d, axis=1)[:, 3]
    want = least_tree(np.maximum(d, np.maximum(core[:, None], core[None])))
    assert set(zip(got["a"], got["b"])) == want
