"""The spanning tree and hierarchy of a bounded number of points, which one
task folds, against the joined rounds; pictures encoded by many tasks."""

import numpy as np
import pytest
from test_metric import blobs, frame, least_tree

from marisnow.operators import graph, hdbscan
from marisnow.operators import imageprep as IP


def points():
    x = np.concatenate([blobs(90, 3, 5, spread=0.05), np.random.default_rng(4).uniform(-5, 5, (25, 3))])
    return np.concatenate([x, x[:9]])


def labels(spark, x, **kw):
    got = hdbscan.hdbscan(frame(spark, x), "id", "v", 5, block_rows=30, **kw).toPandas()
    return dict(zip(got["id"], got["cluster_raw"]))


def test_labels_equal_those_of_the_joined_rounds_with_fewer_writes(spark, monkeypatch):
    x, cuts = points(), []
    monkeypatch.setattr(graph, "NEAR", 4)
    cut = graph.materialize
    monkeypatch.setattr(graph, "materialize", lambda *a, **k: cuts.append(1) or cut(*a, **k))
    got, few = labels(spark, x), len(cuts)
    monkeypatch.setattr(graph, "LOCAL_POINTS", 0)
    monkeypatch.setattr(hdbscan, "CHAIN", 1)
    assert labels(spark, x) == got and len(set(got.values()) - {-1}) > 1
    assert few < 40 < 2 * few < len(cuts) - few


@pytest.mark.parametrize("edges", [graph.LOCAL_EDGES, 150])
def test_tree_of_listed_and_found_edges(spark, monkeypatch, edges):
    """Isolated groups (no listed edge leaves them) and, at 150, forests of
    groups of edges instead of all."""
    monkeypatch.setattr(graph, "NEAR", 4)
    monkeypatch.setattr(graph, "LOCAL_EDGES", edges)
    x = points()
    got = hdbscan.reachability_tree(frame(spark, x), "id", "v", 4, block_rows=30).toPandas()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    core = np.sort(d, axis=1)[:, 3]
    assert set(zip(got["a"], got["b"])) == least_tree(np.maximum(d, np.maximum(core[:, None], core[None])))


def test_pictures_of_one_size_are_transformed_together():
    rng = np.random.default_rng(0)
    sizes = [(8, 8), (20, 7), (8, 8), (7, 20), (48, 60), (20, 7)]
    pictures = [rng.integers(0, 256, (*s, 3), dtype=np.uint8) for s in sizes]
    got = IP._transformed(pictures, 16)
    for rgb, tensor in zip(pictures, got):
        h, w = rgb.shape[:2]
        nh, nw = (48, max(1, w * 48 // h)) if h <= w else (max(1, h * 48 // w), 48)
        img = IP.resize(rgb, nh, nw)
        top, left = round((nh - 16) / 2), round((nw - 16) / 2)
        want = (img[top:top + 16, left:left + 16] / 255.0 - np.asarray(IP.IMAGENET_MEAN)) / np.asarray(IP.IMAGENET_STD)
        assert (tensor == want.astype(np.float32)).all()


def test_pictures_of_one_file_are_many_tasks(spark, monkeypatch):
    from marisnow.plans import q_cluster
    from marisnow.sources import runs
    seen = []

    class Seen(Exception):
        pass

    def write(df, path, mode="append"):
        seen.append(df.rdd.getNumPartitions())
        raise Seen

    monkeypatch.setattr(runs, "write_features", write)
    with pytest.raises(Seen):
        q_cluster.q_cluster_run(spark, "/root/testdata/sf0.001")
    assert seen[0] >= spark.sparkContext.defaultParallelism > 1
