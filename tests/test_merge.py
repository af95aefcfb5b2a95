"""merge_clusters in rounds against the greedy rule done step by step."""

from __future__ import annotations

import numpy as np
import pytest

from marisnow.operators import merge as M
from marisnow.operators import vectors as V


def stepwise(points, labels, most):
    """The rule as stated: every mean anew, every pair, the first closest."""
    labels = np.asarray(labels).copy()
    ids = sorted(set(labels.tolist()) - {-1})
    total = {i: points[labels == i].sum(0) for i in ids}
    n = {i: int((labels == i).sum()) for i in ids}
    if len(ids) <= most:
        return labels
    while len(ids) > most:
        mean = np.stack([total[i] / n[i] for i in ids])
        best = None
        for k in range(len(ids) - 1):
            d = np.sqrt(((mean[k + 1:] - mean[k]) ** 2).sum(1))
            at = int(d.argmin())
            if best is None or d[at] < best[0]:
                best = (d[at], ids[k], ids[k + 1 + at])
        _, a, b = best
        labels[labels == b] = a
        total[a], n[a] = total[a] + total[b], n[a] + n[b]
        ids.remove(b)
    new = {old: i for i, old in enumerate(ids)}
    return np.array([-1 if v == -1 else new[v] for v in labels.tolist()])


def merged(spark, points, labels, most, **kw):
    df = spark.createDataFrame([(i, int(v), p.tolist()) for i, (p, v) in enumerate(zip(points, labels))], "id long, lbl int, v array<double>")
    got = {r.id: r.m for r in V.merge_clusters(df, "lbl", "v", most, out="m", **kw).select("id", "m").collect()}
    return np.array([got[i] for i in range(len(points))])


def test_kernel_equals_rule():
    rng = np.random.default_rng(5)
    for trial in range(20):
        k = int(rng.integers(2, 40))
        points = rng.integers(0, 6, (k, 2)).astype(float)  # many ties
        labels = rng.permutation(k)
        order = np.argsort(labels)
        most = int(rng.integers(1, k))
        owner = {int(i): int(i) for i in labels}
        for a, b, _w, _n, _s in M.greedy_merges(labels[order], np.ones(k, int), points[order], k - most):
            owner = {i: a if o == b else o for i, o in owner.items()}
        dense = {o: i for i, o in enumerate(sorted(set(owner.values())))}
        assert [dense[owner[int(i)]] for i in labels] == stepwise(points, labels, most).tolist(), trial


def test_one_group_of_600(spark):
    rng = np.random.default_rng(1)
    labels = np.r_[np.arange(640), rng.integers(-1, 640, 500)]
    points = rng.normal(size=(len(labels), 4))
    assert (merged(spark, points, labels, 37) == stepwise(points, labels, 37)).all()


def _clumps(rng, clumps, each, spread):
    centre = rng.uniform(0, 100, (clumps, 2))
    return np.concatenate([c + rng.normal(0, spread, (each, 2)) for c in centre])


def test_rounds_of_small_groups(spark, monkeypatch):
    """More clusters than a group may hold: limits, groups and the cut."""
    monkeypatch.setattr(M, "GROUP", 24)
    points = _clumps(np.random.default_rng(3), 5, 6, 1.5)
    labels = np.random.default_rng(2).permutation(len(points)) * 3 + 1
    assert (merged(spark, points, labels, 7) == stepwise(points, labels, 7)).all()


def test_means_that_move_to_another_group(spark, monkeypatch):
    """Triangles whose first merge brings its mean nearer to the third corner
    than the limit, which no pair of first centroids shows; of the merges
    only the first four are wanted."""
    monkeypatch.setattr(M, "GROUP", 6)
    corners = np.array([[0.0, 0.0], [2.0, 0.0], [1.0, 1.9]])
    points = np.concatenate([corners + [x, 0.0] for x in (0, 100, 300, 700)])
    labels = np.arange(len(points))
    seen, apart = [], M._apart

    def noted(*a):
        near = apart(*a)
        seen.append(near.count())
        return near

    monkeypatch.setattr(M, "_apart", noted)
    assert (merged(spark, points, labels, 8) == stepwise(points, labels, 8)).all()
    assert any(seen)


def test_equal_centroids_one_merge_a_round(spark, monkeypatch):
    monkeypatch.setattr(M, "GROUP", 3)
    points = np.array([[1.0, 1.0]] * 4 + [[9.0, 9.0]])
    labels = np.array([4, 8, 2, 6, 1])
    assert (merged(spark, points, labels, 4) == stepwise(points, labels, 4)).all()


def test_edges(spark):
    df = spark.createDataFrame([(1, None, [0.0]), (2, 5, [0.1]), (3, 9, [10.0]), (4, -1, [3.0]), (5, 5, [0.3])], "id long, lbl int, v array<double>")
    got = {r.id: r.m for r in V.merge_clusters(df, "lbl", "v", 1, out="m").collect()}
    assert got == {1: None, 2: 0, 3: 0, 4: -1, 5: 0}
    assert V.merge_clusters(df.filter("id = 0"), "lbl", "v", 1, out="m").count() == 0
    assert {r.m for r in V.merge_clusters(df, "lbl", "v", None, out="m").collect()} == {None, 5, 9, -1}
