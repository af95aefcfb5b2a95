"""The excess-of-mass totals of a deep cluster tree, in few rounds."""

import numpy as np

from marisnow.operators import hdbscan


def tree_of(depth, seed=3):
    """A caterpillar: each cluster has a leaf and the next cluster."""
    rng = np.random.default_rng(seed)
    rows, up = [], 10 * depth + 10
    rows.append((up, None))
    for i in range(depth):
        c = up - 10
        rows += [(up - 5, up), (c, up)]
        up = c
    return [(c, u, 0.0, float(rng.integers(0, 6))) for c, u in rows]


def plain(rows):
    kids, own = {}, {c: s for c, _, _, s in rows}
    for c, u, _, _ in rows:
        kids.setdefault(u, []).append(c)
    value, wins = {}, {}
    for c in sorted(own):  # children have lesser ranks
        total = sum(value[k] for k in kids.get(c, []))
        value[c], wins[c] = max(own[c], total), c not in kids or own[c] >= total
    return value, wins, kids


def test_totals_of_a_deep_tree_take_few_rounds(spark, monkeypatch):
    rows = tree_of(60)
    tree = spark.createDataFrame(rows, "c long, up long, birth double, stability double")
    cuts = []
    cut = hdbscan._cut
    monkeypatch.setattr(hdbscan, "_cut", lambda df: cuts.append(1) or cut(df))
    got = {r.c for r in hdbscan.select_clusters(tree).collect()}
    value, wins, kids = plain(rows)
    root, want, todo = rows[0][0], set(), list(kids[rows[0][0]])
    while todo:
        c = todo.pop()
        if wins[c]:
            want.add(c)
        else:
            todo += kids[c]
    assert got == want and root not in got
    assert len(cuts) < 40  # a level at a time took two a level


def test_a_chain_beyond_the_limit_goes_on_in_the_next_round(spark, monkeypatch):
    rows = tree_of(12, seed=5)
    monkeypatch.setattr(hdbscan, "CHAIN", 4)
    tree = spark.createDataFrame(rows, "c long, up long, birth double, stability double")
    inner = tree.filter("up is not null")
    leaf = inner.join(inner.select("up").distinct().withColumnRenamed("up", "c"), "c", "left_anti")
    value, wins, _ = plain(rows)
    got = {r.c: (r.value, r.wins) for r in hdbscan._excess(inner, leaf).collect()}
    assert got == {c: (value[c], wins[c]) for c, u, _, _ in rows if u is not None}
