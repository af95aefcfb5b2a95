import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from seq_hdbscan import hdbscan_seq
from marisnow.operators.hdbscan import hdbscan


def _same_partition(a, b):
    """Equal labelings up to renaming (noise must match exactly)."""
    a, b = np.asarray(a), np.asarray(b)
    if not np.array_equal(a == -1, b == -1):
        return False
    m = {}
    for x, y in zip(a, b):
        if m.setdefault(x, y) != y:
            return False
    return len(set(m.values())) == len(m)


def _run(spark, x, mcs, ms=None, method="eom", epsilon=0.0):
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, v array<double>")
    r = hdbscan(df, "id", "v", min_cluster_size=mcs, min_samples=ms,
                cluster_selection_epsilon=epsilon, cluster_selection_method=method, block_rows=64)
    got = dict((int(a), int(b)) for a, b in r.collect())
    return np.array([got[i] for i in range(len(x))])


def test_blobs_match_sequential(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.4, (40, 2)) for c in [(0, 0), (5, 0), (0, 5)]]
                       + [rng.uniform(-3, 8, (10, 2))])
    exp = hdbscan_seq(x, 8)
    got = _run(spark, x, 8)
    assert _same_partition(got, exp)
    assert len(set(got) - {-1}) == 3


def test_embeddings_match_sequential(spark):
    r = duckdb.sql("select vec_id, embedding from '/root/testdata/sf0.001/embeddings.parquet' order by vec_id").fetchall()
    x = np.array([a[1] for a in r], dtype=np.float64)
    for mcs, ms in ((5, None), (4, 3)):
        exp = hdbscan_seq(x, mcs, ms)
        got = _run(spark, x, mcs, ms)
        assert _same_partition(got, exp), (mcs, ms)


def test_leaf_selection(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 0.3, (25, 2)) for c in [(0, 0), (2.5, 0), (10, 0)]])
    exp = hdbscan_seq(x, 6, method="leaf")
    got = _run(spark, x, 6, method="leaf")
    assert _same_partition(got, exp)


def test_epsilon_lifts_clusters_born_below_it(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 0.3, (20, 2)) for c in [(0, 0), (2.5, 0), (12, 0)]])
    got = _run(spark, x, 6, method="leaf", epsilon=4.0)
    near, far = set(got[:40]), set(got[40:])
    assert len(near) == len(far) == 1 and near != far and -1 not in near | far


def test_all_noise_when_too_few(spark):
    x = np.random.default_rng(3).normal(0, 1, (12, 3))
    got = _run(spark, x, 20)
    assert (got == -1).all()
