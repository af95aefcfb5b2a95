"""The readers' queries give every row that was written."""

from marisnow.plans import registry


def test_read_features_gives_unlabelled_vectors_too(spark, tmp_path):
    rows = [(1, [1.0, 2.0], 3), (2, [0.5, -0.25], None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.object_id: (r.dim, r["head"], r["tail"], r.s) for r in registry.queries()["read_features"](spark, str(tmp_path)).collect()}
    assert got == {"1": (2, 1.0, 2.0, 3.0), "2": (2, 0.5, -0.25, 0.25)}
    assert "where" not in registry.oracle_sql()["read_features"].lower()


def test_read_sample_index_gives_every_row(spark, tmp_path):
    orders = [(k, 1, 100.0 + k, "1995-01-0" + str(k)) for k in range(1, 8)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double, d string") \
        .selectExpr("o_orderkey", "o_custkey", "o_totalprice", "cast(d as date) as o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 1, 5.0)], "c_custkey long, c_nationkey int, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, "PERU", 2)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    got = registry.queries()["read_sample_index"](spark, str(tmp_path))
    assert got.columns == ["object_id", "full_path", "top1", "area", "cruise"]
    assert {r.object_id: r.area for r in got.collect()} == {str(k): 100.0 + k for k in range(1, 8)}
