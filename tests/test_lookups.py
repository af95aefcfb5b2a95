from marisnow.operators.labels import lookup_area, path_to_object_id


def test_area_column_preference_and_position(spark):
    feats = spark.createDataFrame([("1", 0.5), ("2", 0.6), ("9", 0.7)], "object_id string, f double")
    both = spark.createDataFrame([(1, "3.5", 9.0), (2, "bad", 8.0), (1, "4.5", 7.0)], "object_id long, object_area string, area double")
    assert {r.object_id: r.area for r in lookup_area(feats, both).collect()} == {"1": 4.5, "2": None, "9": None}
    assert {r.object_id: r.area for r in lookup_area(feats, both, "area").collect()} == {"1": 7.0, "2": 8.0, "9": None}
    assert "area" not in lookup_area(feats, both.select("object_id")).columns
    bare = spark.createDataFrame([(5.0,), (6.0,), (None,)], "area double").coalesce(1)
    got = {r.object_id: r.area for r in lookup_area(feats.coalesce(1), bare).collect()}
    assert got == {"1": 5.0, "2": 6.0, "9": None}
    assert "area" not in lookup_area(feats, bare.limit(2)).columns


def test_paths_without_an_id_take_their_row_number(spark):
    paths = spark.createDataFrame([(p,) for p in ("/a", "/b", "/c", None)], "image_path string").coalesce(1)
    parts = spark.createDataFrame([(7, "/a", 1), (8, "/a", 2), (9, "/c", 3)], "object_id long, full_path string, o int")
    got = {r.image_path: r.object_id for r in path_to_object_id(paths, parts, order_col="o", row_default=True).collect()}
    assert got == {"/a": "8", "/b": "1", "/c": "9", None: "3"}
    plain = {r.image_path: r.object_id for r in path_to_object_id(paths, parts, order_col="o").collect()}
    assert plain == {"/a": "8", "/b": None, "/c": "9", None: None}


def test_run_without_non_living_particles_ends_early(spark):
    from marisnow.plans.cluster_run import RunConfig, cluster_run
    parts = spark.createDataFrame([("1", "/a.png", "copepod"), ("2", "/b.png", "fish")], "object_id string, full_path string, top1 string")
    feats = spark.createDataFrame([("1", "/a.png", [1.0, 2.0])], "object_id string, image_path string, features array<double>")
    got = cluster_run(spark, parts, feats, RunConfig(n_samples=10))
    assert got["sample"].count() == 2 and got["assignments"].count() == 0 and got["stats"]["clusters"] == 0
    assert got["assignments"].columns == ["object_id", "image_path", "cluster_raw", "cluster_final", "cluster_label"]
