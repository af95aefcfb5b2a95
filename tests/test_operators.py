"""Hand cases for row operators, export, labels, sampling, vectors, bundles."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marisnow.operators import bundles as BU
from marisnow.operators import export as EX
from marisnow.operators import labels as LB
from marisnow.operators import rows as RW
from marisnow.operators import vectors as V


def test_path_token_filter_modes(spark):
    df = spark.createDataFrame([("/a/Deconv_crops/1.png",), ("/a/Crops/2.png",), ("/a/x/3.png",)], "p string")
    assert RW.path_token_filter(df, "p", None).count() == 3
    assert RW.path_token_filter(df, "p", "off").count() == 3
    assert [r.p for r in RW.path_token_filter(df, "p", "auto").collect()] == ["/a/Deconv_crops/1.png"]
    no_deconv = df.filter(~F.col("p").contains("Deconv"))
    assert [r.p for r in RW.path_token_filter(no_deconv, "p", "auto").collect()] == ["/a/Crops/2.png"]
    neither = df.filter(F.col("p").contains("/x/"))
    assert RW.path_token_filter(neither, "p", "auto").count() == 1
    assert RW.path_token_filter(df, "p", "CROPS").count() == 2
    assert RW.path_token_filter(df, "p", "zzz", strict=False).count() == 3
    with pytest.raises(Exception):
        RW.path_token_filter(df, "p", "zzz", strict=True).collect()


def test_dedup_keep_first(spark):
    df = spark.createDataFrame([("a", "f2", 0, 1), ("a", "f1", 5, 2), ("a", "f1", 3, 3), ("b", "f9", 0, 4)],
                               "p string, f string, r int, v int")
    got = {r.p: r.v for r in RW.dedup_first(df, ["p"], ["f", "r"]).collect()}
    assert got == {"a": 3, "b": 4}


def test_random_sample_exact_and_reproducible(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("object_id"))
    a = sorted(r[0] for r in RW.random_sample(df, 100, 7).collect())
    b = sorted(r[0] for r in RW.random_sample(df.repartition(13), 100, 7).collect())
    assert a == b and len(a) == 100
    assert RW.random_sample(df, 5000, 7).count() == 1000
    assert sorted(r[0] for r in RW.random_sample(df, 100, 8).collect()) != a


def test_augmentation(spark):
    df = spark.createDataFrame([("not_living",), ("copepod",)], "c string")
    got = [r.nl for r in RW.augmented_non_living(df, "c", ("non_living",), "nl").orderBy("c").collect()]
    assert got == [False, True]
    df2 = spark.createDataFrame([("not_living",), ("non_living",)], "c string")
    got2 = {r.c: r.nl for r in RW.augmented_non_living(df2, "c", ("non_living",), "nl").collect()}
    assert got2 == {"not_living": False, "non_living": True}


def test_export_table_and_filters(spark):
    df = spark.createDataFrame(
        [("1", "/a/Crops/1.png", "non_living", "12.5", 20240105.0),
         ("2", "/a/Crops/2.png", "copepod", "x", None),
         ("3", "/b/3.png", None, None, 5.0)],
        "object_id string, full_path string, top1 string, esd string, date double")
    lab = spark.createDataFrame([("3", "non_living/cluster_01", 1), ("3", "non_living/cluster_02", 2)],
                                "object_id string, cluster_label string, o int")
    et = EX.build_export_table(df, lab, label_order="o")
    rows = {r.object_id: r for r in et.collect()}
    assert rows["1"].object_annotation_category == "non living"
    assert rows["3"].object_annotation_category == "non_living/cluster_02"
    assert rows["1"].img_file_name == "1.png" and rows["1"].object_date == "20240105"
    assert rows["3"].object_date == "00000005" and rows["2"].object_date == ""
    assert rows["1"].object_annotation_status == "predicted"
    assert EX.esd_range_filter(et, 12.5, 12.5).count() == 1
    assert EX.esd_range_filter(et, None, 100).count() == 1
    assert EX.esd_range_filter(et.drop("object_esd"), 1, 2).count() == 3
    c = EX.count_export(df, lab).first()
    assert (c.total, c.living, c.non_living) == (3, 1, 2)
    assert EX.category_filter(et, "living").count() == 1
    assert EX.category_filter(et, "whatever").count() == 3


def test_apply_labels_casts_ids(spark):
    df = spark.createDataFrame([(1, "x")], "object_id long, c string")
    lab = spark.createDataFrame([("1", "L")], "object_id string, cluster_label string")
    assert LB.apply_labels(df, lab, target="c").first().c == "L"


def _pts(spark, rows):
    return spark.createDataFrame(rows, "id long, lbl int, v array<double>")


def test_assign_noise_ties_and_edges(spark):
    pts = _pts(spark, [(1, 0, [0.0, 0.0]), (2, 1, [2.0, 0.0]), (3, -1, [1.0, 0.0]), (4, -1, [1.9, 0.0])])
    got = {r.id: r.cluster_final for r in V.assign_noise(pts, "lbl", "v").collect()}
    assert got == {1: 0, 2: 1, 3: 0, 4: 1}  # exact tie -> first id
    all_noise = _pts(spark, [(1, -1, [0.0]), (2, -1, [1.0])])
    assert {r.cluster_final for r in V.assign_noise(all_noise, "lbl", "v").collect()} == {0}
    no_noise = _pts(spark, [(1, 3, [0.0])])
    assert V.assign_noise(no_noise, "lbl", "v").first().cluster_final == 3


def test_merge_clusters(spark):
    pts = _pts(spark, [(1, 0, [0.0]), (2, 5, [0.1]), (3, 9, [10.0]), (4, -1, [3.0])])
    got = {r.id: r.m for r in V.merge_clusters(pts, "lbl", "v", 2, out="m").collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: -1}
    comp = {r.id: r.m for r in V.merge_clusters(pts, "lbl", "v", 2, out="m", compat_noise=True).collect()}
    assert comp[4] == 0
    assert {r.m for r in V.merge_clusters(pts, "lbl", "v", 3, out="m").collect()} == {0, 5, 9, -1}
    assert {r.m for r in V.merge_clusters(pts, "lbl", "v", 1, out="m").collect()} == {0, -1}
    with pytest.raises(ValueError):
        V.merge_clusters(pts, "lbl", "v", 0)


def test_append_log_area(spark):
    rows = [(1, [1.0], 10.0), (2, [1.0], None), (3, [1.0], -5.0), (4, [1.0], 1000.0)]
    df = spark.createDataFrame(rows, "id long, features array<float>, area double")
    out = {r.id: r.features for r in V.append_log_area(df, "area", "features", "append_log_area", 2.0).collect()}
    areas = np.array([10.0, 100.0 * 0 + 10.0, 10.0, 1000.0])  # invalid -> median of valid (10, 1000) = 505
    areas = np.array([10.0, 505.0, 505.0, 1000.0])
    lg = np.log1p(areas)
    z = 2.0 * (lg - lg.mean()) / lg.std()
    for i, k in enumerate([1, 2, 3, 4]):
        assert len(out[k]) == 2 and math.isclose(out[k][1], z[i], rel_tol=1e-5)
    same = V.append_log_area(df.withColumn("area", F.lit(5.0)), "area", "features", "append_log_area", 1.0)
    assert len(same.first().features) == 1  # zero variance -> unchanged
    assert V.append_log_area(df, "area", "features", "bogus", 1.0) is df
    assert V.append_log_area(df, "area", "features", "append_log_area", 0.0) is df


def _plan(spark, sizes, limit):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "i int, s long")
    r = BU.bundle_plan(df, "s", ["i"], limit)
    return [x.part for x in r.orderBy("i").collect()]


def _greedy(sizes, limit):
    parts, part, running = [], 1, 0
    for s in sizes:
        if running + s > limit and running > 0:
            part, running = part + 1, 0
        running += s
        parts.append(part)
    return parts


@pytest.mark.parametrize("sizes", [[4, 6, 1], [11], [0, 11, 1], [10, 0, 1], [3, 3, 3, 3, 3, 20, 1, 9, 2]])
def test_bundle_plan_greedy(spark, sizes):
    assert _plan(spark, sizes, 10) == _greedy(sizes, 10)


def test_bundle_plan_empty(spark):
    df = spark.createDataFrame([], "i int, s long")
    assert BU.bundle_plan(df, "s", ["i"], 10).count() == 0
