"""Temp-dir trees: discovery, metadata choice, header groups, TSV tag row,
runs, images and bundle export (ZIP re-read)."""

import os
import tempfile
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from marisnow.operators import export as EX
from marisnow.operators import imageprep as IP
from marisnow.operators.bundles import bundle_export
from marisnow.plans.collect import collect_all_crops
from marisnow.sources import listing as LS
from marisnow.sources import metadata as MD
from marisnow.sources import runs as RN
from marisnow.sources.images import png_bytes, read_image_bytes, read_images


def _w(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def _tree():
    root = tempfile.mkdtemp(prefix="ms-src-")
    base = f"{root}/M1/M1-Profiles"
    eco = lambda p: f"{base}/{p}/{p}_Results/EcoTaxa"
    _w(f"{eco('p1')}/p1_crops_metadata.csv", "full_path,top1,esd\n/x/p1/Crops/a.png,non_living,1.5\n"
                                             "/x/p1/Crops/b.png,copepod,2.5\n/x/p1/Crops/a.png,dup,9\n")
    _w(f"{eco('p1')}/p1_ecotaxa.tsv", "object_full_path\tobject_annotation_category\n[t]\t[t]\n/ignored\tx\n")
    _w(f"{eco('p2')}/ecotaxa_metadata.tsv",
       "object_full_path\tobject_annotation_category\tobject_esd\n[t]\t[t]\t[f]\n/x/p2/Crops/c.png\tdetritus\t3\n")
    _w(f"{eco('p3')}/p3_ecotaxa.tsv", "img_path\tobject_annotation_category\n/x/p3/d.png\tnot_living\n")
    _w(f"{eco('p4')}/weird_metadata.csv", "full_path,top1\n/x/p4/Deconv_crops/e.png,non_living\n")
    _w(f"{base}/p5/p5_Results/log.txt", "no ecotaxa here")
    _w(f"{root}/M2/notes/readme.txt", "cruise without profiles")
    return root


def test_discovery_and_choice(spark):
    root = _tree()
    lst = LS.file_listing(spark, root)
    bases = [r.base for r in LS.resolve_profile_bases(lst, root).collect()]
    assert bases == [f"{root}/M1/M1-Profiles"]
    profs = sorted(r.profile for r in LS.list_profiles(lst, LS.resolve_profile_bases(lst, root)).collect())
    assert profs == ["p1", "p2", "p3", "p4"]
    auto = {r.profile: os.path.basename(r.path) for r in
            LS.pick_metadata_file(lst, LS.list_profiles(lst, LS.resolve_profile_bases(lst, root))).collect()}
    assert auto == {"p1": "p1_crops_metadata.csv", "p2": "ecotaxa_metadata.tsv", "p3": "p3_ecotaxa.tsv",
                    "p4": "weird_metadata.csv"}
    eco = {r.profile: os.path.basename(r.path) for r in
           LS.pick_metadata_file(lst, LS.list_profiles(lst, LS.resolve_profile_bases(lst, root)), "ecotaxa").collect()}
    assert eco["p1"] == "p1_ecotaxa.tsv"
    none = LS.pick_metadata_file(lst, LS.list_profiles(lst, LS.resolve_profile_bases(lst, root)), "auto", ["*.zzz"])
    assert {os.path.basename(r.path) for r in none.collect()} == {"p1_crops_metadata.csv", "ecotaxa_metadata.tsv",
                                                                 "p3_ecotaxa.tsv"}
    with pytest.raises(ValueError):
        LS.pick_metadata_file(lst, LS.list_profiles(lst, LS.resolve_profile_bases(lst, root)), "bogus")
    # root already a profiles base
    assert [r.base for r in LS.resolve_profile_bases(lst, f"{root}/M1/M1-Profiles").collect()] == \
        [f"{root}/M1/M1-Profiles"]
    assert LS.resolve_profile_bases(lst, f"{root}/missing").count() == 0


def test_collect_all_crops(spark):
    root = _tree()
    df = collect_all_crops(spark, root, crop_path_token="auto")
    paths = sorted(r.full_path for r in df.select("full_path").collect())
    # path column chosen on the union (full_path): tsv rows without it are dropped (upstream rule);
    # the duplicate /a.png keeps its first row; Crops -> Deconv_crops; auto keeps deconv rows
    assert paths == ["/x/p1/Deconv_crops/a.png", "/x/p1/Deconv_crops/b.png", "/x/p4/Deconv_crops/e.png"]
    first = {r.full_path: r.top1 for r in df.collect()}
    assert first["/x/p1/Deconv_crops/a.png"] == "non_living"
    both = collect_all_crops(spark, root, crop_path_token=None, coalesce_paths=True)
    assert both.count() == 5


@pytest.mark.parametrize("tags,dropped", [(["[t]", "[f]", "[t]", "[f]", "[t]"], True),
                                          (["[t]", "[f]", "[t]", "x", "y"], True),
                                          (["[t]", "[f]", "x", "y", "z"], False)])
def test_tsv_tag_row(spark, tags, dropped):
    root = tempfile.mkdtemp(prefix="ms-tsv-")
    _w(f"{root}/a.tsv", "c1\tc2\tc3\tc4\tc5\n" + "\t".join(tags) + "\n1\t2\t3\t4\t5\n")
    df = MD.read_metadata(spark, [f"{root}/a.tsv"], infer_numeric=False)
    assert df.count() == (1 if dropped else 2)


def test_tsv_tag_ratio_boundary(spark):
    root = tempfile.mkdtemp(prefix="ms-tsv-")
    # 3 of 5 = 60 % -> dropped; null cells count in the denominator
    _w(f"{root}/b.tsv", "c1\tc2\tc3\tc4\tc5\n[t]\t[f]\t[t]\t\t\n1\t2\t3\t4\t5\n")
    assert MD.read_metadata(spark, [f"{root}/b.tsv"], infer_numeric=False).count() == 1
    _w(f"{root}/c.tsv", "c1\tc2\tc3\tc4\tc5\tc6\tc7\tc8\tc9\tc10\tc11\tc12\tc13\tc14\tc15\tc16\tc17\n"
       + "\t".join(["[t]"] * 10 + ["x"] * 7) + "\n" + "\t".join(["1"] * 17) + "\n")  # 10/17 = 58.8 %
    assert MD.read_metadata(spark, [f"{root}/c.tsv"], infer_numeric=False).count() == 2


def test_runs_and_inventory(spark):
    root = tempfile.mkdtemp(prefix="ms-runs-")
    _w(f"{root}/r1/sample_index.csv", "a\n1\n")
    _w(f"{root}/r1/cluster_assignments.csv", "a\n1\n")
    _w(f"{root}/r2/sample_index.csv", "a\n1\n")
    _w(f"{root}/r2/features_nonliving.h5", "x")
    _w(f"{root}/r2/validation_part_01.zip", "x" * 2000)
    _w(f"{root}/r3/other.txt", "x")
    lst = LS.file_listing(spark, root)
    runs = {os.path.basename(r.run_dir): r.label.split("(")[-1] for r in RN.discover_runs(lst, [root]).collect()}
    assert runs == {"r1": "clustered)", "r2": "features)"}
    inv = {r.artefact: r for r in RN.run_inventory(lst, f"{root}/r2", ["sample_index.csv", "umap_2d.csv"]).collect()}
    assert inv["sample_index.csv"].exists and not inv["umap_2d.csv"].exists
    assert inv["validation_part_01.zip"].size_text == "2 KB"


def _img(arr):
    return png_bytes(arr.astype(np.uint8))


def test_images_and_bbox(spark):
    root = tempfile.mkdtemp(prefix="ms-img-")
    white = np.full((20, 20, 3), 255)
    seven = white.copy(); seven[5, 5:12] = 0            # 7 dark pixels -> no box
    eight = white.copy(); eight[5, 5:13] = 0            # 8 dark pixels -> box
    border = white.copy(); border[0:3, 0:4] = 10        # object on the border
    for name, a in [("white", white), ("seven", seven), ("eight", eight), ("border", border)]:
        with open(f"{root}/{name}.png", "wb") as fh:
            fh.write(_img(a))
    with open(f"{root}/broken.png", "wb") as fh:
        fh.write(b"not a png")
    imgs = read_images(spark, root).withColumn("object_id", F.regexp_extract("image_path", r"([^/]*)\.png$", 1))
    boxes = {r.object_id: (r.x0, r.y0, r.x1, r.y1) for r in IP.bbox_column(imgs).collect()}
    assert boxes["white"] == (None, None, None, None)
    assert boxes["seven"] == (None, None, None, None)
    assert boxes["eight"] == (3, 3, 15, 8)
    assert boxes["border"] == (0, 0, 6, 5)
    assert boxes["broken"] == (0, 0, 64, 64)  # undecodable -> black 64x64 -> full box
    feats = IP.extract_features(imgs, input_size=32).collect()
    assert len(feats) == 5
    for r in feats:
        assert abs(np.linalg.norm(np.asarray(r.features)) - 1.0) < 1e-5
    again = {r.object_id: list(r.features) for r in IP.extract_features(imgs, input_size=32).collect()}
    assert all(np.allclose(again[r.object_id], r.features) for r in feats)


def test_canvas_and_transform():
    rgb = np.zeros((10, 30, 3), dtype=np.uint8)
    c = IP.size_canvas(rgb, 16)
    assert c.shape == (30, 30, 3) and c[0, 0, 0] == 255 and c[10, 0, 0] == 0
    t = IP.inference_transform(np.full((40, 60, 3), 255, dtype=np.uint8), 16)
    assert t.shape == (16, 16, 3)
    assert np.allclose(t[..., 0], (1 - 0.485) / 0.229, atol=1e-4)


def test_bundle_export_roundtrip(spark):
    root = tempfile.mkdtemp(prefix="ms-bnd-")
    rows = []
    for i in range(6):
        p = f"{root}/img/Crops/{i}.png"
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as fh:
            fh.write(b"x" * (400_000 if i != 3 else 1_200_000))
        rows.append((str(i), p, "non_living" if i % 2 else "copepod", float(i)))
    rows.append(("9", f"{root}/img/Crops/missing.png", "copepod", 1.0))
    df = spark.createDataFrame(rows, "object_id string, full_path string, top1 string, esd double")
    et = EX.build_export_table(df, keep_source=True)
    imgs = read_image_bytes(spark, f"{root}/img/Crops")
    out = f"{root}/zips"
    res = {(r.group, r.part): r for r in bundle_export(et, imgs, out, max_mb=1.0, split_mode="living_non_living")
           .collect()}
    assert set(res) == {("living", 1), ("living", 2), ("non_living", 1), ("non_living", 2), ("non_living", 3)}
    total = 0
    for (g, p), r in res.items():
        with zipfile.ZipFile(r.zip_path) as z:
            names = z.namelist()
            tsv = [n for n in names if n.endswith(".tsv")][0]
            assert tsv == f"ecotaxa_validation_{g}_part_{p:02d}.tsv"
            lines = z.read(tsv).decode().splitlines()
            assert lines[1].split("\t")[0] == "[t]"
            total += len(lines) - 2
            assert len(names) - 1 == len(lines) - 2
    assert total == 6


def test_run_config_and_cache_sidecar(spark):
    from marisnow.plans.cluster_run import RunConfig
    root = tempfile.mkdtemp(prefix="ms-cfg-")
    cfg = RunConfig(source_root="/src", n_samples=10).to_dict()
    assert len(cfg) == 19
    RN.save_json(spark, f"{root}/run_config.json", cfg)
    assert RN.load_json(spark, f"{root}/run_config.json") == cfg
    assert RN.load_json(spark, f"{root}/missing.json") is None
    settings = {"source_root": "/src", "metadata_patterns": None, "metadata_choice": "auto",
                "crop_path_token": "auto", "crop_filter_strict": True, "rewrite_crops_to_deconv": True}
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)
    path = f"{root}/cache"
    assert RN.metadata_cache(spark, path, settings, build).count() == 3
    assert RN.metadata_cache(spark, path, settings, build).count() == 3
    assert len(calls) == 1  # second call reused the cache
    changed = dict(settings, metadata_choice="crops")
    RN.metadata_cache(spark, path, changed, build)
    assert len(calls) == 2  # settings changed -> rebuild
    RN.metadata_cache(spark, path, changed, build, refresh=True)
    assert len(calls) == 3


def test_sample_sinks_write_and_read_every_particle(spark, monkeypatch):
    from marisnow.plans import q_sources as Q
    runs, write = [], RN.write_sample_index
    monkeypatch.setattr(Q.RN, "write_sample_index", lambda df, run, *a: runs.append(run) or write(df, run, *a))
    sf = "/root/testdata/sf0.01"
    n = Q.particles(spark, sf).count()
    assert Q.q_write_sample_index(spark, sf).count() == Q.q_load_export_inputs(spark, sf).count() == n
    assert [RN.read_sample_index(spark, run).count() for run in runs] == [n, n]


def test_cluster_run_labels_every_sampled_non_living_object(spark):
    from marisnow.operators.rows import augmented_non_living
    from marisnow.plans.q_cluster import q_cluster_run
    from marisnow.schemas import DEFAULT_NON_LIVING_CLASSES
    from marisnow.sources.tables import particles
    sf = "/root/testdata/sf0.001"
    flagged = augmented_non_living(particles(spark, sf), "top1", tuple(DEFAULT_NON_LIVING_CLASSES), "nl")
    want = {r.object_id for r in flagged.filter("nl").select("object_id").collect()}
    got = [r.object_id for r in q_cluster_run(spark, sf).select("object_id").collect()]
    assert len(want) > 300 and set(got) == want and len(got) == len(want)


def test_tagged_files_come_back_equal_and_in_order(spark):
    from marisnow.operators.bundles import write_tagged_tsv
    from marisnow.session import scratch_path
    cells = ["plain", "a\tb", "line\nbreak", 'q"x', "", None, 'both "t"\tand\nn', "\r"]
    rows = [(i, cells[i % len(cells)], i * 0.5, "x" if i % 3 else "y") for i in range(120)]
    df = spark.createDataFrame(rows, "k long, name string, v double, f string").repartition(5)
    path = write_tagged_tsv(df, scratch_path(spark, "tsv"), "f", ["k"])
    for f in ("x", "y"):
        import csv
        import glob
        text = "".join(open(p, newline="", encoding="utf-8").read() for p in sorted(glob.glob(f"{path}/_f={f}/part-*")))
        got = list(csv.reader(text.splitlines(keepends=True), delimiter="\t"))
        assert got[:2] == [["k", "name", "v"], ["[f]", "[t]", "[f]"]]
        assert got[2:] == [[str(k), n or "", str(v)] for k, n, v, g in rows if g == f]


def test_reduction_of_an_empty_table(spark):
    from marisnow.operators.reduce import pca_reduce
    out = pca_reduce(spark.createDataFrame([], "id long, v array<double>"), "v", 3)
    assert out.count() == 0 and "embedding" in out.columns
