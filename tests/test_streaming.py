import os
import tempfile

from marisnow.streaming.ingest import start_ingest


def _w(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_incremental_ingest_keeps_first_and_skips_known(spark):
    root = tempfile.mkdtemp(prefix="ms-stream-")
    src, table, ck = f"{root}/in", f"{root}/table", f"{root}/ck"
    cols = ["full_path", "top1"]
    _w(f"{src}/a.csv", "full_path,top1\n/x/Crops/1.png,a\n/x/Crops/1.png,b\n/x/2.png,c\n")
    q = start_ingest(spark, src, table, ck, cols, trigger_once=True)
    q.awaitTermination(120)
    _w(f"{src}/b.csv", "full_path,top1\n/x/2.png,late\n/x/3.png,d\n,empty\n")
    q = start_ingest(spark, src, table, ck, cols, trigger_once=True)
    q.awaitTermination(120)
    rows = {r.full_path: r.top1 for r in spark.read.parquet(table).collect()}
    assert rows == {"/x/Deconv_crops/1.png": "a", "/x/2.png": "c", "/x/3.png": "d"}


def test_paths_that_become_one_are_admitted_once(spark):
    root = tempfile.mkdtemp(prefix="ms-stream-")
    _w(f"{root}/in/a.csv", "full_path,top1\n/r/Crops/1.png,a\n/r/Deconv_crops/1.png,b\n")
    start_ingest(spark, f"{root}/in", f"{root}/table", f"{root}/ck", ["full_path", "top1"], trigger_once=True).awaitTermination(120)
    assert [(r.full_path, r.top1) for r in spark.read.parquet(f"{root}/table").collect()] == [("/r/Deconv_crops/1.png", "a")]
