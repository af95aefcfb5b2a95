"""Metadata readers on small splits: quoted line breaks, headers, tag rows."""

from __future__ import annotations

import csv
import random

import pytest

from marisnow.sources import metadata as MD


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def _cells(rng, n):
    pieces = ["plain", "a,b", "two\nlines", 'say "x"', "tab\there", 'end"', "\n\n", 'five 5" lens', "", "x" * 90, "cr\r\nlf"]
    return [[str(i), rng.choice(pieces), rng.choice(pieces), rng.choice(pieces)] for i in range(n)]


def test_records_over_splits(small_splits, tmp_path):
    spark, rng, want = small_splits, random.Random(3), {}
    files = []
    for name, sep, end in (("a.csv", ",", "\n"), ("b.csv", ",", "\r\n"), ("c.tsv", "\t", "\n")):
        rows = _cells(rng, 120)
        path = tmp_path / name
        with open(path, "w", newline="") as fh:
            w = csv.writer(fh, delimiter=sep, lineterminator=end)
            w.writerow(["id", "p", "q", "r"] if name != "b.csv" else ["q", "id", "Line\nbreak", "p"])
            if name == "c.tsv":
                w.writerow(["[f]", "[t]", "[t]", "[t]"])
            w.writerows(rows)
        files.append(str(path))
        names = ["id", "p", "q", "r"] if name != "b.csv" else ["q", "id", "Line\nbreak", "p"]
        want[str(path)] = [{k: v or None for k, v in zip(names, r)} for r in rows]
    df = MD.read_metadata(spark, files, infer_numeric=False)
    assert [c for c in df.columns if not c.startswith("_")] == ["id", "p", "q", "r", "Line\nbreak"]
    got = df.orderBy("_source_file", "_block", "_row").collect()
    for path, rows in want.items():
        mine = [r for r in got if r["_source_file"] == path]
        assert [{k: r[k] for k in rows[0]} for r in mine] == rows, path
        assert all(r[c] is None for r in mine for c in ("r", "Line\nbreak") if c not in rows[0])
    assert len({(r["_source_file"], r["_block"]) for r in got}) > 20  # many splits


def test_stray_and_open_quotes(small_splits, tmp_path):
    (tmp_path / "stray.csv").write_text('a,b\n1,5" lens\n\n2,"x"y\n3,z"\n')
    (tmp_path / "open.csv").write_text('a,b\n4,"never\nclosed\n5,x\n')
    (tmp_path / "empty.csv").write_text("")
    df = MD.read_metadata(small_splits, [str(p) for p in tmp_path.glob("*.csv")], infer_numeric=False)
    assert [r.a for r in df.orderBy("a").collect()] == ["1", "2", "3"]
    assert [r.b for r in df.orderBy("a").collect()][::2] == ['5" lens', 'z"']
    with pytest.raises(RuntimeError):
        MD.read_metadata(small_splits, [str(tmp_path / "open.csv")])


def test_header_names():
    assert MD.header_names('a,,A,"x,y"', ",") == ["a0", "_c1", "A2", "x,y"]
