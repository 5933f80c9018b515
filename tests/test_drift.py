"""Files of one table with different headers."""

from __future__ import annotations

import gzip

import pytest

from strata.contracts import RunPlan, TableContract
from strata.plans import run
from strata.sources import drift_report, layer_path, read_layer, scan_drifting
from tests.test_scale import plan


@pytest.fixture()
def folder(tmp_path):
    root = tmp_path / "in"
    (root / "sub").mkdir(parents=True)
    (root / "a.csv").write_text("id,name,x\n1,ok,2\n2,short\n")
    (root / "b.csv").write_text('x,id,"na,me"\n5,3,q\n6,4,w,extra\n')
    (root / "c.csv").write_text("id,name,x\n7,\"n,m\",8\n")
    (root / "d.csv").write_text("")
    (root / "sub" / "f.csv").write_text("﻿ID,y\n11,é\n")
    with gzip.open(root / "e.csv.gz", "wt") as file:
        file.write("id,x\n9,10\n")
    (root / "_skip.csv").write_text("zzz\n1\n")
    return str(root)


def test_columns_are_united_by_name(spark, folder):
    df = scan_drifting(spark, folder, corrupt_column="bad", rename={"na,me": "name"})
    assert df.columns == ["id", "name", "x", "y", "bad"]
    rows = {r.id: tuple(r)[1:] for r in df.collect()}
    assert rows == {
        "1": ("ok", "2", None, None),
        "2": ("short", None, None, "2,short"),
        "3": ("q", "5", None, None),
        "4": ("w", "6", None, "6,4,w,extra"),
        "7": ("n,m", "8", None, None),
        "9": (None, "10", None, None),
        "11": (None, None, "é", None),
    }
    assert plan(df).count("FileScan csv") == 4  # a.csv and c.csv share one


def test_drift_is_reported(spark, folder):
    got = {r["column"]: (r.files, r.missing) for r in drift_report(spark, folder).collect()}
    assert got["x"] == (4, 1) and got["na,me"] == (1, 4) and got["ID"] == (1, 4)


def test_headers_that_cannot_be_united_raise(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x\n1,2\n")
    (tmp_path / "b.csv").write_text("3,4\n5,6\n")  # has lost its header
    with pytest.raises(ValueError, match="no column in common"):
        scan_drifting(spark, str(tmp_path))
    (tmp_path / "b.csv").write_text("id,X,x\n1,2,3\n")
    with pytest.raises(ValueError, match="stands twice"):
        scan_drifting(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        scan_drifting(spark, str(tmp_path / "absent"))
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "a.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        scan_drifting(spark, str(tmp_path / "e"))


def test_a_run_over_drifting_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,v\n1,10\n")
    (tmp_path / "in" / "b.csv").write_text("v,id,extra\n20,2,e\n30,3\n")
    plan_ = RunPlan((TableContract("t", {"id": "INT", "v": "INT"}, ("id",)),))
    result = run(spark, plan_, {"t": str(tmp_path / "in")}, str(tmp_path / "out"), drifting=True)
    assert sorted(map(tuple, result.store["t"].frame.collect())) == [(1, 10), (2, 20), (3, 30)]
    assert result.raw["t"].metrics["scan::malformed_lines"] == 1
    assert read_layer(spark, layer_path(str(tmp_path / "out"), "raw", "t")).frame.columns == ["id", "v", "extra", "MalformedLine"]
