"""Scans of small generated files."""

import numpy as np
import pandas as pd
import pytest

from terrawave.sources import files


def test_lemi424(spark, tmp_path):
    line = "2020 01 02 03 04 {s:02d} {x} 2 3 10 11 4 5 6 7 8"
    (tmp_path / "a.txt").write_text("\n".join([*(line.format(s=s, x=s) for s in range(5)), "broken line", line.format(s=9, x="q")]))
    good, bad = files.lemi424(spark, str(tmp_path))
    rows = good.orderBy("t").collect()
    assert [r["hx"] for r in rows] == [0, 1, 2, 3, 4] and rows[0]["ey"] == 5
    assert bad.count() == 2


def test_pr6_24(spark, tmp_path):
    for c in ("BX", "EY"):
        (tmp_path / f"st7200102030405.{c}").write_text("5\n-6\n7\n")
    rows = files.pr6_24(spark, str(tmp_path)).orderBy("channel", "k").collect()
    assert [(r["station"], r["channel"], r["k"], r["x"]) for r in rows] == [("st7", c, k, x) for c in ("ey", "hx") for k, x in enumerate((5, -6, 7))]
    assert str(rows[0]["stamp"]) == "2020-01-02 03:04:05"


def test_b423(spark, tmp_path):
    body = np.zeros(10, files.B423_RECORD)
    body["time"], body["ex"] = np.arange(10), -np.arange(10)
    (tmp_path / "a.b423").write_bytes(b"\0" * 1024 + body.tobytes() + b"xx")
    (tmp_path / "b.b423").write_bytes(b"\0" * 10)
    records = files.b423(spark, str(tmp_path))
    rows = records.orderBy("k").collect()
    assert [(r["k"], r["time"], r["ex"]) for r in rows] == [(i, i, -i) for i in range(10)]
    listed = spark.read.format("binaryFile").load(str(tmp_path)).selectExpr("path as file", "10.0D as seconds")
    out = files.unreadable(records, listed, 1.0).collect()
    assert [(r["file"].endswith("b.b423"), r["reason"]) for r in out] == [(True, "no record")]


@pytest.fixture
def day(spark, tmp_path):
    head = [f" {k:<23}{v:<44} |"[:70] for k, v in (("Format", "IAGA-2002"), ("IAGA Code", "ABC"))]
    data = ["2020-01-02 00:00:0{}.000 002     {}.00  2.00  3.00  99999.00".format(s, 10 + s) for s in (0, 1, 3)]
    (tmp_path / "a.sec").write_text("\n".join([*head, *data]))
    return files.iaga2002(spark, str(tmp_path))


def test_iaga2002(day):
    rows = day.orderBy("t").collect()
    assert [(r["code"], r["x"], r["f"]) for r in rows] == [("ABC", 10.0, None), ("ABC", 11.0, None), ("ABC", 13.0, None)]


def test_complete_days(day):
    full = files.complete_days(day)
    assert full.count() == 86400
    assert full.where("x < 99999").count() == 3
    assert [r["cached"] for r in files.day_coverage(day).collect()] == [True]


def test_observatory(spark, tmp_path):
    pd.DataFrame({"DateTime": pd.to_datetime(["2020-01-01", "2020-01-02", "2020-01-03"]), "BX": [1.0, 2, 3], "BY": 0.0, "BZ": 0.0, "F": 0.0, "pub": "q"}).to_parquet(tmp_path / "o.parquet", coerce_timestamps="us")
    rows = files.observatory(spark, str(tmp_path / "o.parquet"), pd.Timestamp("2020-01-02").to_pydatetime(), pd.Timestamp("2020-01-03").to_pydatetime())
    assert [r["x"] for r in rows.collect()] == [2.0]


def test_pr6_24_in_splits(spark, tmp_path):
    (tmp_path / "AB200102030405.BX").write_text("\n".join(map(str, range(5000))) + "\n\nbad\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = files.pr6_24(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r["k"]: r["x"] for r in rows} == {i: i for i in range(5000)} | {5000: None} and len(rows) == 5001
    assert {(r["station"], r["channel"], str(r["stamp"])) for r in rows} == {("AB", "hx", "2020-01-02 03:04:05")}


def test_iaga2002_bad_fields_and_positions(spark, tmp_path):
    head = [f" {k:<23}{v:<44} |"[:70] for k, v in (("Format", "IAGA-2002"), ("IAGA Code", "ABC"), ("Geodetic Latitude", "-12.5"), ("Geodetic Longitude", "290.25"))]
    (tmp_path / "a.sec").write_text("\n".join([*head, "2020-01-02 00:00:00.000 002 1.00 x 3.00", "2020-13-02 00:00:01.000 002 1 2 3 4"]))
    rows = files.iaga2002(spark, str(tmp_path)).collect()
    assert [(r["x"], r["y"], r["z"], r["f"]) for r in rows] == [(1.0, None, 3.0, None)]
    assert [(r["lat"], r["lon"]) for r in files.iaga2002_positions(spark, str(tmp_path)).collect()] == [(-12.5, -69.75)]
