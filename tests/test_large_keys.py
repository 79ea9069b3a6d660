"""Queries against their SQL where keys are large, spans tie or means lie on a limit, and joins whose sides only look small."""

import datetime
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from terrawave.functions import names
from terrawave.operators import blocks, intervals, masking, runs, space
from terrawave.plans import catalog


def _agrees(spark, tmp_path, name, **tables):
    c = duckdb.connect()
    for t, df in tables.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
        c.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    df = catalog.queries()[name](spark, str(tmp_path))
    rel = c.sql(catalog.oracle_sql()[name])
    at = [rel.columns.index(k) for k in sorted(rel.columns)]
    want = sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)
    got = sorted((tuple(r[k] for k in sorted(df.columns)) for r in df.collect()), key=repr)
    assert got == want and got
    return got


def _orders(spark, rows):
    return spark.createDataFrame([(k, c, datetime.datetime(1995, 3, 1) + datetime.timedelta(days=d)) for k, c, d in rows], "o_orderkey long, o_custkey long, o_orderdate timestamp")


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_cells_of_spans_are_not_broadcast(spark):
    rows = spark.range(100).select(F.lit("a").alias("site"), F.col("id").alias("k"), F.lit(1.0).alias("x"), F.lit(0.0).alias("level"))
    spans = spark.createDataFrame([("a", 10, 30)], "site string, a2 long, b2 long")
    out = masking.spans_filled(rows, spans, ["site"], "x", "level", 4, 8)
    assert "Broadcast" not in _plan(out)
    assert out.where("x = 0").count() == 12


def test_dealt_intervals_are_not_broadcast(spark):
    x = spark.createDataFrame([("a", 0, 500), ("b", 3, 9)], "site string, a long, b long")
    y = spark.createDataFrame([("a", 499, 2000), ("b", 9, 12)], "site string, a2 long, b2 long")
    out = intervals.overlap_join(x, y, ["site"], 1)
    assert "Broadcast" not in _plan(out)
    assert [tuple(r) for r in out.collect()] == [("a", 0, 500, 499, 2000)]


def test_indices_of_nanoseconds_beyond_a_long(spark):
    t = 37 * 10**18 + 1
    got = spark.range(1).select(names.ceil_index(F.lit(str(t)).cast("decimal(24,0)"), F.lit(24_000)).alias("i")).first()["i"]
    assert got == -(-t * 24_000 // 10**9)


def test_masks_of_large_ids(spark, tmp_path):
    _agrees(spark, tmp_path, "masks_on_grid", events=spark.createDataFrame([(i,) for i in (0, 1, 5, 9000, 2_400_000, 2_500_000, 5_999_999)], "event_id long"))


@pytest.mark.parametrize("key", [0, 3_000_000, 3_400_000, 8_999_999])
def test_times_in_names_of_large_keys(spark, tmp_path, key):
    got = _agrees(spark, tmp_path, "file_times_named", orders=_orders(spark, [(key + i, (3 - key - i) % 8, i) for i in range(8)]))
    assert all(v[-1] == "phoenix" for v in got)


def test_files_of_one_span_stand_in_one_order(spark, tmp_path):
    rows = [(60 * i + j, 1, 100 * j) for i in (5, 3, 4, 1, 2) for j in (1, 2, 59)]
    _agrees(spark, tmp_path, "files_split_at_gaps", orders=_orders(spark, rows))
    files = spark.createDataFrame([("a", i, 0, 200) for i in (4, 2, 3, 1)], "site string, id int, a int, b int")
    assert {(r["id"], r["run"]) for r in runs.split_at_gaps(files, ["site"], 90, ties=("id",)).collect()} == {(i, i) for i in range(1, 5)}


def test_means_at_the_limit_are_not_usable(spark, tmp_path):
    parts = (0.02, 0.07)  # their mean is 0.045; as doubles added up in this order it is more
    rows = [(s, 2, float(q), d) for s in range(4) for q in range(1, 41) for d in parts]
    spark.createDataFrame(rows, "l_suppkey long, l_linenumber int, l_quantity double, l_discount double").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert catalog.queries()["first_lattice"](spark, str(tmp_path)).isEmpty()


def test_runs_a_thousandth_before_the_grid_stand_on_it(spark, tmp_path):
    got = _agrees(spark, tmp_path, "runs_on_grid", orders=_orders(spark, [(k, 1, 0) for k in (0, 124_875, 249_875, 499_875, 7, 2_766_000, 2_767_500, 8_999_999)]))
    assert [v[1] for v in got if v[2] in (124_875, 249_875, 499_875)] == [True] * 3


def test_days_are_not_rows_before_they_are_counted(spark, tmp_path):
    orders = _orders(spark, [(k, k % 3, k % 40) for k in range(200)])
    _agrees(spark, tmp_path, "members_per_day", orders=orders)
    for name, cut in (("members_per_day", "sequence(a"), ("window_list", "/ 30.0")):
        lines = [re.sub(r"#\d+L?", "", v) for v in _plan(catalog.queries()[name](spark, str(tmp_path))).split("== Initial Plan")[0].splitlines()]
        assert [v for v in lines if "Generate" in v and cut in v]
        if name == "members_per_day":
            assert [i for i, v in enumerate(lines) if "Generate" in v][0] < [i for i, v in enumerate(lines) if "Aggregate" in v or "Window" in v][0]


def test_filters_take_few_blocks_at_a_time(spark):
    rows = spark.range(100).select(F.col("id"), F.array(F.lit(1.0)).alias("x")).coalesce(1)

    def fn(part):
        return part.assign(n=len(part))[["id", "n"]]

    most = [r["n"] for r in blocks.by_slices(rows, fn, spark.range(0).selectExpr("id", "id as n").schema).collect()]
    assert len(most) == 100 and max(most) == blocks.SLICE


def test_many_points_at_one_place(spark):
    rows = [(i, 10.0 if i < 60 else 11.0 + i % 3, 20.0) for i in range(100, -1, -1)]
    seen = space.nearest(spark.createDataFrame(rows, "id long, lat double, lon double"), 3).collect()
    at = dict((i, lat) for i, lat, _ in rows)
    got = {}
    for r in seen:
        got.setdefault(r["id"], []).append((r["place"], r["other"]))
    for i, lat in at.items():
        want = sorted((round(abs(lat - v), 9), o) for o, v in at.items() if o != i)[:3]
        assert [o for _, o in sorted(got[i])] == [o for _, o in want]
