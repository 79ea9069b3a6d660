"""Channels and pieces taken from donors, curves held against curves, and means of seconds, against loops."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from terrawave.operators import donors


def test_replaced_is_clipped_to_the_site(spark):
    rows = [("a", c, k, float(k)) for c in ("hx", "ex") for k in range(10, 20)] + [("b", "hx", k, 100.0 + k) for k in range(15, 40)] + [("c", "hx", 1, 7.0)]
    df = spark.createDataFrame(rows, "site string, channel string, k long, x double")
    spec = spark.createDataFrame([("a", "hx", "b"), ("c", "hx", "nowhere"), ("b", "hx", None)], "site string, channel string, donor string")
    got = sorted(map(tuple, donors.replaced(df, spec).collect()))
    want = [("a", "ex", k, float(k)) for k in range(10, 20)] + [("a", "hx", k, 100.0 + k) for k in range(15, 20)] + [("b", "hx", k, 100.0 + k) for k in range(15, 40)]
    assert got == sorted(want)
    assert donors.replaced(df, spec.limit(0)).count() == len(rows)


@pytest.mark.parametrize("block", [7, 1 << 16])
def test_borrowed_pieces(spark, block):
    step = 1_000_000_000 // 8
    local = [("s", 1, 0, 100), ("s", 2, 400 * step, 20), ("off", 1, 0, 50), ("few", 1, 0, 100)]
    theirs = [("n", 1, -30 * step, 50), ("n", 2, 60 * step, 300), ("m", 1, step // 10, 50), ("p", 1, 90 * step, 500)]
    schema = "site string, run int, start_ns long, n long"
    mine, other = spark.createDataFrame(local, schema), spark.createDataFrame(theirs, schema)
    pairs = spark.createDataFrame([("s", "n"), ("off", "m"), ("few", "p")], "site string, donor string")
    pieces = donors.borrowed_pieces(mine, other, pairs, 8.0)
    got = sorted((v["site"], v["run"], v["donor_run"], v["lo"], v["hi"], v["shift"], round(v["off_grid"], 6)) for v in pieces.collect())
    assert got == [("few", 1, 1, 90, 100, 90, 0.0), ("off", 1, 1, 0, 50, 0, 0.1), ("s", 1, 1, 0, 20, -30, 0.0), ("s", 1, 2, 60, 100, 60, 0.0)]
    covers = donors.cover(pieces, mine, pairs)
    assert {(v["site"], v["covered"], v["total"], v["refused"]) for v in covers.collect()} == {("s", 60, 120, None), ("off", 50, 50, "off grid"), ("few", 10, 100, "too little")}
    samples = spark.createDataFrame([(s, r, i, float(i), -1.0) for s, r, _, n in local for i in range(n)], "site string, run int, i long, ex double, hx double")
    lent = spark.createDataFrame([(s, r, i, 1000.0 * r + i) for s, r, _, n in theirs for i in range(n) if (r, i) != (2, 5)], "site string, run int, i long, hx double")
    out = sorted((v["run"], v["i"], v["ex"], v["piece"], v["hx"]) for v in donors.borrowed(samples, lent, pieces, covers, ["hx"], block).where("hx is not null").collect())
    want = [(1, i, float(i), 0, 1000.0 + i + 30) for i in range(20)] + [(1, i, float(i), 60, 2000.0 + i - 60) for i in range(60, 100) if i != 65]
    assert out == want
    assert donors.borrowed(samples, lent, pieces, covers, ["hx"], block).count() == 60


def test_rate_differences_equal_interp(spark):
    r = np.random.default_rng(3)
    period = np.geomspace(1, 100, 9)
    rho, phi = 10 ** r.standard_normal(9), 45 + r.standard_normal(9)
    points = [("s", "xy", rate, f"f{f}", float(p), float(10 ** r.standard_normal()), float(r.uniform(0, 90))) for rate in (1, 10) for f in range(rate + 1) for p in [0.5, *np.geomspace(1, 100, 6), 300.0]]
    points[3] = (*points[3][:5], 0.0, 1.0)
    curve = spark.createDataFrame([("s", "xy", float(p), float(a), float(b)) for p, a, b in zip(period, rho, phi, strict=True)], "site string, mode string, period double, rho double, phi double").repartition(3)
    df = spark.createDataFrame(points, "site string, mode string, rate int, file string, period double, rho double, phi double")
    got = {v["rate"]: v for v in donors.rate_differences(curve, df, ["site"]).collect()}
    assert set(got) == {1, 10, None}
    for rate in got:
        of = [p for p in points if rate in (None, p[2])]
        at = np.log10([p[4] for p in of])
        with np.errstate(divide="ignore"):
            d = np.abs(np.interp(at, np.log10(period), np.log10(rho)) - np.log10([p[5] for p in of]))
        f = np.abs(np.interp(at, np.log10(period), phi) - np.array([p[6] for p in of]))
        assert np.isclose(got[rate]["rho"], np.median(d)) and np.isclose(got[rate]["phi"], np.median(f)) and got[rate]["n"] == len(of) and got[rate]["n_files"] == len({p[3] for p in of})


def test_means_of_seconds(spark):
    r = np.random.default_rng(4)
    x = r.standard_normal(400)
    rows = [("whole", 3 + i, float(v)) for i, v in enumerate(x)] + [("holes", 3 + i, float(v)) for i, v in enumerate(x) if i % 8 < 5 or i < 200] + [("flat", i, 2.0) for i in range(16)] + [("none", 1, None)]
    df = spark.createDataFrame(rows, "site string, k long, x double").repartition(3)
    got = {v["site"]: v for v in donors.block_means_agree(df, ["site"], "x", 8, 1e-9, 0.5).collect()}
    assert set(got) == {"whole", "holes", "flat"}
    assert got["whole"]["passed"] and got["whole"]["mean_error"] < 1e-12 and got["flat"]["passed"] and got["flat"]["mean_error"] == 0
    kept = np.array([v for i, v in enumerate(x) if i % 8 < 5 or i < 200])
    seconds = np.array([np.mean([x[i] for i in range(o, o + 8) if i % 8 < 5 or i < 200]) for o in range(0, 400, 8)])
    assert np.isclose(got["holes"]["mean_error"], abs(seconds.mean() - kept.mean()) / kept.std())
    assert not {v["site"]: v["passed"] for v in donors.block_means_agree(df, ["site"], "x", 8, 1e-9, 1e-9).collect()}["holes"]


def test_long_runs_are_dealt_to_few_stretches(spark, monkeypatch):
    """Runs of forty days, of which each was dealt to as many."""
    n, dealt, join = 40 * 86_400, [], donors.overlap_join

    def counted(left, right, keys, width):
        for df, a, b in ((left, "a", "b"), (right, "a2", "b2")):
            dealt.append(df.selectExpr(f"floor(({b} - 1) / {width}) - floor({a} / {width}) + 1 as m").agg(F.avg("m")).first()[0])
        return join(left, right, keys, width)

    monkeypatch.setattr(donors, "overlap_join", counted)
    rows = [(s, r, (r * 90 + d) * 86_400_000_000_000, n) for s, d in (("s", 0), ("n", 30)) for r in range(30)]
    runs = spark.createDataFrame(rows, "site string, run long, start_ns long, n long")
    got = donors.borrowed_pieces(runs, runs, spark.createDataFrame([("s", "n")], "site string, donor string"), 1.0)
    assert sorted((v["run"], v["donor_run"], v["lo"], v["hi"]) for v in got.collect()) == [(r, r, 30 * 86_400, n) for r in range(30)]
    assert len(dealt) == 2 and max(dealt) <= 2
