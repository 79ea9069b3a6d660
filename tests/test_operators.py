"""Operators against plain versions on small data."""

import random

import numpy as np
from pyspark.sql import functions as F

from terrawave.operators import estimate, intervals, spectra


def _spans(spark, n=60, seed=0):
    r = random.Random(seed)
    rows = [("s%d" % (i % 3), a := r.randint(0, 300), a + r.randint(1, 20)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "site string, a long, b long")


def _cells(rows):
    return {(s, k) for s, a, b in rows for k in range(a, b)}


def test_union_and_complement_cover_the_line(spark):
    rows, df = _spans(spark)
    merged = [tuple(x) for x in intervals.union(df, ["site"]).collect()]
    assert _cells(merged) == _cells(rows)
    within = spark.createDataFrame([(s, 0, 330) for s in ("s0", "s1", "s2")], "site string, lo long, hi long")
    gaps = [tuple(x) for x in intervals.complement(df, ["site"], within).collect()]
    assert not _cells(gaps) & _cells(rows)
    assert len(_cells(gaps) | _cells(rows)) == 3 * 330


def test_overlap_join_does_not_depend_on_the_bucket(spark):
    rows, df = _spans(spark)
    other, o = _spans(spark, seed=1)
    want = {(s, a, b, c, d) for s, a, b in rows for t, c, d in other if s == t and a < d and c < b}
    o = o.select("site", F.col("a").alias("a2"), F.col("b").alias("b2"))
    for width in (1, 7, 1000):
        got = {tuple(x) for x in intervals.overlap_join(df, o, ["site"], width).select("site", "a", "b", "a2", "b2").collect()}
        assert got == want
    assert {tuple(x) for x in intervals.overlap_join(df, o.withColumn("b2", F.col("b2") - 1), ["site"], 7).select("site", "a", "b", "a2", "b2").collect()} != want


def test_difference(spark):
    rows, df = _spans(spark, 20)
    other, o = _spans(spark, 20, seed=1)
    got = [tuple(x) for x in intervals.difference(df, o, ["site"], 16).collect()]
    assert _cells(got) == _cells(rows) - _cells(other)


def test_windows_skip_gaps_and_known_impedance_is_found(spark):
    rng = np.random.default_rng(3)
    n = 4000
    hx, hy = rng.standard_normal((2, n))
    ex = 0.3 * hx + 2.0 * hy + 0.05 * rng.standard_normal(n)
    ey = -1.5 * hx - 0.2 * hy + 0.05 * rng.standard_normal(n)
    rx, ry = hx + 0.1 * rng.standard_normal(n), hy + 0.1 * rng.standard_normal(n)
    rows = [("a", k, *map(float, v)) for k, v in enumerate(zip(ex, ey, hx, hy, rx, ry, strict=True)) if not 1000 <= k < 1010]
    names = ["ex", "ey", "hx", "hy", "rx", "ry"]
    df = spark.createDataFrame(rows, "site string, k long, " + ", ".join(f"{c} double" for c in names))
    wins = spectra.windows(df, ["site"], names, 128, 64)
    starts = {r["w"] * 64 for r in wins.select("w").collect()}
    assert starts and not any(s < 1010 and s + 128 > 1000 for s in starts)
    spec = spectra.spectra(wins, ["site"], names, 4, 60)
    bands = spectra.harmonics(spark, spectra.log_bands(128, 4, 60, 4), 128)
    z = estimate.remote_reference(spectra.band_sums(spec, bands, ["site"], estimate.PAIRS), ["site", "band"]).collect()
    assert len(z) == 4
    for r in z:
        for e, true in zip(estimate.ELEMENTS, (0.3, 2.0, -1.5, -0.2), strict=True):
            assert abs(r[f"z{e}_re"] - true) < 0.1 and abs(r[f"z{e}_im"]) < 0.1


def test_fill_linear(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, None), ("a", 2, 3.0), ("a", 3, None), ("a", 4, None), ("a", 5, None), ("a", 6, 7.0), ("a", 7, None)], "s string, k long, x double")
    out = [r["x"] for r in intervals.fill_linear(df, ["s"], most=2).orderBy("k").collect()]
    assert out == [1.0, 2.0, 3.0, None, None, None, 7.0, 7.0]
