"""Operators in blocks, ranks, neighbours, filters and robust estimates against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrawave.functions import names
from terrawave.operators import filters, graph, masking, order, robust, runs, space, spectra
from terrawave.operators import intervals as iv


@pytest.fixture(scope="module")
def spans(spark):
    r = random.Random(3)
    rows = [("s", a, a + r.randint(1, 40)) for a in (r.randint(0, 2000) for _ in range(120))] + [("t", 5, 9), ("t", 9, 12), ("u", 7, 7)]
    return rows, spark.createDataFrame(rows, "site string, a long, b long")


@pytest.mark.parametrize("block", [7, 64, 1 << 16])
def test_blocks_give_the_whole_result(spark, spans, block):
    rows, df = spans
    covered = {s: {k for t, a, b in rows if t == s for k in range(a, b)} for s in "stu"}

    def stretches(ks):
        ks, out = sorted(ks), []
        for k in ks:
            if out and out[-1][1] == k:
                out[-1][1] = k + 1
            else:
                out.append([k, k + 1])
        return [tuple(x) for x in out]

    want = sorted((s, a, b) for s, ks in covered.items() for a, b in stretches(ks))
    points = spark.createDataFrame([(s, k) for s, ks in covered.items() for k in ks], "site string, k long")
    assert sorted(map(tuple, iv.islands(points, ["site"], block=block).select("site", "a", "b").collect())) == want
    assert sorted(map(tuple, iv.union(df, ["site"], block=block).select("site", "a", "b").collect())) == want
    got = {(r["site"], k): r["n"] for r in iv.counts(df, ["site"], block=block).collect() for k in range(r["a"], r["b"])}
    assert got == {(s, k): sum(t == s and a <= k < b for t, a, b in rows) for s, ks in covered.items() for k in ks}


@pytest.mark.parametrize("block", [5, 1 << 16])
def test_fills_and_as_of_in_blocks(spark, block):
    r = random.Random(4)
    x = [float(r.randint(0, 9)) if r.random() < 0.3 else None for _ in range(60)]
    rows = spark.createDataFrame([("s", k, v) for k, v in enumerate(x)], "site string, k long, x double")
    got = [v["x"] for v in iv.fill_linear(rows, ["site"], block=block).orderBy("k").collect()]
    known = [k for k, v in enumerate(x) if v is not None]
    assert np.allclose(got, np.interp(range(60), known, [x[k] for k in known]))
    facts = spark.createDataFrame([("s", k, f"f{k}") for k in (11, 12, 40)], "site string, since long, f string")
    for earliest in (False, True):
        out = {v["k"]: v["f"] for v in iv.as_of(rows, facts, ["site"], "k", "since", "f", earliest=earliest, block=block).collect()}
        assert out == {k: "f40" if k >= 40 else "f12" if k >= 12 else "f11" if k >= 11 or earliest else None for k in range(60)}


def test_ranks_over_ranges(spark):
    rows = spark.createDataFrame([(i, (i * 37) % 101) for i in range(400)], "i long, v long")
    out = order.ranked(rows, [F.desc("v"), F.asc("i")], parts=7).collect()
    want = {i: n + 1 for n, (v, i) in enumerate(sorted((-((i * 37) % 101), i) for i in range(400)))}
    assert {r["i"]: r["place"] for r in out} == want


def test_nearest_over_every_border(spark):
    r = random.Random(5)
    at = [(i, math.degrees(math.asin(r.uniform(-1, 1))), r.uniform(-180, 180)) for i in range(150)] + [(200, 89.9, 0.0), (201, -10.0, 179.99), (202, -10.0, -179.99), (203, -10.0, -179.99)]
    out = space.nearest(spark.createDataFrame(at, "id long, lat double, lon double"), 3).collect()

    def km(p, q):
        a, b, c, d = map(math.radians, (*p, *q))
        return 2 * 6371.0088 * math.asin(math.sqrt(math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2))

    for i, *p in at:
        want = [j for _, j in sorted((round(km(p, q), 6), j) for j, *q in at if j != i)[:3]]
        assert [x["other"] for x in sorted((x for x in out if x["id"] == i), key=lambda x: x["place"])] == want
    assert space.nearest(spark.createDataFrame([(1, 0.0, 0.0)], "id long, lat double, lon double"), 3).count() == 0


def test_decimation_blocks_and_gain(spark):
    n, q = 4000, 4
    k = np.arange(n)
    x = np.sin(2 * np.pi * k / 100) + np.sin(2 * np.pi * k / 3)  # the second lies beyond the output's Nyquist frequency
    rows = spark.createDataFrame([("s", int(i), float(v)) for i, v in zip(k, x) if i != 400], "site string, k long, x double")
    near, whole = (sorted((r["k"], r["x"]) for r in filters.decimated(rows, ["site"], q, block=b).collect()) for b in (50, 5000))
    assert [a for a, _ in near] == [i for i in range(n // q) if i != 100] == [a for a, _ in whole]
    assert np.allclose([v for _, v in near], [v for _, v in whole])
    taps = filters.low_pass(q)
    assert abs(taps.sum() - 1) < 1e-12 and len(taps) == 20 * q + 1
    inside = [(a, v) for a, v in near if 20 < a < 80 or 120 < a < 980]
    assert max(abs(v - math.sin(2 * math.pi * a * q / 100)) for a, v in inside) < 0.02


def test_huber_equals_numpy(spark):
    r = np.random.default_rng(2)
    n = 300

    def noise(m):
        return r.standard_normal(m) + 1j * r.standard_normal(m)

    x = np.stack([noise(n), noise(n)], 1)
    ref, b = x + 0.1 * np.stack([noise(n), noise(n)], 1), np.array([2 - 1j, 0.5 + 3j])
    y = x @ b + 0.1 * noise(n)
    y[:30] += 50 * noise(30)
    columns = {"y": y, "x1": x[:, 0], "x2": x[:, 1], "r1": ref[:, 0], "r2": ref[:, 1]}
    rows = spark.createDataFrame([("a", *(float(p) for c in columns.values() for p in (c[i].real, c[i].imag))) for i in range(n)], "site string, " + ", ".join(f"{c}_re double, {c}_im double" for c in columns))
    w = np.ones(n)
    for _ in range(7):
        weighted = ref.conj() * w[:, None]
        found = np.linalg.solve(weighted.T @ x, weighted.T @ y)
        left = np.abs(y - x @ found)
        w = np.minimum(1, 1.5 * (1.4826 * np.median(left) + 1e-30) / np.maximum(left, 1e-30))
    got = robust.huber(rows, ["site"], "y", ("x1", "x2"), ("r1", "r2"), rounds=6).collect()[0]
    assert np.allclose([complex(got["b1_re"], got["b1_im"]), complex(got["b2_re"], got["b2_im"])], found, atol=1e-8)
    assert np.abs(found - b).max() < 0.1


def test_file_runs_rules(spark):
    starts = [0, 10, 20, 25, 35, 45, 55, 65]
    rows = spark.createDataFrame([("s", a, a == 45) for a in starts], "site string, a long, last boolean")
    out = {r["a"]: r["run"] for r in runs.grouped(rows, ["site"], most=3, ends=F.col("last")).collect()}
    assert [out[a] for a in starts] == [1, 1, 1, 2, 2, 2, 3, 3]


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 90), (90, 95), (7, 7)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {100: 90, 90: 90, 95: 90}


def test_masks_that_are_not_fit(spark):
    rows = [("s", 1, 5, None, None, None, None), ("s", 5, 5, None, None, "LOCAL", ["Ex", "ex ", None, ""]), ("s", 1, None, None, None, "both", []), (None, 1, 2, None, None, "both", None), ("s", 1, 2, 3.0, None, "both", None), ("s", 1, 2, 3.0, 2.0, "both", None), ("s", 1, 2, 1.0, 2.0, "x", None)]
    out = masking.normalised(spark.createDataFrame(rows, "site string, a long, b long, pmin double, pmax double, scope string, channels array<string>")).collect()
    assert [r["refused"] for r in out] == [None, "ends before it starts", "no time", "no site", "half a band", "band upside down", "unknown scope"]
    assert out[0]["scope"] == "both" and out[1]["channels"] == ["ex"] and out[2]["channels"] is None


def test_tapers_hops_and_whitening(spark):
    for name in ("hann", "hamming", "boxcar", "dpss"):
        t = spectra.taper(name, 64)
        assert len(t) == 64 and abs(t.max() - 1) < 0.01 and t.min() >= -1e-12
    assert np.allclose(spectra.taper("dpss", 64), spectra.taper("dpss", 64)[::-1])
    assert (spectra.hop_of(128, 1.0), spectra.hop_of(1024, 1.0), spectra.hop_of(128, 1.0, half=True)) == (96, 256, 64)
    n = 64
    rows = spark.createDataFrame([("s", k, float(np.cos(2 * np.pi * 5 * k / n))) for k in range(n + 1)], "site string, k long, x double")
    plain, white = ({r["h"]: complex(r["x_re"], r["x_im"]) for r in spectra.spectra(spectra.windows(rows, ["site"], ["x"], n + w, n), ["site"], ["x"], 4, 6, taper=np.ones(n), whiten=w).collect()} for w in (False, True))
    assert abs(plain[5] - n / 2) < 1e-9 and abs(white[5] - plain[5]) < 1e-9  # exact for what repeats in the window


def test_names_and_clocks(spark):
    row = spark.range(1).select(names.gps_to_utc(F.lit(1_200_000_000).cast("long")).alias("utc"), names.gps_to_utc(F.lit(0).cast("long")).alias("zero"), names.note_values(F.lit("Gain: 2; dc level : 3:4;; gain: 5; junk")).alias("note"), *(c.alias(n) for n, c in zip("abcd", names.product_stem(F.lit("C18_rr-C19_20200102T0304_m1")), strict=True)), names.product_stem(F.lit("other"))[0].alias("none")).first()
    assert row["utc"] == 1_200_000_000 + 315964800 - 18 and row["zero"] == 315964800
    assert row["note"] == {"gain": "5", "dc level": "3:4"}
    assert (row["a"], row["b"], row["c"], row["d"], row["none"]) == ("C18", "C19", "20200102T0304", "m1", None)
