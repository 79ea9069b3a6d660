"""Recursive filters, moving medians and totals in blocks against whole series in plain loops."""

import math
from datetime import datetime
from fractions import Fraction
from zoneinfo import ZoneInfo

import numpy as np
import pytest

from pyspark.sql import functions as F

from terrawave.functions import names
from terrawave.operators import blocks, bursts, masking, recursive


def _frame(spark, series):
    rows = [(s, int(k), float(v)) for s, (k0, x) in series.items() for k, v in enumerate(x, k0)]
    return spark.createDataFrame(rows, "site string, k long, x double").repartition(5)


def _got(df, name="x"):
    out = {}
    for r in df.orderBy("k").collect():
        out.setdefault(r["site"], []).append((r["k"], r[name]))
    return out


def _loop(x, sections, pad):
    """Forward and back, section by section and sample by sample."""
    x = np.concatenate((2 * x[0] - x[pad:0:-1], x, 2 * x[-1] - x[-2 : -pad - 2 : -1]))
    for _ in range(2):
        for b0, b1, b2, a1, a2 in sections:
            # At rest under the first sample for ever before.
            gain = (b0 + b1 + b2) / (1 + a1 + a2)
            s2 = (b2 - a2 * gain) * x[0]
            s1 = (b1 - a1 * gain) * x[0] + s2
            y = np.empty(len(x))
            for i, v in enumerate(x):
                y[i] = b0 * v + s1
                s1, s2 = b1 * v - a1 * y[i] + s2, b2 * v - a2 * y[i]
            x = y
        x = x[::-1]
    return x[pad : len(x) - pad]


@pytest.mark.parametrize("block", [50, 333, 1 << 16])
@pytest.mark.parametrize(("kind", "cutoff"), [("low", 0.08), ("high", 0.01), ("band", (0.02, 0.2))])
def test_butterworth_in_blocks(spark, block, kind, cutoff):
    r = np.random.default_rng(1)
    series = {"a": (-70, np.cumsum(r.standard_normal(1500)) + 40), "b": (1000, r.standard_normal(400))}
    sections = recursive.butterworth(4, cutoff, 1.0, kind)
    got = _got(recursive.filtered(_frame(spark, series), ["site"], "x", 1.0, cutoff, kind, block=block))
    for s, (k0, x) in series.items():
        assert [k for k, _ in got[s]] == list(range(k0, k0 + len(x)))
        want = _loop(x, sections, recursive.padding(sections))
        assert np.abs(np.array([v for _, v in got[s]]) - want).max() < 1e-9 * max(1, np.abs(x).max())


def test_butterworth_responses():
    f = np.array([0.001, 0.1, 0.4])
    z = np.exp(-2j * np.pi * f)

    def gain(sections):
        return np.abs(np.prod([(b0 + b1 * z + b2 * z * z) / (1 + a1 * z + a2 * z * z) for b0, b1, b2, a1, a2 in sections], axis=0))

    assert np.allclose(gain(recursive.butterworth(4, 0.1, 1.0, "low"))[:2], [1, 0.5**0.5], atol=1e-6)
    assert np.allclose(gain(recursive.butterworth(4, 0.1, 1.0, "high"))[1:], [0.5**0.5, 1], atol=1e-2)
    assert abs(gain(recursive.butterworth(2, (0.1, 0.3), 1.0, "band"))[1] - 0.5**0.5) < 1e-6
    assert gain(recursive.notch_comb(0.1, 1.0, 9, 30))[1] < 1e-12
    assert len(recursive.notch_comb(0.1, 1.0, 9, 30, 2, (0.05, 0.7))) == 2 * (4 + 1)  # the harmonic at the Nyquist frequency and beyond are none
    for bad in ((4, 0.6, 1.0, "low"), (4, 0.1, 1.0, "band"), (3, 0.1, 1.0, "low"), (4, 0.1, 1.0, "x")):
        with pytest.raises(ValueError):
            recursive.butterworth(*bad)


def test_notches_take_lines_out(spark):
    k = np.arange(6000)
    x = np.sin(2 * np.pi * 0.002 * k) + 3 * np.sin(2 * np.pi * 0.1 * k) + np.sin(2 * np.pi * 0.2 * k + 1)
    got = _got(recursive.notched(_frame(spark, {"a": (0, x)}), ["site"], "x", 1.0, f0=0.1, q=10.0, passes=1, block=700))["a"]
    left = np.array([v for _, v in got])[1000:-1000] - np.sin(2 * np.pi * 0.002 * k)[1000:-1000]
    assert np.abs(left).max() < 1e-2


@pytest.mark.parametrize("block", [17, 1 << 16])
@pytest.mark.parametrize(("before", "after"), [(10, 10), (5, 4), (200, 150)])
def test_moving_medians(spark, block, before, after):
    r = np.random.default_rng(2)
    x = np.round(r.standard_normal(700), 1)
    df = _frame(spark, {"a": (-30, x)}).where("k % 11 <> 3")
    got = _got(blocks.moving_median(df, ["site"], "x", before, after, block=block), "median")["a"]
    known = {k: v for k, v in zip(range(-30, 670), x, strict=True) if np.fmod(k, 11) != 3}
    assert [k for k, _ in got] == sorted(known)
    assert np.allclose([v for _, v in got], [np.median([known[j] for j in range(k - before, k + after + 1) if j in known]) for k in sorted(known)])


def test_running_totals(spark):
    x = np.random.default_rng(3).standard_normal(500)
    got = _got(blocks.running_total(_frame(spark, {"a": (-100, x)}), ["site"], "x", "t", block=64), "t")["a"]
    assert np.allclose([v for _, v in got], np.cumsum(x))


def _plain_level(x, size):
    centres, medians = [], []
    for a in range(0, len(x), size):
        part = x[a : a + size]
        centres.append(a + (len(part) - 1) / 2)
        medians.append(np.median(part))
    return np.interp(np.arange(len(x)), centres, medians)


def _plain_ratio(x, width, size, half):
    d = np.abs(x - _plain_level(x, size))
    wide = np.concatenate((np.repeat(d[0], width), d, np.repeat(d[-1], width)))
    mean = np.array([wide[width + i - width // 2 : width + i - width // 2 + width].mean() for i in range(len(x))])
    spread = np.array([np.median(d[a : a + size]) for a in range(0, len(x), size)])
    out = np.zeros(len(x))
    for i in range(len(x)):
        near = spread[max(0, i // size - half) : i // size + half + 1]
        near = near[near > 0]
        out[i] = mean[i] / np.median(near) if len(near) else 0
    return out


@pytest.mark.parametrize("block", [40, 1 << 16])
def test_burst_ratios_and_fills_equal_loops(spark, block):
    r = np.random.default_rng(4)
    x = r.standard_normal(900) + np.linspace(0, 5, 900)
    x[200:230] += 40
    x[400] += 500  # a single spike is no burst
    x[600:720] = 7.0  # a zeroed gap
    x[880:] += 60
    width, size, half, k0 = 5, 16, 4, 1000
    df = _frame(spark, {"a": (k0, x)})
    got = _got(bursts.burst_ratio(df, ["site"], "x", width, size, half, block=block), "ratio")["a"]
    ratio = _plain_ratio(x, width, size, half)
    assert np.allclose([v for _, v in got], ratio)
    hot = bursts.any_louder([bursts.burst_ratio(df, ["site"], "x", width, size, half)], ["site"], 8.0)
    spans = sorted((s["a"] - k0, s["b"] - k0) for s in masking.bursts(hot, ["site"], F.col("loud"), width, 3).collect())
    want, i = [], 0
    while i < 900:
        j = i
        while j < 900 and ratio[j] > 8:
            j += 1
        if j - i - (width - 1) >= width:
            want.append((max(0, i - 3), min(900, j + 3)))
        i = max(i + 1, j)
    assert spans == want and len(want) == 3
    level = _plain_level(x, size)
    for taper in (6, 100):
        y = x.copy()
        for a, b in want:
            k = min(taper, (b - a) // 2)
            for i in range(a, b):
                edge = min(i - a, b - 1 - i)
                keep = (1 + np.cos(np.pi * edge / k)) / 2 if edge < k else 0
                y[i] = level[i] + keep * (x[i] - level[i])
        rows = bursts.with_level(df, ["site"], "x", size)
        s = spark.createDataFrame([("a", a + k0, b + k0) for a, b in want], "site string, a2 long, b2 long")
        filled = _got(masking.spans_filled(rows, s, ["site"], "x", "level", taper, 64))["a"]
        assert np.allclose([v for _, v in filled], y)
        assert filled[want[0][0]][1] == x[want[0][0]]


def test_indices_are_exact(spark):
    rates = [1, 150, 1000, 24_000]
    times = [0, 1, -1, 999_999_999, 1_000_000_000, 41_666, 41_667, 1_700_000_000_123_456_789, 10 * 86_400_000_000_000 + 1, -5_000_000_001]
    rows = spark.createDataFrame([(t, r) for t in times for r in rates], "t long, r long")
    out = rows.select("t", "r", names.ceil_index(F.col("t"), F.col("r")).alias("i"), names.time_of(names.ceil_index(F.col("t"), F.col("r")), F.col("r")).alias("back")).collect()
    for v in out:
        want = math.ceil(Fraction(v["t"]) * v["r"] / 10**9)
        assert v["i"] == want
        assert v["back"] == math.floor(Fraction(want) * 10**9 / v["r"] + Fraction(1, 2))


def test_clocks_of_zones_in_any_session(spark):
    at = [1_700_000_000, 1_711_846_799, 1_711_846_800, 0, -1, 1_729_990_800]
    rows = spark.createDataFrame([(t,) for t in at], "t long")
    zone = ZoneInfo("Europe/Berlin")
    want = {t: datetime.fromtimestamp(t, zone) for t in at}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session)
            out = rows.select("t", names.local_seconds(F.col("t"), "Europe/Berlin").alias("s"), names.seconds_at(names.local_seconds(F.col("t"), "Europe/Berlin"), "Europe/Berlin").alias("back"), names.local_hour(F.timestamp_seconds("t"), "Europe/Berlin").alias("hour"), names.gps_to_utc(F.col("t")).alias("gps")).collect()
            for v in out:
                w = want[v["t"]]
                assert v["s"] == v["t"] + int(w.utcoffset().total_seconds()) and v["hour"] == w.hour
                assert v["back"] == v["t"] or v["back"] == v["t"] - 3600  # a time shown twice is the earlier
            got = {v["t"]: v["gps"] for v in out}
            assert got[1_700_000_000] == 1_700_000_000 + 315964800 - 18
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_station_names(spark):
    rows = spark.createDataFrame([("VIC041",), ("Vic41_",), ("VIC074a",), ("VIC74A-",), ("VIC1003",), ("VIC100",), ("VIC0",), (None,)], "n string")
    assert [r["k"] for r in rows.select(names.station_key(F.col("n")).alias("k")).collect()] == ["vic41", "vic41", "vic74a", "vic74a", "vic1003", "vic100", "vic0", None]
