"""Welch spectra, ladders and stitching against loops in numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrawave.operators import filters, welch


def _frame(spark, series, names):
    rows = [(s, k0 + i, *(float(c[i]) for c in x)) for s, (k0, x, gone) in series.items() for i in range(len(x[0])) if i not in gone]
    return spark.createDataFrame(rows, "site string, k long, " + ", ".join(f"{n} double" for n in names)).repartition(5)


def _segment(x, rate):
    n = len(x)
    taper = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)
    return np.fft.rfft((x - x.mean()) * taper), np.concatenate(([1], np.full(n // 2 - 1, 2), [1])) / rate / (taper**2).sum()


@pytest.mark.parametrize("samples", [1 << 18, 200])
def test_windows_equal_loops(spark, monkeypatch, samples):
    monkeypatch.setattr(welch, "SAMPLES", samples)
    r = np.random.default_rng(7)
    gone = set(range(300, 340)) | {700} | set(range(801, 960))
    series = {"a": (-37, r.standard_normal((2, 1100)), gone), "b": (500, r.standard_normal((2, 130)), set())}
    win, step, seg, rate = 128, 50, 32, 4.0
    got = {(v["site"], v["w"]): v for v in welch.window_spectra(_frame(spark, series, "xy"), ["site"], ["x", "y"], [("x", "y")], rate, win, step, seg).collect()}
    seen = 0
    for s, (_, x, lost) in series.items():
        for w in range((x.shape[1] - win) // step + 1):
            v = got.pop((s, w))
            starts = [w * step + o for o in range(0, win - seg + 1, seg // 2)]
            good = [o for o in starts if not any(o <= g < o + seg for g in lost)]
            if len(good) < max(4, (len(starts) + 1) // 2):
                assert v["segments"] == 0 and v["psd_x"] is None
                seen += 1
                continue
            f = [[_segment(c[o : o + seg], rate) for o in good] for c in x]
            assert v["segments"] == len(good) and abs(v["t"] - (w * step + win / 2) / rate) < 1e-9
            assert np.allclose(v["psd_x"], f[0][0][1] * np.mean([abs(z) ** 2 for z, _ in f[0]], axis=0))
            z = f[0][0][1] * np.mean([a.conj() * b for (a, _), (b, _) in zip(*f, strict=True)], axis=0)
            assert np.allclose(v["csd_x_y_re"], z.real) and np.allclose(v["csd_x_y_im"], z.imag)
    assert not got and seen


def test_thinned_segments_and_plans():
    assert welch.segment_starts(10_000, 64, 20).tolist() == (np.round(np.linspace(0, 310, 20)).astype(int) * 32).tolist()
    plan = welch.levels_plan(100.0, 86_400, longest=1000)
    assert [p["level"] for p in plan] == [0, 1, 2, 3, 4] and plan[0]["from_s"] == 0.01 and plan[0]["to_s"] == plan[1]["from_s"] == 10.24
    assert plan[-1]["window_s"] >= 4.5 * plan[-1]["segment_s"] and all(p["segments"] >= 8 for p in plan)
    assert len(welch.levels_plan(100.0, 4000, longest=1000)) < 5
    with pytest.raises(ValueError):
        welch.levels_plan(100.0, 100)


@pytest.mark.parametrize("samples", [1 << 18, 300])
def test_ladder_of_records(spark, monkeypatch, samples):
    monkeypatch.setattr(welch, "SAMPLES", samples)
    r = np.random.default_rng(8)
    x = np.cumsum(r.standard_normal(3000)) * 0.1
    rows = _frame(spark, {"a": (40, [x], {51, 52, 53}), "short": (0, [x[:100]], set())}, "x")
    got = welch.psd_ladder(rows, ["site"], ["x"], 10.0, segment=64, factor=5, stages=3).collect()
    now, rate = x.copy(), 10.0
    now[51:54] = 0
    taps, half = filters.low_pass(5), 50
    for stage in range(3):
        mine = {v["h"]: v for v in got if v["stage"] == stage}
        if len(now) < 256:
            assert not mine
            break
        parts = [_segment(now[o : o + 64], rate) for o in range(0, len(now) - 63, 32)]
        want = parts[0][1] * np.mean([abs(z) ** 2 for z, _ in parts], axis=0)
        assert len(mine) == 33 and all(v["site"] == "a" and v["segments"] == len(parts) for v in mine.values())
        assert np.allclose([mine[h]["psd_x"] for h in range(33)], want, rtol=1e-6)
        padded = np.concatenate((np.zeros(half), now, np.zeros(half)))
        now, rate = np.array([padded[i : i + 2 * half + 1] @ taps for i in range(0, len(now), 5)]), rate / 5
    assert stage == 2


def test_stitching(spark):
    rows = spark.createDataFrame([("a", w, 5.0, float(w)) for w in range(6)], "site string, w long, period double, v double")
    coarse = spark.createDataFrame([("a", w, 50.0, 100.0 + w) for w in range(2)], "site string, w long, period double, v double")
    base = spark.createDataFrame([("a", float(t)) for t in (-5, 0, 10, 10.1, 20, 34, 500)], "site string, t double")
    levels = [(rows, 1.0, 20, 10), (coarse, 0.5, 40, 20)]
    got = {(v["t"], v["period"]): v["v"] for v in welch.stitched(levels, ["site"], "v", base).collect()}
    times = [10 + 10 * w for w in range(6)]
    for t in (-5, 0, 10, 10.1, 20, 34, 500):
        assert got[t, 5.0] == min(int(np.searchsorted(times, t)), 5)
        assert got[t, 50.0] == 100 + min(int(np.searchsorted([40, 80], t)), 1)
    line = {v["t"]: v["v"] for v in welch.band_line(levels, ["site"], "v", base, 1, 60).collect()}
    assert line[20.0] == (1 + 100) / 2
    near = welch.band_line(levels, ["site"], "v", base, 1, 10).where("t = 500").first()
    assert near["v"] == 5
    bins = spark.createDataFrame([(f,) for f in (0.005, 0.05, 0.5, 0.101)], "f double").select("f", welch.log_bin(F.col("f"), 2.0, 200.0, 3).alias("b")).collect()
    assert [v["b"] for v in bins] == [None, 3, 0, 2]
