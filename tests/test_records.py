"""Shared centres against matrices in numpy; recorders, times in names and the refreshed index by cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrawave.operators import centre, welch
from terrawave.sources import listing


def _spectra(x, seg):
    taper = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(seg) / seg)
    f = {c: np.array([np.fft.rfft((v[o : o + seg] - v[o : o + seg].mean()) * taper) for o in range(0, len(v) - seg + 1, seg // 2)]) for c, v in x.items()}
    return lambda a, b: np.mean(f[a].conj() * f[b], axis=0)


def test_shared_centre_equals_matrices_and_finds_the_shared_voltage(spark):
    r = np.random.default_rng(1)
    n, seg, days = 256, 32, 7
    sites, rows = {}, []
    for site, shared in (("shared", 1.0), ("minus", -1.0), ("apart", 0.0)):
        hx, hy, v = r.standard_normal((3, n * days))
        w = v if shared else r.standard_normal(n * days)
        x = {"hx": hx, "hy": hy, "ex": 0.3 * hy + v + 0.01 * r.standard_normal(n * days), "ey": -0.2 * hx + (shared or 1) * w + 0.01 * r.standard_normal(n * days)}
        sites[site] = x
        rows += [(site, 40 + i, *(float(x[c][i]) for c in centre.CHANNELS)) for i in range(n * days)]
    rows += [("flat", i, 1.0, 1.0, float(i % 7), float(i % 5)) for i in range(n)]
    df = spark.createDataFrame(rows, "site string, k long, hx double, hy double, ex double, ey double").repartition(3)
    names = [*(f"psd_{c}" for c in centre.CHANNELS), *(f"csd_{a}_{b}_{p}" for a, b in centre.PAIRS for p in ("re", "im"))]
    spec = welch.by_frequency(welch.window_spectra(df, ["site"], centre.CHANNELS, centre.PAIRS, 1.0, n, n, seg), ["site"], names, 1.0, seg)
    stats = centre.residuals(spec, ["site", "w"], 2.0, 20.0)
    bands = centre.octave_medians(stats, ["site", "w"], 2.0, 20.0)
    got = {(v["site"], v["w"]): v for v in centre.day_values(bands, ["site", "w"]).collect()}
    assert {w for s, w in got if s == "shared"} == set(range(days)) and not [s for s, _ in got if s == "flat"]
    for site, x in sites.items():
        for w in range(days):
            S = _spectra({c: v[w * n : (w + 1) * n] for c, v in x.items()}, seg)
            octave = {}
            for h in range(1, seg // 2 + 1):
                if not 2 <= seg / h <= 20:
                    continue
                H = np.array([[S(a, b)[h] for b in ("hx", "hy")] for a in ("hx", "hy")])
                q = {(a, b): np.array([S(a, i)[h] for i in ("hx", "hy")]) @ np.linalg.inv(H) @ np.array([S(i, b)[h] for i in ("hx", "hy")]) for a in ("ex", "ey") for b in ("ex", "ey")}
                res = {k: S(*k)[h] - v for k, v in q.items()}
                g = np.conj(res["ex", "ey"]) / res["ex", "ex"].real
                tot = lambda m, s: (m["ex", "ex"] + m["ey", "ey"] + s * (m["ex", "ey"] + m["ey", "ex"])).real
                e = {k: S(*k)[h] for k in q}
                one = [abs(e["ex", "ey"]) ** 2 / (e["ex", "ex"] * e["ey", "ey"]).real, abs(res["ex", "ey"]) ** 2 / (res["ex", "ex"] * res["ey", "ey"]).real, abs(g), g.real, g.imag, tot(q, -1) / tot(e, -1), tot(q, 1) / tot(e, 1)]
                octave.setdefault(sum(seg / h >= edge for edge in (4, 8, 16)), []).append(one)
            want = np.median([np.median(v, axis=0) for v in octave.values()], axis=0)
            assert np.allclose([got[site, w][v] for v in centre.VALUES], want, atol=1e-9)
    verdicts = {v["site"]: v for v in centre.site_verdict(centre.day_values(bands, ["site", "w"]), ["site"], "w", 3).collect()}
    assert {s: (v["verdict"], v["remedy"]) for s, v in verdicts.items()} == {"shared": ("holds", True), "minus": ("holds", True), "apart": ("control", False)}
    assert verdicts["shared"]["s_obs"] == 1 and verdicts["shared"]["clean_obs"] == "diff" and verdicts["minus"]["clean_obs"] == "sum"
    assert verdicts["shared"]["days_usable"] == days and verdicts["shared"]["days_used"] == 3 and verdicts["shared"]["days_model"] == days


def test_octaves():
    assert centre.octaves(10, 100) == [10, 20, 40, 80, 100]
    assert centre.octaves(10, 80) == [10, 20, 40, 80] and centre.octaves(10, 15) == [10, 15]


NAMES = {
    "1400000000.B423": ("lemi423", 1400000000), "14000x.B423": (None, None), "._140.B423": (None, None),
    "200101000102.txt": ("lemi424", 1577836862), "20010100010.txt": (None, None), "200141000000.TXT": ("lemi424", None), "200101250000.txt": ("lemi424", None),
    "NB12_200101000102.bx": ("edl", 1577836862), "NB12.bx": (None, None),
    "10128_5CF3B6A8_2_0000001F.td_150": ("phoenix", 0x5CF3B6A8 + 315964800 - 18), "10128_5CF3B6A8_2.td_150": (None, None), "10128_5CF3B6A8_2_0000001F.td_96k": (None, None),
    "hfm3-012.bin.old": ("orangebox", None), "LP1-RPT.TXT": (None, None), "x.TS4": ("mtu5a", None), "": (None, None),
}


def test_kinds_and_times_of_names(spark):
    df = spark.createDataFrame([*((n,) for n in NAMES), (None,)], "name string")
    got = {v["name"]: (v["kind"], v["t"]) for v in df.select("name", listing.kind(F.col("name")).alias("kind"), listing.named_time(F.col("name")).alias("t")).collect()}
    assert got == {**NAMES, None: (None, None)}


def test_recorder_of_a_folder(spark):
    files = {"a": ["x.TS4", "200101000102.txt", "._1.B423"], "b": ["x.TS4", "recorder.ini", "notes.md"], "c": ["notes.md"], "d": ["HFM1-001.BIN", "x.TS4", None]}
    df = spark.createDataFrame([(s, n) for s, ns in files.items() for n in ns], "site string, name string")
    assert {tuple(v) for v in listing.recorder(df, ["site"]).collect()} == {("a", "lemi424"), ("b", "edl"), ("d", "orangebox")}
    assert {tuple(v) for v in listing.recorder(df, ["site"], "mtu5a").collect()} == {("a", "mtu5a"), ("b", "mtu5a"), ("d", "mtu5a")}
    with pytest.raises(ValueError):
        listing.recorder(df, ["site"], "other")


def test_only_changed_files_are_read(spark):
    old = spark.createDataFrame([("same", 1, 10, "kept", True), ("moved", 1, 10, "old", True), ("gone", 1, 10, "old", True), ("bad", 1, 10, None, False)], "name string, mtime long, size long, fact string, read boolean")
    now = spark.createDataFrame([("same", 1, 10), ("moved", 2, 10), ("bad", 1, 10), ("new", 5, 5)], "name string, mtime long, size long")
    asked = []

    def read(files):
        asked.extend(sorted(v["name"] for v in files.collect()))
        return files.where("name <> 'bad'").select("name", F.lit("fresh").alias("fact"))

    got = {v["name"]: (v["mtime"], v["fact"], v["read"]) for v in listing.refreshed(now, old, read).collect()}
    assert asked == ["bad", "moved", "new"]
    assert got == {"same": (1, "kept", True), "moved": (2, "fresh", True), "new": (5, "fresh", True), "bad": (1, None, False)}
