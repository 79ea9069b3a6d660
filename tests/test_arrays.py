"""Stacks, resampling, line groups, clusters, calibration and alignment against loops in numpy."""

import math

import numpy as np
import pytest

from terrawave.operators import grouping, resample, stacks


@pytest.mark.parametrize("method", ["mean", "median"])
def test_band_stack_equals_loops(spark, method):
    r = np.random.default_rng(10)
    x = (r.standard_normal((4, 12, 3)) + 1j * r.standard_normal((4, 12, 3))) * np.array([1, 5, 0.2, 1])[:, None, None]
    x[1, 7] *= 40
    x[2, :6] = np.nan
    x[3, :] = np.nan
    x[3, 0] = 0
    rows = [("b", m, w, h, float(x[m, w, h].real), float(x[m, w, h].imag)) for m in range(4) for w in range(12) for h in range(3) if np.isfinite(x[m, w, h])]
    df = spark.createDataFrame(rows, "band string, member int, w int, h int, re double, im double")
    got = {(v["w"], v["h"]): v for v in stacks.band_stack(df, ["band"], method=method).collect()}
    power = np.mean(np.abs(x) ** 2, axis=2)
    scale = np.array([np.sqrt(np.nanmedian(p)) for p in power])
    scale[3] = np.nan
    norm = power / scale[:, None] ** 2
    for w in range(12):
        kept = np.flatnonzero(norm[:, w] <= 25 * np.nanmedian(norm[:, w]))
        for h in range(3):
            if len(kept) < 2:
                assert (w, h) not in got
                continue
            z = x[kept, w, h] / scale[kept]
            want = z.mean() if method == "mean" else complex(np.median(z.real), np.median(z.imag))
            assert got[w, h]["members"] == len(kept) and np.isclose(complex(got[w, h]["re"], got[w, h]["im"]), want)
    assert got[7, 0]["members"] == 2  # one absent, one rejected


def test_member_coherence_and_weights(spark):
    r = np.random.default_rng(11)
    n, chunk, seg = 700, 160, 32
    common = np.cumsum(r.standard_normal(n))
    x = {"a": common + 0.5 * r.standard_normal(n), "b": 2 * common + r.standard_normal(n) + 5, "c": 0.5 * r.standard_normal(n)}
    df = spark.createDataFrame([("s", m, 50 + i, float(v)) for m, s in x.items() for i, v in enumerate(s)], "site string, member string, k long, x double").repartition(3)
    c = stacks.member_coherence(df, ["site"], 1.0, chunk, seg, 2.0, 32.0)
    got = {(v["member"], v["chunk"]): v["coherence"] for v in c.collect()}
    level = {m: s - np.sort(s)[(n - 1) // 2] for m, s in x.items()}
    taper = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(seg) / seg)
    bins = round(math.log10(16) * 6)
    for m, s in level.items():
        others = sum(v for k, v in level.items() if k != m) / 2
        for w in range(n // chunk):
            f = [[np.fft.rfft((q[o : o + seg] - q[o : o + seg].mean()) * taper) for o in range(w * chunk, w * chunk + chunk - seg + 1, seg // 2)] for q in (s, others)]
            z = np.mean([a.conj() * b for a, b in zip(*f, strict=True)], axis=0)
            g = np.abs(z) ** 2 / np.mean(np.abs(f[0]) ** 2, axis=0) / np.mean(np.abs(f[1]) ** 2, axis=0)
            cells = {}
            for h in range(2, 17):  # period of 32 is the edge, and out
                cells.setdefault(math.floor(math.log(seg / h / 2) / math.log(16) * bins), []).append(g[h])
            assert np.isclose(got[m, w], np.mean([np.mean(v) for v in cells.values()]), atol=1e-9)
    assert len(got) == 3 * (n // chunk) and min(got["a", w] for w in range(4)) > max(got["c", w] for w in range(4))
    weighed = stacks.weights(c, ["site", "chunk"], floor=0.2)
    ws = {(v["member"], v["chunk"]): v["weight"] for v in weighed.collect()}
    for w in range(4):
        g = np.array([got[m, w] for m in "abc"])
        p = g / g.sum()
        p[p < 0.2] = 0
        assert np.allclose([ws[m, w] for m in "abc"], p / p.sum())
    out = {v["k"]: v["x"] for v in stacks.weighted_stack(df, ["site"], weighed, chunk).collect()}
    assert np.allclose([out[50 + i] for i in range(n)], [sum(ws[m, min(i // chunk, 3)] * level[m][i] for m in "abc") for i in range(n)])
    odd = spark.createDataFrame([("s", 0, "a", None), ("s", 0, "b", float("nan")), ("s", 1, "a", 0.5), ("s", 1, "b", 0.5)], "site string, chunk long, member string, coherence double")
    assert sorted((v["chunk"], v["weight"]) for v in stacks.weights(odd, ["site", "chunk"], floor=0.6).collect()) == [(0, 0.5), (0, 0.5), (1, 0.5), (1, 0.5)]
    plain = {v["k"]: v["x"] for v in stacks.plain_stack(df, ["site"]).collect()}
    want = np.mean([s / np.sqrt(np.mean(s**2)) for s in level.values()], axis=0)
    assert np.allclose([plain[50 + i] for i in range(n)], want)


def _dense_spline(x, u):
    """Not-a-knot spline by a dense solve."""
    n = len(x)
    a, r = np.zeros((n, n)), np.zeros(n)
    for i in range(1, n - 1):
        a[i, i - 1 : i + 2], r[i] = (1, 4, 1), 6 * (x[i - 1] - 2 * x[i] + x[i + 1])
    a[0, :3], a[-1, -3:] = (1, -2, 1), (1, -2, 1)
    m = np.linalg.solve(a, r)
    i = np.minimum(u.astype(int), n - 2)
    t = u - i
    return (1 - t) * x[i] + t * x[i + 1] + (((1 - t) ** 3 - (1 - t)) * m[i] + (t**3 - t) * m[i + 1]) / 6


@pytest.mark.parametrize("block", [64, 65_536])
def test_resampling_in_blocks(spark, block):
    r = np.random.default_rng(12)
    series = {"a": (1_700_000_000_050_000_000, 10.00064, np.cumsum(r.standard_normal(900))), "b": (77_000_000_001, 9.99, r.standard_normal(5)), "c": (0, 10.0, r.standard_normal(4)), "d": (0, 10.0, r.standard_normal(3))}
    df = spark.createDataFrame([(s, i, float(v)) for s, (_, _, x) in series.items() for i, v in enumerate(x)], "run string, i long, x double").repartition(4)
    bases = spark.createDataFrame([(s, a, f) for s, (a, f, _) in series.items()], "run string, start_ns long, fs_true double")
    got = {}
    for v in resample.resampled(df, ["run"], ["x"], bases, 10, block).collect():
        got.setdefault(v["run"], {})[v["k"]] = v["x"]
    assert "d" not in got
    step = 10**8
    for s in "abc":
        start, fs, x = series[s]
        first = -(-start // step)
        last = math.floor((start + (len(x) - 1) / fs * 1e9) / step)
        ks = np.arange(first, last + 1)
        u = (ks * step - start) * (fs / 1e9)
        ks, u = ks[u <= len(x) - 1], u[u <= len(x) - 1]
        assert sorted(got[s]) == ks.tolist()
        assert np.abs(np.array([got[s][k] for k in ks.tolist()]) - _dense_spline(x, u)).max() < 1e-9


def test_time_bases(spark):
    r = np.random.default_rng(13)
    fs, stamps, files = 10.004, [], []
    for run, begin in ((1, 0.0), (2, 50_000.0)):
        k = 0
        for j in range(12):
            late = 0 if run == 1 and j == 0 else 1.5
            stamps.append((run, k, begin + k / fs + late + 0.01 * r.standard_normal()))
            files.append(("s", run, stamps[-1][2], begin + (k + 36_000) / fs, 36_000))
            k += 36_000
    df = spark.createDataFrame([(*f, 7.0) for f in files] + [("t", 1, 0.0, 100.0, 999, 0.0)], "site string, run int, stamp double, finish double, records long, drift double").repartition(3)
    got = {v["site"]: v for v in resample.header_rates(df, ["site"]).collect()}
    inner = stamps[1:-1]
    design = np.array([[run == 1, run == 2, k] for run, k, _ in inner], float)
    line = np.linalg.lstsq(design, np.array([t for *_, t in inner]) - stamps[0][2], rcond=None)[0]
    assert np.isclose(got["s"]["fs_rtc"], 1 / line[2], rtol=1e-9) and np.isclose(got["s"]["latency"], line[0], atol=1e-6)
    assert got["t"]["fs_rtc"] is None and got["t"]["latency"] == 0
    bases = {(v["site"], v["run"]): v for v in resample.time_bases(df, ["site"], "drift").collect()}
    first, length = stamps[0][2], files[-1][3] - stamps[0][2]
    v, start = bases["s", 2], stamps[12][2]
    assert np.isclose(v["fs_true"], 1 / line[2] / (1 + 7 / length)) and np.isclose(v["start"], start + 7 * (start - first) / length - line[0])
    assert bases["s", 1]["start"] == first and bases["s", 1]["latency"] == 0 and np.isclose(bases["t", 1]["fs_true"], 9.99)


@pytest.mark.parametrize("width", [0.4, 64.0])
def test_line_groups(spark, width):
    r = np.random.default_rng(14)
    rows = [("s", float(np.round(f, 3)), r.choice(["hx", "ex"]), int(r.integers(0, 5)), float(r.uniform(3, 20)), bool(r.integers(0, 2))) for f in r.uniform(0, 12, 160)]
    got = sorted(tuple(v) for v in grouping.line_groups(spark.createDataFrame(rows, "site string, f double, channel string, hour int, excess double, mains boolean"), ["site"], 0.05, width=width).select("f", "lo", "hi", "channels", "hours", "excess", "mains").collect())
    want, group = [], []
    for row in [*sorted(rows, key=lambda v: v[1]), None]:
        if group and (row is None or row[1] - group[-1][1] > 0.05):
            if len({g[3] for g in group}) >= 2:
                want.append((np.mean([g[1] for g in group]), group[0][1], group[-1][1], ",".join(sorted({g[2] for g in group})), len({g[3] for g in group}), max(g[4] for g in group), any(g[5] for g in group)))
            group = []
        group.append(row)
    assert len(got) == len(want) and all(np.isclose(a[0], b[0]) and a[1:] == b[1:] for a, b in zip(got, want, strict=True))


def test_clusters_split(spark):
    r = np.random.default_rng(15)
    sets = {"split": (np.concatenate((r.normal(2, 0.1, 60), r.normal(1, 0.1, 40))), np.concatenate((r.normal(55, 4, 60), r.normal(3, 4, 40)))), "one": (r.normal(2, 0.1, 80), r.normal(45, 3, 80)), "few": (r.normal(2, 1, 20), r.normal(45, 30, 20))}
    df = spark.createDataFrame([(b, i, float(a), float(p)) for b, (x, y) in sets.items() for i, (a, p) in enumerate(zip(x, y, strict=True))], "band string, id int, log_z double, phase double").repartition(4)
    marked, facts = grouping.cluster_split(df, ["band"])
    got = {v["band"]: v for v in facts.collect()}
    flags = {(v["band"], v["id"]): v["masked"] for v in marked.collect()}
    assert "few" not in got and len(flags) == 200
    assert all(flags["split", i] == (i >= 60) for i in range(100)) and not any(flags["one", i] for i in range(80))
    assert got["split"]["accepted"] and not got["one"]["accepted"]
    for b in ("split", "one"):
        x = np.column_stack(sets[b])
        u = (x - np.median(x, 0)) / (1.4826 * np.median(np.abs(x - np.median(x, 0)), 0))
        order = np.argsort(x[:, 1], kind="stable")
        k = round(0.1 * len(x))
        means, labels = np.array([u[order[:k]].mean(0), u[order[-k:]].mean(0)]), None
        while True:
            new = ((u[:, None] - means[None]) ** 2).sum(-1).argmin(1)
            if labels is not None and (new == labels).all():
                break
            labels = new
            means = np.array([u[labels == i].mean(0) for i in (0, 1)])
        med = [np.median(x[labels == i, 1]) for i in (0, 1)]
        e = int(np.argmax(np.abs(med)))
        v = got[b]
        assert np.isclose(v["earth_phase"], med[e]) and np.isclose(v["source_phase"], med[1 - e]) and np.isclose(v["earth_fraction"], (labels == e).mean())
        assert np.isclose(v["mad"], np.median(np.abs(x[:, 1] - np.array(med)[labels])))


def test_chains_of_stages(spark):
    stages = spark.createDataFrame([("r", 0, f, *z) for f, z in ((0.1, (2.0, 0.0)), (10.0, (4.0, 2.0)), (100.0, (1.0, 1.0)))] + [("r", 1, 1.0, 3.0, 0.0), ("q", 0, 1.0, 0.0, 0.5)], "run string, stage int, f double, re double, im double")
    f = [0.01, 0.1, 1.0, 10.0, 50.0, 1000.0]
    spec = spark.createDataFrame([(run, v, 6.0, 3.0) for run in ("r", "q", "none") for v in f], "run string, f double, re double, im double")
    out = {(v["run"], v["f"]): complex(v["re"], v["im"]) for v in grouping.calibrated(spec, grouping.responses(stages, ["run"], spec), ["run"]).collect()}
    for v in f:
        at = [np.interp(math.log(v), np.log([0.1, 10, 100]), p) for p in ([2, 4, 1], [0, 2, 1])]
        assert np.isclose(out["r", v], (6 + 3j) / (3 * complex(*at))) and np.isclose(out["q", v], (6 + 3j) / 0.5j) and out["none", v] == 6 + 3j


def test_alignment_and_splice(spark):
    r = np.random.default_rng(16)
    ps, pl = np.geomspace(0.1, 100, 25), np.geomspace(3, 10_000, 30)
    truth = lambda p: 10 / np.sqrt(p) * np.exp(1j * (3 + 0.4 * np.log(p)))
    zs, zl = truth(ps) * 0.6 * np.exp(-0.3j) * np.exp(0.05 * r.standard_normal(25)), truth(pl)
    short, long = (spark.createDataFrame([("s", float(p), float(z.real), float(z.imag), 0.1) for p, z in zip(*v, strict=True)] + [("t", 1.0, 1.0, 0.0, 0.1)], "site string, period double, re double, im double, err double") for v in ((ps, zs), (pl, zl)))
    got = [v for v in grouping.aligned(short, long, ["site"], (4.0, 3000.0)).orderBy("period").collect()]
    assert {v["site"] for v in got} == {"s"}
    sel = (pl >= 4) & (pl <= 3000) & (pl <= ps.max())
    x = np.log10(pl[sel])
    lev = np.log10(np.abs(zl[sel])) - np.interp(x, np.log10(ps), np.log10(np.abs(zs)))
    dph = np.unwrap(np.angle(zl))[sel] - np.interp(x, np.log10(ps), np.unwrap(np.angle(zs)))
    dph = (dph + np.pi) % (2 * np.pi) - np.pi
    w = np.exp(-0.5 * ((np.log10(ps)[:, None] - x) / 0.1) ** 2)
    w /= w.sum(1, keepdims=True)
    c = 10 ** (w @ lev) * np.exp(1j * (w @ dph))
    assert got[0]["n"] == sel.sum() and np.allclose([complex(v["re"], v["im"]) for v in got], zs * c) and np.allclose([v["err"] for v in got], 0.1 * np.abs(c))
    both = grouping.windows_spliced(short, long, ["site"], (4.0, 3000.0)).where("site = 's'").collect()
    assert sorted(v["period"] for v in both if v["source"] == "short") == sorted(p for p in ps if p < 3 * 10**-0.002)
    assert sum(v["source"] == "long" for v in both) == 30


def test_sides_of_a_split_are_written_before_they_are_measured(spark, monkeypatch):
    small, sides = grouping.small, []
    monkeypatch.setattr(grouping, "small", lambda df, *a: sides.append(hasattr(df, "_stash_path")) or small(df, *a))
    points = spark.range(40).selectExpr("'a' as band", "id", "cast(id % 7 as double) as log_z", "cast(if(id < 25, 50 + id % 5, id % 5) as double) as phase")
    assert grouping.cluster_split(points, ["band"])[1].count() == 1 and sides and all(sides)
