"""Tensors, coherences, weighted frequencies and delays against loops in numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrawave.operators import tensor


def _noise(r, n):
    return r.standard_normal(n) + 1j * r.standard_normal(n)


def _solve(y, x, r, w):
    m = r.conj() * w[:, None]
    return np.linalg.solve(m.T @ x, m.T @ y)


def _huber(y, x, r):
    w = np.ones(len(y))
    b = _solve(y, x, r, w)
    for _ in range(12):
        left = np.abs(y - x @ b)
        w = np.minimum(1, 1.5 * (1.4826 * np.median(left) + 1e-30) / np.maximum(left, 1e-30))
        new = _solve(y, x, r, w)
        done = (np.abs(new - b) <= 1e-5 * np.abs(b)).all()
        b = new
        if done:
            break
    return b, w


def _coherence(y, x):
    s, c = x.T @ x.conj(), x.T @ y.conj()
    return float((c.conj() @ np.linalg.solve(s, c)).real / (np.abs(y) ** 2).sum())


@pytest.mark.parametrize("method", ["huber", "ls"])
def test_tensor_equals_numpy(spark, method):
    r = np.random.default_rng(5)
    windows, harmonics, slices = 90, 3, 8
    data, rows = {}, []
    for site, n in (("a", windows), ("b", 5)):
        size = n * harmonics
        x = np.stack([_noise(r, size), _noise(r, size)], 1)
        ref = x + 0.2 * np.stack([_noise(r, size), _noise(r, size)], 1)
        y = x @ np.array([[1.1 - 0.2j, 0.1], [0.2j, 0.9 + 0.1j]]).T + 0.1 * np.stack([_noise(r, size), _noise(r, size)], 1)
        y[:25] += 30 * np.stack([_noise(r, 25), _noise(r, 25)], 1) if n == windows else 0
        f = np.tile([0.1, 0.2, 0.25], n)
        part = np.minimum(np.repeat(np.arange(n), harmonics) * slices // n, slices - 1)
        data[site] = (x, ref, y, f, part)
        columns = {"e1": y[:, 0], "e2": y[:, 1], "b1": x[:, 0], "b2": x[:, 1], "q1": ref[:, 0], "q2": ref[:, 1]}
        rows += [(site, i % harmonics, float(f[i]), int(part[i]), *(float(p) for c in columns.values() for p in (c[i].real, c[i].imag))) for i in range(size)]
    df = spark.createDataFrame(rows, "site string, h int, f double, slice int, " + ", ".join(f"{c}_re double, {c}_im double" for c in columns)).repartition(4)
    got = {v["site"]: v for v in tensor.flags(tensor.tensor(df, ["site"], ("e1", "e2"), ("b1", "b2"), ("q1", "q2"), method)).collect()}
    assert got["b"]["t_xx_re"] is None and got["b"]["not_estimated"] and not got["b"]["few_groups"] and got["b"]["n_groups"] == 0
    x, ref, y, f, part = data["a"]
    v = got["a"]
    t, pseudo, freqs = np.zeros((2, 2), complex), np.zeros((slices, 2, 2), complex), []
    for i, o in enumerate("xy"):
        b, w = _huber(y[:, i], x, ref) if method == "huber" else (_solve(y[:, i], x, ref, np.ones(len(f))), np.ones(len(f)))
        t[i] = b
        for g in range(slices):
            k = part != g
            pseudo[g, i] = _solve(y[k, i], x[k], ref[k], w[k])
        root = np.sqrt(w)
        assert np.isclose(v[f"coh_weighted_{o}"], _coherence(root * y[:, i], root[:, None] * ref))
        assert np.isclose(v[f"coh_out_{o}"], _coherence(y[:, i], ref)) and np.isclose(v[f"coh_in_{o}"], _coherence(x[:, i], ref))
        assert np.isclose(v[f"down_{o}"], (w < 1).mean())
        c = [np.sqrt(abs(np.linalg.det((ref[h::3].conj() * w[h::3, None]).T @ x[h::3]))) for h in range(3)]
        freqs.append(np.dot(c, f[:3]) / sum(c))
    assert np.isclose(v["f_weighted"], np.mean(freqs))

    def sd(z):
        return np.sqrt((slices - 1) / slices * (np.abs(z - z.mean(0)) ** 2).sum(0))

    for i in range(2):
        for j in range(2):
            e = "xy"[i] + "xy"[j]
            assert np.isclose(complex(v[f"t_{e}_re"], v[f"t_{e}_im"]), t[i, j]) and np.isclose(v[f"t_{e}_err"], sd(pseudo[:, i, j]))
    det, dets = np.linalg.det(t), np.linalg.det(pseudo)
    assert np.isclose(v["half_arg"], np.degrees(np.angle(det)) / 2) and np.isclose(v["abs_det_err"], sd(np.abs(dets)))
    assert np.isclose(v["half_arg_err"], np.degrees(sd(np.angle(dets / det) / 2))) and v["n_groups"] == slices
    assert not (v["not_estimated"] or v["few_groups"] or v["off_diagonal"] or v["re_det_negative"])


def test_tensor_refuses_shared_channels(spark):
    df = spark.range(1)
    for names in ((("e1", "e2"), ("b1", "b2"), ("b1", "q")), (("e1", "e2"), ("b1", "b2"), ("e1", "q")), (("e1", "e2"), ("e1", "b2"), ("p", "q"))):
        with pytest.raises(ValueError):
            tensor.tensor(df, [], *names)


def test_planted_delays_are_found(spark):
    r = np.random.default_rng(6)
    rate = 100.0
    planted = {"a": 0.0031, "b": -0.0473, "c": 0.0, "d": 0.2}
    f = np.sort(r.uniform(1, 30, 24))
    rows = []
    for s, tau in planted.items():
        phase = 25 - 360 * f * tau + 0.5 * r.standard_normal(len(f))
        rows += [(s, float(a), float((b + 90) % 180 - 90), 0.5) for a, b in zip(f, phase, strict=True)]
    rows += [("noise", float(a), float(b), 0.5) for a, b in zip(f, r.uniform(-90, 90, len(f)), strict=True)] + [("few", 1.0, 3.0, 0.5), ("few", 2.0, 3.0, 0.5)]
    rows += [("loose", float(a), 0.0, 80.0) for a in f] + [("a", 5.0, float("nan"), 0.5), ("a", 5.0, 3.0, 0.0), ("a", None, 3.0, 1.0)]
    df = spark.createDataFrame(rows, "site string, f double, phase double, sd double").repartition(3)
    got = {v["site"]: v for v in tensor.delay_scan(df, ["site"], tolerance=0.4).collect()}
    for s, tau in planted.items():
        assert got[s]["reason"] is None and abs(got[s]["delay"] - tau) < 0.1 / rate
        assert abs(got[s]["intercept"] - 25) < 1 and got[s]["delay_err"] < 1e-4
    assert got["noise"]["reason"] in ("no line", "bound") and got["few"]["reason"] == "few bands" and got["loose"]["reason"] == "errors"
    assert got["noise"]["delay"] is None
    near = {v["site"]: v for v in tensor.delay_scan(df.where("site = 'd'"), ["site"], tolerance=0.1).collect()}
    assert near["d"]["reason"] is not None
    assert df.where(F.lit(False)).count() == 0 and tensor.delay_scan(df.where(F.lit(False)), ["site"]).count() == 0


def test_a_delay_tried_makes_no_row(spark):
    rows = [(site, float(f), 30.0 - 360 * f * 0.003 * site, 2.0) for site in range(4) for f in range(1, 40)]
    found = tensor.delay_scan(spark.createDataFrame(rows, "site long, f double, phase double, sd double"), ["site"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "explode" not in plan
    got = {v["site"]: v for v in found.collect()}
    assert all(abs(got[s]["delay"] - 0.003 * s) < 1e-9 and got[s]["reason"] is None and got[s]["resultant"] > 0.999 for s in range(4))
