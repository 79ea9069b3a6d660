"""Declared lists of filters against the filters one by one, and cycles against loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrawave.operators import bursts, declared, mains, masking, recursive
from terrawave.plans import cleaning


def _frame(spark, series):
    return spark.createDataFrame([("s", c, 10 + i, float(v)) for c, x in series.items() for i, v in enumerate(x)], "site string, channel string, k long, x double").repartition(3)


def _series(df, c):
    return np.array([v["x"] for v in df.where(F.col("channel") == c).orderBy("k").collect()])


@pytest.mark.parametrize("period", [12.0, 11.6, 12.4])
def test_cycles_equal_loops(spark, period):
    r = np.random.default_rng(18)
    x = r.standard_normal(700) + 5 * np.sin(2 * np.pi * np.arange(700) / period)
    window, length = 150, round(period)
    y = x.copy()
    for w0 in range(0, 700, window):
        w1 = min(700, w0 + window)
        cycles = int((w1 - w0) // period)
        if cycles < 5:
            continue
        starts = [s for s in (w0 + int(np.rint(j * period)) for j in range(cycles)) if s + length <= 700]
        shape = np.median([x[s : s + length] for s in starts], axis=0)
        shape -= np.median(shape)
        for s in starts:
            y[s : s + length] -= shape
    got = declared.cycles_subtracted(_frame(spark, {"ex": x}), ["site", "channel"], "x", period, window)
    assert np.allclose(_series(got, "ex"), y)


def test_lists_apply_in_order(spark):
    r = np.random.default_rng(19)
    rate, n = 40.0, 3000
    t = np.arange(n) / rate
    x = {c: np.cumsum(r.standard_normal(n)) * 0.1 + np.sin(2 * np.pi * 10 * t) + i for i, c in enumerate(("ex", "ey", "hx"))}
    x["ex"][1524:1538] += 90
    df = _frame(spark, x)
    donor = _frame(spark, {"hx": 2 * x["hx"]}).where("k < 2000")
    filters = [{"flip": {"channels": ["ey"]}}, {"mains": {"f0": 10.0, "channels": ["ex", "ey"]}}, {"replace": {"site": "d", "channels": ["hx"]}}, {"burst": {"threshold": 12.0, "reference": ["ex"], "min_len_s": 0.1}}, {"hp": {"cutoff_hz": 0.2, "channels": ["ey"]}}]
    out = declared.applied(df, ["site"], rate, filters, {"d": donor})
    by = ["site", "channel"]
    flipped = df.where("channel = 'ey'").withColumn("x", -F.col("x"))
    less = mains.subtracted(flipped, by, "x", rate, f0=10.0)
    got = _series(out, "ey")
    assert len(got) == n
    # Bursts are those of ex: fill them before the last filter.
    ex = _series(mains.subtracted(df.where("channel = 'ex'"), by, "x", rate, f0=10.0), "ex")
    assert np.abs(_series(out, "ex")[1528:1534] - ex[1400]).max() < 30 < np.abs(ex[1528:1534] - ex[1400]).min()
    late = recursive.filtered(less, by, "x", rate, 0.2, "high")
    assert np.allclose(got[:1200], _series(late, "ey")[:1200], atol=0.5)
    hx = [v["x"] for v in out.where("channel = 'hx'").orderBy("k").collect()]
    assert hx[:1400] == [2 * v for v in x["hx"][:1400]] and hx[-1] is None
    with pytest.raises(ValueError):
        declared.applied(df, ["site"], rate, [{"what": {}}])
    with pytest.raises(ValueError):
        declared.applied(df, ["site"], rate, [{"hp": {}}])
    assert declared.list_hash([{"hp": {"order": 4, "cutoff_hz": 1}}]) == declared.list_hash([{"hp": {"cutoff_hz": 1, "order": 4}}]) != declared.list_hash([])
    assert declared.list_hash(None) == "97d170e1"


def test_the_query_fills_bursts(spark, monkeypatch):
    """`filters_applied` against its filters one by one: bursts are found on the turned channel and filled before slow parts go."""
    r = np.random.default_rng(20)
    x = {c: r.standard_normal(1500) + i for i, c in enumerate(("hx", "ex"))}
    x["ex"][700:725] += 40 * r.standard_normal(25)
    df = _frame(spark, x).withColumn("site", F.lit(7).cast("long"))
    monkeypatch.setattr(cleaning, "long_dense", lambda *_: df)
    out, by = cleaning.filters_applied(spark, ""), ["site", "channel"]
    now = df.withColumn("x", F.when(F.col("channel") == "hx", -F.col("x")).otherwise(F.col("x")))
    hot = bursts.any_louder([bursts.burst_ratio(now, by, "x", 3, 8, 30)], ["site"], 1.5)
    spans = masking.bursts(hot, ["site"], F.col("loud"), 3, 3).withColumnsRenamed({"a": "a2", "b": "b2"})
    assert spans.where("a2 <= 720 and b2 >= 725").count() == 1
    level = bursts.with_level(now, by, "x", 8)
    filled = masking.spans_filled(level, spans.join(now.select(*by).distinct(), "site"), by, "x", "level", 4, 64)
    assert np.abs(_series(filled, "ex")[706:718]).max() < 25 < np.abs(x["ex"][700:725]).max()
    high = recursive.filtered(filled.drop("level"), by, "x", 1.0, 0.01, "high", 4)
    assert np.allclose(_series(out, "hx"), _series(high, "hx"), atol=1e-5)
    notched = recursive.notched(high.where("channel = 'ex'"), by, "x", 1.0, f0=1 / 7, q=4.0, passes=1)
    assert np.allclose(_series(out, "ex"), _series(notched, "ex"), atol=1e-5)
