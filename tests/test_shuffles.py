"""Rows are shuffled as often as a step needs, and tasks hold few blocks at a time."""

import re

from terrawave.operators import bursts, screens, stacks, welch


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", _plan(df)))


def _series(spark, n=400):
    return spark.createDataFrame([("a", c, k, float((k * 7 + i) % 11 + (k % 50 == 0) * 30)) for i, c in enumerate(("p", "q")) for k in range(n)], "site string, channel string, k long, x double")


def test_burst_ratio_shuffles_its_samples_once(spark):
    ratio = bursts.burst_ratio(_series(spark), ["site", "channel"], "x", 3, 20, 15)
    assert _exchanges(ratio) <= 2  # the blocks, and the ends of the keys
    assert ratio.count() == 800


def test_spectra_of_windows_are_made_of_few_blocks_at_a_time(spark):
    rows = _series(spark).selectExpr("channel as site", "k", "x as hx", "x * x as ex")
    made = welch.window_spectra(rows, ["site"], ["hx", "ex"], [("hx", "ex")], 1.0, 160, 64, 32)
    assert "MapInArrow" in _plan(made) and "MapInPandas" not in _plan(made)  # by slices of a batch, not by batches
    assert made.count() == 8


def test_member_coherence_puts_the_members_beside_the_others_once(spark):
    rows = _series(spark).withColumnRenamed("channel", "member")
    made = stacks.member_coherence(rows, ["site"], 1.0, 160, 32, 2.0, 32.0)
    assert "Window" not in _plan(made)  # what stands before the blocks is written, not made again for each reader
    assert made.count() == 4


def test_polarity_meets_the_others_by_sums(spark):
    rows = spark.createDataFrame([(0, m, w, h, float(m + 1), float((m * w + h) % 5)) for m in range(4) for w in range(6) for h in range(3)], "band long, member long, w long, h long, re double, im double")
    made = screens.polarity(rows, ["band"])
    assert "Window" not in _plan(made)
    assert made.count() == 4
