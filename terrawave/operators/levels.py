"""Levels of raw channels: medians of even subsamples, shares at the rail, verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrawave.operators import order
from terrawave.session import small, stash

#: From best to worst.
VERDICTS = ("ok", "saturated", "open")


def even_subsample(rows: DataFrame, keys: list[str], most: int, k: str = "k") -> DataFrame:
    """Every n-th sample of each key, with the least n that leaves about `most`: those n steps of the grid from its first."""
    size = rows.groupBy(*keys).agg(F.min(k).alias("_k0"), F.ceil(F.count("*") / most).alias("_step"))
    return rows.join(size, keys).where((F.col(k) - F.col("_k0")) % F.col("_step") == 0).drop("_k0", "_step")


def rail_fraction(rows: DataFrame, keys: list[str], x: str = "x", level: float = 0.9, rail: float | None = None) -> DataFrame:
    """keys, median, rail_fraction: the share of samples at the rail; 1 for a flat channel.

    Without an absolute `rail`, a sample is at the rail of its side of the median at `level` of the largest excursion there, and the larger share counts.
    """
    ends = rows.groupBy(*keys).agg(F.min(x).alias("_low"), F.max(x).alias("_high"))
    facts = ends.join(order.percentile(rows, keys, x, name="median"), keys, "left")
    if rail is not None:
        share = F.avg((F.abs(F.col(x)) >= rail).cast("double"))
    else:
        high = F.col(x) >= F.col("median") + level * (F.col("_high") - F.col("median"))
        low = F.col(x) <= F.col("median") - level * (F.col("median") - F.col("_low"))
        share = F.greatest(F.avg(high.cast("double")), F.avg(low.cast("double")))
    return rows.join(facts, keys).groupBy(*keys).agg(F.first("median").alias("median"), share.alias("rail_fraction"))


def verdicts(levels: DataFrame, kind: str, threshold: float, ratio_limit: float, rail_limit: float) -> DataFrame:
    """levels(kind, median, rail_fraction) with typical, ratio and verdict; the first rule that holds decides: open, saturated, ok."""
    typical = levels.groupBy(kind).agg(F.percentile(F.abs(F.col("median")), F.lit(0.5)).alias("typical"))
    rows = levels.join(typical, kind).withColumn("ratio", F.when(F.col("typical") > 0, F.abs(F.col("median")) / F.col("typical")))
    is_open = (F.abs(F.col("median")) > threshold) | F.coalesce(F.col("ratio") > ratio_limit, F.lit(False))
    return rows.withColumn("verdict", F.when(is_open, "open").when(F.col("rail_fraction") > rail_limit, "saturated").otherwise("ok"))


def worst(rows: DataFrame, keys: list[str], verdict: str = "verdict") -> DataFrame:
    """keys and their worst verdict."""
    place = F.array_position(F.array(*map(F.lit, VERDICTS)), F.col(verdict))
    return rows.groupBy(*keys).agg(F.max_by(verdict, place).alias("worst"))


def channel_stats(rows: DataFrame, keys: list[str], x: str = "x", scales: float = 3.0) -> DataFrame:
    """keys, n, median, mad, p5, p95, beyond: level and spread of each channel, and the share of its samples more than so many scaled median distances from the median. Nulls and nan are passed over. rows are read four times; exact quantiles, without a key's values in one task."""
    there = stash(rows.select(*keys, F.col(x).cast("double").alias("_x")).where("_x is not null and not isnan(_x)"), "samples")
    level = order.percentiles(there, keys, "_x", {"median": 0.5, "p5": 0.05, "p95": 0.95})
    far = there.join(small(stash(level, "level")), keys).withColumn("_d", F.abs(F.col("_x") - F.col("median")))
    mad = order.percentile(far, keys, "_d", name="_m").select(*keys, (1.4826 * F.col("_m")).alias("mad"))
    over = (F.round("_d", 9) > F.round(scales * F.col("mad"), 9)).cast("double")
    return far.join(small(stash(mad, "mad")), keys).groupBy(*keys).agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("median", "mad", "p5", "p95")), F.avg(over).alias("beyond"))
