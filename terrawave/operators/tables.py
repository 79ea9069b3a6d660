"""Tables beside the samples: facts filled in, products gone stale, ranges in use, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrawave.operators.intervals import islands


def filled(rows: DataFrame, facts: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """rows with what facts (one row for each key) know of columns where rows have nothing; what rows have stays."""
    known = facts.select(*keys, *(F.col(c).alias(f"_{c}") for c in columns))
    out = rows.join(known, keys, "left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_{c}"))).drop(f"_{c}")
    return out


def gained(samples: DataFrame, gains: DataFrame, x: str = "x") -> DataFrame:
    """Samples divided by the gain of gains(site, channel, gain); no gain, or one of zero, leaves them."""
    g = F.coalesce(F.nullif("gain", F.lit(0.0)), F.lit(1.0))
    return samples.join(gains, ["site", "channel"], "left").withColumn(x, F.col(x) / g).drop("gain")


def stale(products: DataFrame, now: DataFrame, keys: list[str], settings: list[str]) -> DataFrame:
    """products with `changed`, the first of their settings that is not as it is now (null against null is the same); null for a current one, `missing` where nothing is known now."""
    current = now.select(*keys, F.lit(True).alias("_known"), *(F.col(c).alias(f"_{c}") for c in settings))
    out = products.join(current, keys, "left")
    reason = F.lit(None).cast("string")
    for c in reversed(settings):
        reason = F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), c).otherwise(reason)
    return out.withColumn("changed", F.when(F.col("_known").isNull(), "missing").otherwise(reason)).drop("_known", *(f"_{c}" for c in settings))


def longest_run(rows: DataFrame, keys: list[str], flag: Column, k: str = "k") -> DataFrame:
    """keys, a, b of the longest stretch of consecutive k on which flag holds, the first of equal ones."""
    runs = islands(rows.where(flag), keys, k)
    best = runs.groupBy(*keys).agg(F.max_by(F.struct("a", "b"), F.struct(F.col("b") - F.col("a"), -F.col("a"))).alias("r"))
    return best.select(*keys, "r.a", "r.b")


def marginal_median(members: DataFrame, keys: list[str], parts: list[str], least: int = 1) -> DataFrame:
    """keys, members and the median of each part of members' values on its own (real and imaginary parts apart), where so many have one."""
    n = F.count(F.when(F.col(parts[0]).isNotNull(), 1))
    out = members.groupBy(*keys).agg(n.alias("members"), *(F.percentile(c, F.lit(0.5)).alias(c) for c in parts))
    return out.where(F.col("members") >= least)


def sound_summary(weeks: DataFrame, keys: list[str], sound: Column, week: str = "week") -> DataFrame:
    """keys, weeks, sound, first, last: how many weeks there are and how many are sound, and the first and last sound one."""
    return weeks.groupBy(*keys).agg(F.count("*").alias("weeks"), F.count_if(sound).alias("sound"), F.min(F.when(sound, F.col(week))).alias("first"), F.max(F.when(sound, F.col(week))).alias("last"))


def azimuth_spread(rows: DataFrame, keys: list[str], hour: Column, x: str = "hx", y: str = "hy") -> DataFrame:
    """keys, hours, spread: between the 5th and 95th percentiles of the azimuth of hourly medians, in degrees about the mean direction."""
    by_hour = rows.groupBy(*keys, hour.alias("_hour")).agg(F.percentile(x, F.lit(0.5)).alias("_x"), F.percentile(y, F.lit(0.5)).alias("_y"))
    mean = by_hour.groupBy(*keys).agg(F.atan2(F.avg("_y"), F.avg("_x")).alias("_m"))
    turn = F.pmod(F.degrees(F.atan2("_y", "_x") - F.col("_m")) + 180.0, F.lit(360.0)) - 180.0
    rows = by_hour.join(mean, keys).withColumn("_t", turn)
    return rows.groupBy(*keys).agg(F.count("*").alias("hours"), (F.percentile("_t", F.lit(0.95)) - F.percentile("_t", F.lit(0.05))).alias("spread"))


def merged_lattice(periods: DataFrame, keys: list[str], period: str = "period", tolerance: float = 1e-9) -> DataFrame:
    """keys, period, n: periods within a relative tolerance of the one before are one, which takes the least of them."""
    w = Window.partitionBy(*keys).orderBy(period)
    new = F.coalesce(F.col(period) / F.lag(period).over(w) - 1 > tolerance, F.lit(True)).cast("int")
    rows = periods.withColumn("_g", new).withColumn("_g", F.sum("_g").over(w))
    return rows.groupBy(*keys, "_g").agg(F.min(period).alias("period"), F.count("*").alias("n")).drop("_g")


def pooled(bins: DataFrame, bands: DataFrame, keys: list[str], ok: Column) -> DataFrame:
    """keys, band, n, re, im, var: bins(period, re, im, var) that are fit, averaged over the bands(band, lo, hi), lo <= period < hi, that hold them; the variance of a mean is the sum over n squared."""
    inside = bins.where(ok).join(bands, (F.col("period") >= F.col("lo")) & (F.col("period") < F.col("hi")))  # bands are few, by parameter
    n = F.count("*")
    return inside.groupBy(*keys, "band").agg(n.alias("n"), F.avg("re").alias("re"), F.avg("im").alias("im"), (F.sum("var") / (n * n)).alias("var"))


def clock_status(records: DataFrame, keys: list[str], sync: str, stage: str, k: str = "k", stride: int = 50) -> DataFrame:
    """keys, unsynchronised, stages: share of every stride-th record whose clock is not locked, and the stages met."""
    some = records.where(F.col(k) % stride == 0)
    return some.groupBy(*keys).agg(F.avg((F.col(sync) != 0).cast("double")).alias("unsynchronised"), F.array_join(F.array_sort(F.collect_set(F.col(stage).cast("string"))), ",").alias("stages"))


def phase_quadrant(rows: DataFrame, keys: list[str], phase: Column, centre: float, least: int = 5) -> DataFrame:
    """keys, n, phase, in_place: the median phase (degrees) on a circle cut opposite the quadrant's centre, and whether it lies in the quadrant; null for fewer periods than `least`."""
    about = F.pmod(phase - centre + 180.0, F.lit(360.0)) - 180.0
    out = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.percentile(about, F.lit(0.5)).alias("_m"))
    fit = F.col("n") >= least
    return out.select(*keys, "n", F.when(fit, F.col("_m") + centre).alias("phase"), F.when(fit, F.round(F.abs("_m"), 9) <= 45).alias("in_place"))


def stitched(short: DataFrame, long: DataFrame, keys: list[str], band: str = "band") -> DataFrame:
    """Rows of the short-period product below the first band that both hold, and of the long one from it on; keys without a shared band keep both."""
    shared = short.select(*keys, band).join(long.select(*keys, band), [*keys, band]).groupBy(*keys).agg(F.min(band).alias("_first"))
    below = short.join(shared, keys, "left").where(F.col("_first").isNull() | (F.col(band) < F.col("_first")))
    above = long.join(shared, keys, "left").where(F.col("_first").isNull() | (F.col(band) >= F.col("_first")))
    return below.drop("_first").unionByName(above.drop("_first"))


def findings(rows: DataFrame, keys: list[str], rules: list[tuple[Column, str, str]]) -> DataFrame:
    """keys, level, finding: a row for each rule (condition, level, text) that holds."""
    held = F.array(*(F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(level).alias("level"), F.lit(text).alias("finding"))) for c, level, text in rules))
    return rows.select(*keys, F.explode(F.array_compact(held)).alias("f")).select(*keys, "f.level", "f.finding")
