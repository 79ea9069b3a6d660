"""Channels taken from another site on the same instants, and curves held against those of another estimate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrawave.operators.blocks import BLOCK, ends
from terrawave.operators.intervals import overlap_join
from terrawave.session import small

ON_GRID, COVER = 1e-3, 0.5


def replaced(rows: DataFrame, spec: DataFrame, k: str = "k") -> DataFrame:
    """rows(site, channel, k, x) in which the channels named by spec(site, channel, donor) are the donor's on the same instants, from the site's first sample of any channel to its last. Where the donor has none, there is none; a site that is its own donor keeps its channel."""
    taken = small(spec.select("site", "channel", "donor").where("donor is not null"))
    span = small(ends(rows, ["site"], k))
    own = rows.join(taken.drop("donor"), ["site", "channel"], "left_anti")
    theirs = rows.withColumnRenamed("site", "donor").join(taken, ["donor", "channel"]).join(span, "site").where((F.col(k) >= F.col("lo")) & (F.col(k) < F.col("hi")))
    return own.unionByName(theirs.select(*rows.columns))


def borrowed_pieces(local: DataFrame, theirs: DataFrame, pairs: DataFrame, rate: float) -> DataFrame:
    """site, run, donor, donor_run, lo, hi, shift, off_grid: the samples [lo, hi) of each run(site, run, start_ns, n) for which a run of the site's donor has samples; the donor's sample is `shift` less. off_grid is how far, in samples, the donor's run lies off the site's grid.

    Runs meet in stretches of twice the longer side's mean run, so that all in all a run is dealt to one and a half; a pair that overlaps in several is taken once.
    """
    step = 1e9 / rate
    longest = max(df.agg(F.avg("n")).first()[0] or 0.0 for df in (local, theirs))
    wide = lambda at, n: ((at - 2 * step).cast("long"), (at + (n + 2) * step).cast("long"))
    a, b = wide(F.col("start_ns"), F.col("n"))
    a2, b2 = wide(F.col("start_ns"), F.col("n"))
    mine = local.select("site", "run", "start_ns", "n").join(small(pairs.select("site", "donor")), "site").withColumn("a", a).withColumn("b", b)
    other = theirs.select(F.col("site").alias("donor"), F.col("run").alias("donor_run"), F.col("start_ns").alias("_start"), F.col("n").alias("_n"), a2.alias("a2"), b2.alias("b2"))
    both = overlap_join(mine, other, ["donor"], int(2 * step * (longest + 4)) + 1)
    lag = (F.col("_start") - F.col("start_ns")) / step
    both = both.withColumn("_lag", lag).withColumn("shift", F.rint("_lag").cast("long"))
    cut = both.withColumn("lo", F.greatest(F.lit(0), F.col("shift"))).withColumn("hi", F.least("n", F.col("shift") + F.col("_n"))).where("hi > lo")
    return cut.select("site", "run", "donor", "donor_run", "lo", "hi", "shift", (F.col("_lag") - F.col("shift")).alias("off_grid"))


def cover(pieces: DataFrame, local: DataFrame, pairs: DataFrame, least: float = COVER, tolerance: float = ON_GRID) -> DataFrame:
    """site, donor, covered, total, share, refused: samples of a site that its donor has, and why none may be taken: a run off the grid, or too small a share."""
    total = local.groupBy("site").agg(F.sum("n").alias("total"))
    got = pieces.groupBy("site").agg(F.sum(F.col("hi") - F.col("lo")).alias("covered"), F.max(F.abs("off_grid")).alias("_off"))
    at = pairs.select("site", "donor").join(total, "site").join(got, "site", "left")
    covered = F.coalesce("covered", F.lit(0))
    share = covered / F.greatest(F.col("total"), F.lit(1))
    refused = F.when(F.col("_off") > tolerance, "off grid").when(covered < least * F.col("total"), "too little")
    return at.select("site", "donor", covered.alias("covered"), "total", share.alias("share"), refused.alias("refused"))


def borrowed(samples: DataFrame, theirs: DataFrame, pieces: DataFrame, covers: DataFrame, channels: list[str], block: int = BLOCK) -> DataFrame:
    """samples(site, run, i, ...) of the pieces of sites that are not refused, with piece (its lo) and the donor's channels in place of their own; theirs is (site, run, i, channels).

    Pieces are dealt to blocks of samples, so that both joins are on equality.
    """
    good = covers.where("refused is null").select("site")
    p = pieces.join(small(good), "site").select("site", "run", "donor", "donor_run", "lo", "hi", "shift", F.explode(F.sequence(F.floor(F.col("lo") / block), F.floor((F.col("hi") - 1) / block))).alias("_block"))
    kept = [c for c in samples.columns if c not in channels]
    at = samples.select(*kept, F.floor(F.col("i") / block).alias("_block")).join(p, ["site", "run", "_block"]).where("i >= lo and i < hi")
    at = at.withColumn("_j", F.col("i") - F.col("shift"))
    other = theirs.select(F.col("site").alias("donor"), F.col("run").alias("donor_run"), F.col("i").alias("_j"), *channels)
    return at.join(other, ["donor", "donor_run", "_j"], "left").select(*kept, F.col("lo").alias("piece"), *channels)


def held_line(curve: str, at: Column, value: str) -> Column:
    """Value at a place on the line through an ordered array of structs(at, values); beyond its ends the value there."""
    before = F.try_element_at(F.filter(curve, lambda p: p["at"] <= at), F.lit(-1))
    after = F.try_element_at(F.filter(curve, lambda p: p["at"] >= at), F.lit(1))
    part = (at - before["at"]) / F.nullif(after["at"] - before["at"], F.lit(0.0))
    inside = F.coalesce(before[value] + (after[value] - before[value]) * part, before[value])
    return F.when(before.isNull(), after[value]).when(after.isNull(), before[value]).otherwise(inside)


def rate_differences(curves: DataFrame, points: DataFrame, keys: list[str], file: str = "file") -> DataFrame:
    """keys, mode, rate, n_files, n, rho, phi: medians of the distance in log10 of resistivity and in degrees of phase between curves(keys, mode, period, rho, phi), on straight lines in log period, and points(keys, mode, rate, file, period, rho, phi); the row without a rate is over all rates. A point of no resistivity is infinitely far.

    A curve is an array of one product's periods.
    """
    log = lambda c: F.when(F.col(c) == 0, F.lit(float("-inf"))).otherwise(F.log10(c))
    own = [*keys, "mode"]
    held = curves.where("period > 0").select(*own, F.struct(F.log10("period").alias("at"), log("rho").alias("rho"), F.col("phi").cast("double").alias("phi")).alias("_p"))
    held = held.groupBy(*own).agg(F.sort_array(F.collect_list("_p")).alias("_curve"))
    far = points.where("period > 0").join(held, own).withColumn("_at", F.log10("period"))
    far = far.select(*own, file, "rate", F.abs(held_line("_curve", F.col("_at"), "rho") - log("rho")).alias("_r"), F.abs(held_line("_curve", F.col("_at"), "phi") - F.col("phi")).alias("_f"))
    both = far.withColumn("rate", F.explode(F.array("rate", F.lit(None).cast(far.schema["rate"].dataType))))
    return both.groupBy(*own, "rate").agg(F.count_distinct(F.col(file)).alias("n_files"), F.count("*").alias("n"), F.percentile("_r", F.lit(0.5)).alias("rho"), F.percentile("_f", F.lit(0.5)).alias("phi"))


def block_means_agree(rows: DataFrame, keys: list[str], x: str, rate: int, exact: float = 1e-6, with_gaps: float = 0.05, k: str = "k") -> DataFrame:
    """keys, mean_error, median_error, passed: how far the mean of the means of whole seconds lies from the mean, and the median of these from the median, in standard deviations of the samples; passed if the first is within a tolerance, a wider one where samples are missing. Seconds begin at the key's first sample."""
    at = rows.select(*keys, F.col(k).alias("_k"), F.nanvl(F.col(x).cast("double"), F.lit(None)).alias("_x")).where("_x is not null")
    whole = at.groupBy(*keys).agg(F.avg("_x").alias("_mean"), F.stddev_pop("_x").alias("_sd"), F.percentile_approx("_x", F.lit(0.5), F.lit(1_000_000)).alias("_median"), F.min("_k").alias("_lo"), (F.max("_k") - F.min("_k") + 1 > F.count("*")).alias("_gaps"))
    seconds = at.join(small(whole.select(*keys, "_lo")), keys).groupBy(*keys, F.floor((F.col("_k") - F.col("_lo")) / rate).alias("_s")).agg(F.avg("_x").alias("_m"))
    means = seconds.groupBy(*keys).agg(F.avg("_m").alias("_mm"), F.percentile_approx("_m", F.lit(0.5), F.lit(1_000_000)).alias("_md"))
    sd = F.when(F.col("_sd") > 0, F.col("_sd")).otherwise(1.0)
    both = whole.join(means, keys).select(*keys, (F.abs(F.col("_mm") - F.col("_mean")) / sd).alias("mean_error"), (F.abs(F.col("_md") - F.col("_median")) / sd).alias("median_error"), "_gaps")
    return both.select(*keys, "mean_error", "median_error", (F.col("mean_error") <= F.when(F.col("_gaps"), with_gaps).otherwise(exact)).alias("passed"))
