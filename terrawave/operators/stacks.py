"""Stacks of members: spectra by band, samples in time, and weights by each member's coherence with the mean of the others. What the others sum to is the total less the member's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrawave.operators import welch
from terrawave.session import small, stash

REJECT, LEAST, FLOOR = 25.0, 2, 0.05


def _spread(of: str) -> Column:
    return F.percentile(of, F.lit(0.5))


def normalised_power(spectra: DataFrame, keys: list[str], member: str, w: str = "w") -> DataFrame:
    """keys, member, w, scale, power: a member's mean power over a band's harmonics in each window over its median over windows; scale is the root of that median. Members without power are left out."""
    power = spectra.groupBy(*keys, member, w).agg(F.avg(F.col("re") ** 2 + F.col("im") ** 2).alias("_p"))
    median = power.groupBy(*keys, member).agg(_spread("_p").alias("_m")).where("_m > 0")
    return power.join(small(median), [*keys, member]).select(*keys, member, w, F.sqrt("_m").alias("scale"), (F.col("_p") / F.col("_m")).alias("power"))


def kept_members(spectra: DataFrame, keys: list[str], member: str, reject: float = REJECT, w: str = "w") -> DataFrame:
    """keys, member, w, scale, power, level, kept: a member is left out of a window whose power exceeds `reject` times the array's level there, the median over members."""
    if reject <= 1:
        raise ValueError("members at the array's level would be rejected")
    power = stash(normalised_power(spectra, keys, member, w), "power")
    level = power.groupBy(*keys, w).agg(_spread("power").alias("level"))
    return power.join(level, [*keys, w]).withColumn("kept", F.col("power") <= reject * F.col("level"))


def band_stack(spectra: DataFrame, keys: list[str], member: str = "member", reject: float = REJECT, least: int = LEAST, method: str = "mean", w: str = "w", h: str = "h") -> DataFrame:
    """keys, w, h, members, re, im: mean or marginal median of the kept members' spectra over their scales, in windows that keep `least` of them."""
    if method not in ("mean", "median") or least < 1:
        raise ValueError("method is mean or median, of one member at least")
    kept = kept_members(spectra, keys, member, reject, w).where("kept").select(*keys, member, w, "scale")
    scaled = spectra.join(kept, [*keys, member, w]).select(*keys, w, h, (F.col("re") / F.col("scale")).alias("re"), (F.col("im") / F.col("scale")).alias("im"))
    middle = F.avg if method == "mean" else _spread
    return scaled.groupBy(*keys, w, h).agg(F.count("*").alias("members"), middle("re").alias("re"), middle("im").alias("im")).where(F.col("members") >= least)


def plain_stack(rows: DataFrame, keys: list[str], member: str = "member", x: str = "x", k: str = "k") -> DataFrame:
    """keys, k, members, x: mean over the members there are of samples less their median, over their root mean square about it; flat members are left out."""
    there = rows.where(F.col(x).isNotNull() & ~F.isnan(x))
    median = there.groupBy(*keys, member).agg(F.percentile_approx(x, F.lit(0.5), F.lit(1_000_000)).alias("_m"))
    level = there.join(small(median), [*keys, member])
    size = level.groupBy(*keys, member).agg(F.sqrt(F.avg((F.col(x) - F.col("_m")) ** 2)).alias("_s")).where("_s > 0")
    scaled = level.join(small(size), [*keys, member]).withColumn(x, (F.col(x) - F.col("_m")) / F.col("_s"))
    return scaled.groupBy(*keys, k).agg(F.count("*").alias("members"), F.avg(x).alias(x))


def beside_others(rows: DataFrame, keys: list[str], member: str = "member", x: str = "x", k: str = "k") -> DataFrame:
    """keys, member, k, x, others: each member's sample less its median over the whole, and the mean of the others' there; samples of a lone member are left out."""
    median = rows.groupBy(*keys, member).agg(F.percentile_approx(x, F.lit(0.5), F.lit(1_000_000)).alias("_m"))
    level = rows.join(small(median), [*keys, member]).select(*keys, member, k, (F.col(x) - F.col("_m")).alias(x))
    at = Window.partitionBy(*keys, k)
    n = F.count("*").over(at)
    return level.withColumn("_n", n).withColumn("others", (F.sum(x).over(at) - F.col(x)) / (F.col("_n") - 1)).where("_n > 1").drop("_n")


def member_coherence(rows: DataFrame, keys: list[str], rate: float, chunk: int, segment: int, shortest: float, longest: float, per_decade: int = 6, factor: int = 4, levels: int = 1, member: str = "member", x: str = "x", k: str = "k") -> DataFrame:
    """keys, member, chunk, coherence: squared coherence of a member with the mean of the others in each whole chunk of so many samples, the mean over the band's bins of period on each level and of these over the levels, each level taking the periods that the finer ones do not reach."""
    both = stash(beside_others(rows, keys, member, x, k).withColumnRenamed(x, "member_x"), "beside")  # read for its ends and for its blocks
    own = [*keys, member]
    parts = []
    for level, series in enumerate(welch.levels_of(both, own, ["member_x", "others"], factor, levels, k)):
        at = rate / factor**level
        size = chunk // factor**level
        spec = welch.window_spectra(series, own, ["member_x", "others"], [("member_x", "others")], at, size, size, segment)
        f = welch.by_frequency(spec, own, ["psd_member_x", "psd_others", "csd_member_x_others_re", "csd_member_x_others_im"], at, segment)
        low, high = max(shortest, segment * factor ** (level - 1) / rate if level else 0), min(longest, segment / at)
        f = f.where((1 / F.col("f") >= low) & (1 / F.col("f") < high)).withColumn("_bin", welch.log_bin(F.col("f"), shortest, longest, per_decade)).where("_bin is not null")
        bins = f.groupBy(*own, "w", "_bin").agg(F.avg(welch.coherence("member_x", "others")).alias("_c"))
        parts.append(bins.groupBy(*own, "w").agg(F.avg("_c").alias("_c")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy(*own, F.col("w").alias("chunk")).agg(F.avg("_c").alias("coherence"))


def weights(coherences: DataFrame, keys: list[str], floor: float = FLOOR) -> DataFrame:
    """coherences with weight: each chunk's coherences (null: 0) over their sum; members under the floor get 0 and the rest is brought to one again. A chunk without any coherence has equal weights; one whose members are all under the floor keeps them."""
    chunk = Window.partitionBy(*keys)
    g = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(F.nanvl("coherence", F.lit(0.0)), F.lit(0.0))))
    rows = coherences.withColumn("_g", g).withColumn("_s", F.sum("_g").over(chunk)).withColumn("_n", F.count("*").over(chunk))
    rows = rows.withColumn("_w", F.when(F.col("_s") > 0, F.col("_g") / F.col("_s")).otherwise(1 / F.col("_n")))
    rows = rows.withColumn("_k", F.when(F.col("_w") < floor, 0.0).otherwise(F.col("_w"))).withColumn("_t", F.sum("_k").over(chunk))
    return rows.withColumn("weight", F.when(F.col("_t") > 0, F.col("_k") / F.col("_t")).otherwise(F.col("_w"))).drop("_g", "_s", "_n", "_w", "_k", "_t")


def weighted_stack(rows: DataFrame, keys: list[str], weighed: DataFrame, chunk: int, member: str = "member", x: str = "x", k: str = "k") -> DataFrame:
    """keys, k, x: sum of the members' samples less their medians times their chunk's weights; samples after the last whole chunk take its weights. Chunks are counted from the key's first sample."""
    median = rows.groupBy(*keys, member).agg(F.percentile_approx(x, F.lit(0.5), F.lit(1_000_000)).alias("_m"))
    span = rows.groupBy(*keys).agg(F.min(k).alias("_lo")).join(weighed.groupBy(*keys).agg(F.max("chunk").alias("_last")), keys)
    at = rows.join(small(median), [*keys, member]).join(small(span), keys).withColumn("chunk", F.least(F.floor((F.col(k) - F.col("_lo")) / chunk), "_last"))
    both = at.join(weighed.select(*keys, member, "chunk", "weight"), [*keys, member, "chunk"])
    return both.groupBy(*keys, k).agg(F.sum(F.col("weight") * (F.col(x) - F.col("_m"))).alias(x))
