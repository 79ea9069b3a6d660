"""Chains of lines in frequency, two clusters of estimates, responses of chains of stages, and the alignment of two products."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrawave.functions import cx
from terrawave.session import release, small, stash


def line_groups(lines: DataFrame, keys: list[str], tolerance: float, hours: int = 2, width: float = 64.0) -> DataFrame:
    """keys, f, lo, hi, channels, hours, excess, mains of lines(f, channel, hour, excess, mains) chained while the next frequency is no more than `tolerance` away, for chains met in `hours` different hours or more.

    Chains are found in ranges of `width` Hz first; of a range only the ends of its chains meet those of the others.
    """
    inner = [*keys, "_cell"]
    slim = lines.select(*keys, "f").distinct().withColumn("_cell", F.floor(F.col("f") / width))
    w = Window.partitionBy(*inner).orderBy("f")
    near = slim.withColumn("_c", F.sum(F.coalesce((F.col("f") - F.lag("f").over(w) > tolerance).cast("int"), F.lit(1))).over(w))
    parts = near.groupBy(*inner, "_c").agg(F.min("f").alias("lo"), F.max("f").alias("hi"))
    over = Window.partitionBy(*keys).orderBy("lo")
    chains = parts.withColumn("_g", F.sum(F.coalesce((F.col("lo") - F.lag("hi").over(over) > tolerance).cast("int"), F.lit(1))).over(over))
    named = lines.withColumn("_cell", F.floor(F.col("f") / width)).join(near, [*inner, "f"]).join(chains.select(*inner, "_c", "_g"), [*inner, "_c"])
    out = named.groupBy(*keys, "_g").agg(F.avg("f").alias("f"), F.min("f").alias("lo"), F.max("f").alias("hi"), F.array_join(F.sort_array(F.collect_set("channel")), ",").alias("channels"), F.countDistinct("hour").alias("hours"), F.max("excess").alias("excess"), F.max("mains").alias("mains"))
    return out.where(F.col("hours") >= hours).drop("_g")


def kept_groups(groups: DataFrame, keys: list[str], least_coherence: float = 0.5, share: float = 0.5) -> DataFrame:
    """groups(log_z, phase, coherence, windows) with an estimate, the coherence, and `share` of the median number of windows of the band's groups with an estimate."""
    has = groups.where(F.col("log_z").isNotNull() & ~F.isnan("log_z") & (F.abs("log_z") < float("inf")) & (F.col("windows") > 0))
    median = has.groupBy(*keys).agg(F.percentile("windows", F.lit(0.5)).alias("_w"))
    return has.join(small(median), keys).where((F.col("windows") >= share * F.col("_w")) & (F.col("coherence") >= least_coherence)).drop("_w")


def two_means(points: DataFrame, keys: list[str], tail: float = 0.1, rounds: int = 100) -> DataFrame:
    """points(id, log_z, phase) with label 0 or 1: two clusters of each key, from the means of the share of lowest and of highest phase, axes over their robust spreads; 0 began at low phase.

    All keys move in one aggregate a round, until none changes or after so many rounds. Ties go to cluster 0; equal phases are put in order by id. A key's points are its groups of windows.
    """
    level = points.groupBy(*keys).agg(F.percentile("log_z", F.lit(0.5)).alias("_mx"), F.percentile("phase", F.lit(0.5)).alias("_my"), F.count("*").alias("_n"))
    level = stash(level, "level")
    rows = points.join(small(level), keys)
    spread = rows.groupBy(*keys).agg((1.4826 * F.percentile(F.abs(F.col("log_z") - F.col("_mx")), F.lit(0.5))).alias("_sx"), (1.4826 * F.percentile(F.abs(F.col("phase") - F.col("_my")), F.lit(0.5))).alias("_sy"))
    scaled = lambda v, m, s: (F.col(v) - F.col(m)) / F.when(F.col(s) > 0, F.col(s)).otherwise(1.0)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("phase", "id"))
    k = F.greatest(F.lit(1), F.rint(tail * F.col("_n")).cast("int"))
    spread = stash(spread, "spread")
    rows = rows.join(small(spread), keys).withColumn("_x", scaled("log_z", "_mx", "_sx")).withColumn("_y", scaled("phase", "_my", "_sy")).withColumn("_r", rank).withColumn("_k", k)
    rows = stash(rows.select(*points.columns, "_x", "_y", (F.col("_r") <= F.col("_k")).alias("_low"), (F.col("_r") > F.col("_n") - F.col("_k")).alias("_high")), "points")
    means = stash(rows.groupBy(*keys).agg(*(F.avg(F.when(F.col(side), F.col(v))).alias(f"_m{i}{v}") for i, side in enumerate(("_low", "_high")) for v in ("_x", "_y"))), "means")

    def labelled(m: DataFrame) -> DataFrame:
        d = [(F.col("_x") - F.col(f"_m{i}_x")) ** 2 + (F.col("_y") - F.col(f"_m{i}_y")) ** 2 for i in (0, 1)]
        return rows.join(small(m), keys).withColumn("label", (d[1] < d[0]).cast("int"))

    for _ in range(rounds):
        held = [c for c in means.columns if c not in keys]
        new = labelled(means).groupBy(*keys).agg(*(F.coalesce(F.avg(F.when(F.col("label") == i, F.col(v))), F.first(f"_m{i}{v}")).alias(f"_m{i}{v}") for i in (0, 1) for v in ("_x", "_y")), F.max(F.struct(*held)).alias("_old"))
        moved = F.lit(False)
        for c in held:
            moved |= ~F.col(c).eqNullSafe(F.col(f"_old.{c}"))
        after = stash(new.select(*keys, *held, moved.alias("_moved")), "means")
        done = after.where("_moved").isEmpty()
        before, means = means, after.drop("_moved")
        means._stash_path = after._stash_path
        if done:
            break
        release(before)
    return labelled(means).select(*points.columns, "label")


def cluster_split(points: DataFrame, keys: list[str], least: int = 30, separation: float = 20.0, earth: float = 0.2, source: float = 30.0, mads: float = 2.0, **options) -> tuple[DataFrame, DataFrame]:
    """points with `masked` (in the source cluster of an accepted split), and keys, n, earth_phase, source_phase, separation, mad, earth_fraction, accepted.

    The Earth's cluster is the one whose median phase lies farther from zero. A split is accepted if that phase lies in 0 to 90 degrees, the source's within `source` of zero, they are `separation` degrees and more than `mads` pooled median deviations apart, and the Earth has the share `earth` of the groups; keys of fewer than `least` groups, or of one cluster, are not split.
    """
    enough = stash(points.groupBy(*keys).count().where(F.col("count") >= least).select(*keys), "enough")
    many = stash(points.join(small(enough), keys, "left_semi").select(*points.columns), "many")  # each look at the points reads this
    labelled = stash(two_means(many, keys, **options), "labels")
    release(enough, many)
    med = labelled.groupBy(*keys).agg(*(F.percentile(F.when(F.col("label") == i, F.col("phase")), F.lit(0.5)).alias(f"_p{i}") for i in (0, 1)), F.count("*").alias("n"), F.avg(F.col("label").cast("double")).alias("_one"))
    first = F.abs("_p0") >= F.abs("_p1")
    med = med.where("_p0 is not null and _p1 is not null").select(*keys, "n", "_p0", "_p1", F.when(first, 0).otherwise(1).alias("_earth"), F.when(first, F.col("_p0")).otherwise(F.col("_p1")).alias("earth_phase"), F.when(first, F.col("_p1")).otherwise(F.col("_p0")).alias("source_phase"), F.when(first, 1 - F.col("_one")).otherwise(F.col("_one")).alias("earth_fraction"))
    med = stash(med, "medians")
    own = F.when(F.col("label") == 0, F.col("_p0")).otherwise(F.col("_p1"))
    mad = labelled.join(small(med), keys).groupBy(*keys).agg(F.percentile(F.abs(F.col("phase") - own), F.lit(0.5)).alias("mad"))
    apart = F.abs(F.col("earth_phase") - F.col("source_phase"))
    good = F.col("earth_phase").between(0, 90) & (F.abs("source_phase") <= source) & (apart >= separation) & (apart > mads * F.col("mad")) & (F.col("earth_fraction") >= earth)
    split = stash(med.join(mad, keys).select(*keys, "n", "earth_phase", "source_phase", apart.alias("separation"), "mad", "earth_fraction", good.alias("accepted"), "_earth"), "split")
    marked = points.join(labelled.select(*keys, "id", "label").join(small(split), keys).where("accepted and label <> _earth").select(*keys, "id", F.lit(True).alias("masked")), [*keys, "id"], "left").withColumn("masked", F.coalesce("masked", F.lit(False)))
    return marked, split.drop("_earth")


def responses(stages: DataFrame, keys: list[str], wanted: DataFrame, f: str = "f") -> DataFrame:
    """keys, f, re, im: the response of each key's chain of stages at the frequencies of wanted(keys, f).

    stages(keys, stage, f, re, im) are tables of each stage's response, joined by straight lines over log frequency, in parts, and held beyond their ends; one point makes a stage the same at all frequencies. A chain is the product of its stages. Tables and wanted frequencies are short.
    """
    own = [*keys, "stage"]
    each = stages.select(*own).distinct().join(wanted.select(*keys, F.col(f).alias("f")).distinct(), keys).select(*own, "f")
    both = stages.select(*own, "f", "re", "im").unionByName(each.withColumn("re", F.lit(None).cast("double")).withColumn("im", F.lit(None).cast("double")))
    known = F.when(F.col("re").isNotNull(), F.struct("f", "re", "im"))
    w = Window.partitionBy(*own).orderBy("f")
    rows = both.withColumn("_p", F.last(known, True).over(w.rangeBetween(Window.unboundedPreceding, 0))).withColumn("_q", F.first(known, True).over(w.rangeBetween(0, Window.unboundedFollowing))).where("re is null")
    share = (F.log("f") - F.log("_p.f")) / F.nullif(F.log("_q.f") - F.log("_p.f"), F.lit(0.0))
    part = lambda c: F.coalesce(F.col(f"_p.{c}") + F.coalesce(share, F.lit(0.0)) * (F.col(f"_q.{c}") - F.col(f"_p.{c}")), F.col(f"_p.{c}"), F.col(f"_q.{c}"))
    at = rows.select(*own, "f", part("re").alias("re"), part("im").alias("im"))
    size, angle = F.log(F.sqrt(F.col("re") ** 2 + F.col("im") ** 2)), F.atan2("im", "re")
    whole = at.groupBy(*keys, "f").agg(F.exp(F.sum(size)).alias("_s"), F.sum(angle).alias("_a"))
    return whole.select(*keys, "f", (F.col("_s") * F.cos("_a")).alias("re"), (F.col("_s") * F.sin("_a")).alias("im"))


def calibrated(spectra: DataFrame, chains: DataFrame, keys: list[str]) -> DataFrame:
    """spectra(keys, f, re, im) over the chains' responses of their key and frequency; those without a chain stay."""
    r = chains.select(*keys, "f", F.col("re").alias("_re"), F.col("im").alias("_im"))
    both = spectra.join(small(r), [*keys, "f"], "left")
    z = cx.div((F.col("re"), F.col("im")), (F.col("_re"), F.col("_im")))
    return both.select(*(F.when(F.col("_re").isNull(), F.col(c)).otherwise(z[("re", "im").index(c)]).alias(c) if c in ("re", "im") else F.col(c) for c in spectra.columns))


def aligned(short: DataFrame, long: DataFrame, keys: list[str], band: tuple[float, float], sigma: float = 0.1) -> DataFrame:
    """short(keys, period, re, im, err) times the factor that brings it to long(keys, period, re, im), with n, the common periods: at each of the long product's periods in the band and within the short one's, the ratio's log modulus and phase difference (in -180 to 180 degrees), the short product read between its periods along straight lines over log period; the factor at a period is their mean, weighted by a Gaussian of `sigma` decades. Keys with fewer than two common periods are left out. A product's periods are few.
    """
    turn = 2 * math.pi
    w = Window.partitionBy(*keys).orderBy("period")

    def polar(rows: DataFrame) -> DataFrame:
        p = rows.where((F.col("re") != 0) | (F.col("im") != 0)).select(*keys, "period", F.log10(F.sqrt(F.col("re") ** 2 + F.col("im") ** 2)).alias("a"), F.atan2("im", "re").alias("_t"))
        d = F.col("_t") - F.lag("_t").over(w)
        return p.withColumn("_d", F.coalesce(-turn * F.rint(d / turn), F.lit(0.0))).withColumn("t", F.col("_t") + F.sum("_d").over(w)).select(*keys, "period", "a", "t")

    s = polar(short)
    pieces = s.select(*keys, F.log10("period").alias("x0"), "a", "t", F.lead(F.log10("period")).over(w).alias("x1"), F.lead("a").over(w).alias("a1"), F.lead("t").over(w).alias("t1")).where("x1 is not null")
    wanted = polar(long).where((F.col("period") >= band[0] * (1 - 1e-9)) & (F.col("period") <= band[1] * (1 + 1e-9))).select(*keys, F.log10("period").alias("x"), F.col("a").alias("la"), F.col("t").alias("lt"))
    both = wanted.join(pieces, keys).where((F.col("x") >= F.col("x0")) & (F.col("x") <= F.col("x1")))
    both = both.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "x").orderBy("x0"))).where("_r = 1")
    share = (F.col("x") - F.col("x0")) / (F.col("x1") - F.col("x0"))
    dt = F.col("lt") - (F.col("t") + share * (F.col("t1") - F.col("t")))
    points = both.select(*keys, "x", (F.col("la") - (F.col("a") + share * (F.col("a1") - F.col("a")))).alias("da"), (F.pmod(dt + math.pi, F.lit(turn)) - math.pi).alias("dt"))
    held = points.groupBy(*keys).agg(F.collect_list(F.struct("x", "da", "dt")).alias("_p"), F.count("*").alias("n")).where("n >= 2")
    out = short.join(small(held), keys)
    g = lambda p: F.exp(-0.5 * ((F.log10("period") - p["x"]) / sigma) ** 2)
    total = lambda v: F.aggregate("_p", F.lit(0.0), lambda acc, p: acc + g(p) * v(p))
    out = out.withColumn("_w", total(lambda p: F.lit(1.0))).withColumn("_l", F.pow(F.lit(10.0), total(lambda p: p["da"]) / F.col("_w"))).withColumn("_t", total(lambda p: p["dt"]) / F.col("_w"))
    z = cx.mul((F.col("re"), F.col("im")), (F.col("_l") * F.cos("_t"), F.col("_l") * F.sin("_t")))
    return out.select(*(z[("re", "im").index(c)].alias(c) if c in ("re", "im") else (F.col("err") * F.col("_l")).alias("err") if c == "err" else F.col(c) for c in short.columns), "n")


def windows_spliced(short: DataFrame, long: DataFrame, keys: list[str], band: tuple[float, float], sigma: float = 0.1, tolerance: float = 1e-3) -> DataFrame:
    """keys, period, re, im, err, source: the long product from its first period on, the aligned short one below it."""
    first = long.groupBy(*keys).agg(F.min("period").alias("_first"))
    below = aligned(short, long, keys, band, sigma).drop("n").join(small(first), keys).where(F.col("period") < F.col("_first") * 10 ** (-2 * tolerance)).drop("_first")
    return below.withColumn("source", F.lit("short")).unionByName(long.select(*below.columns).withColumn("source", F.lit("long")))

