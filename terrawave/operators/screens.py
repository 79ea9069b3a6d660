"""Screens of records: bursts of the electric lines, hours in which lines and fields agree, the masks that both make, members
of the wrong sign in a stack, changes of membership, and the period of a cycle."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from terrawave.operators import intervals, order, recursive, stacks, welch
from terrawave.operators.blocks import BLOCK, ends, over_blocks, packed
from terrawave.operators.filters import decimated
from terrawave.session import small, stash

LINES = (("hx", "ey"), ("hy", "ex"), ("hx", "ex"), ("hy", "ey"), ("ex", "ey"), ("hx", "hy"))


def steps(rows: DataFrame, keys: list[str], channels: list[str], block: int = BLOCK, k: str = "k") -> DataFrame:
    """keys, k, channels: the size of each channel's step from the sample before, on every place of the grid from a key's first sample to its last; 0 where one of the two is missing. One shuffle of the samples."""
    lo, hi = F.col("lo"), F.col("hi")
    cells = ends(rows, keys, k).select(*keys, "lo", "hi", F.explode(F.sequence(F.floor(lo / block), F.floor((hi - 1) / block))).alias("_cell"))
    grid = cells.select(*keys, F.explode(F.sequence(F.greatest(lo, F.col("_cell") * block), F.least(hi, (F.col("_cell") + 1) * block) - 1)).alias("_k"), F.lit(True).alias("_on"))
    slim = rows.select(*keys, F.col(k).cast("long").alias("_k"), *(F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in channels))
    now = slim.select(*keys, "_k", *(F.col(c).alias(f"_now_{c}") for c in channels))
    then = slim.select(*keys, (F.col("_k") + 1).alias("_k"), *(F.col(c).alias(f"_then_{c}") for c in channels))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [grid, now, then])
    at = both.groupBy(*keys, "_k").agg(F.max("_on").alias("_on"), *(F.max(f"_{side}_{c}").alias(f"_{side}_{c}") for side in ("now", "then") for c in channels))
    return at.where("_on").select(*keys, F.col("_k").alias(k), *(F.coalesce(F.abs(F.col(f"_now_{c}") - F.col(f"_then_{c}")), F.lit(0.0)).alias(c) for c in channels))


def _mirrored(width: int):
    """Mean over `width` samples about each one, the series being mirrored at its ends."""
    half = width // 2

    def run(at, arrays, lo, hi):
        n = hi - lo
        i = (at[:, None] + np.arange(-half, width - half)[None, :] - lo) % (2 * n)
        i = np.where(i >= n, 2 * n - 1 - i, i) + lo - at[0]
        # Places outside belong to samples of neighbouring blocks.
        return (arrays["_d"][np.clip(i, 0, len(at) - 1)].mean(axis=1),)

    return run


def burst_levels(rows: DataFrame, keys: list[str], channels: list[str], width: int = 30, block: int = BLOCK, k: str = "k") -> DataFrame:
    """keys, k, level: the larger of the channels' steps, each over the median of its steps that are not 0, as a mean over `width` samples. A channel without a step has none of its own. Written once."""
    s = stash(steps(rows, keys, channels, block, k), "steps")
    long = s.unpivot([*keys, k], channels, "_channel", "_d").where("_d > 0")
    median = order.percentile(long, [*keys, "_channel"], "_d").groupBy(*keys).pivot("_channel", channels).agg(F.first("value"))
    scaled = s.join(small(median.select(*keys, *(F.col(c).alias(f"_m_{c}") for c in channels))), keys, "left")
    parts = [F.col(c) / F.greatest(F.coalesce(F.col(f"_m_{c}"), F.lit(1.0)), F.lit(1e-30)) for c in channels]
    d = scaled.select(*keys, k, (F.greatest(*parts) if len(parts) > 1 else parts[0]).alias("_d"))
    return stash(over_blocks(d, keys, ["_d"], _mirrored(width), ["level"], block, width, width, k), "levels")


def burst_spans(levels: DataFrame, keys: list[str], factor: float = 3.0, around: int = 60, k: str = "k") -> DataFrame:
    """keys, a, b: stretches on which the level is over `factor` times its median over the whole record, widened to both sides within the record and merged."""
    middle = order.percentile(levels, keys, "level", name="_m")
    over = levels.join(small(middle), keys).where(F.col("level") > factor * F.col("_m"))
    wide = intervals.islands(over, keys, k).join(small(ends(levels, keys, k)), keys)
    return intervals.union(wide.select(*keys, F.greatest(F.col("a") - around, "lo").alias("a"), F.least(F.col("b") + around, "hi").alias("b")), keys)


def all_band_masks(spans: DataFrame, reason: str, origin: str) -> DataFrame:
    """Spans as local masks of all bands."""
    none = F.lit(None).cast("double")
    return spans.where("b > a").select("*", none.alias("pmin"), none.alias("pmax"), F.lit("local").alias("scope"), F.lit(reason).alias("reason"), F.lit(origin).alias("found_by"))


def pair_coherence(rows: DataFrame, keys: list[str], pairs: list[tuple[str, str]], rate: float, window: int, step: int, segment: int, shortest: float, longest: float, per_decade: int = 8, k: str = "k") -> DataFrame:
    """keys, w, and a column <a>_<b> for each pair: coherence of whole windows, the mean over the harmonics of a bin of period and of these over the bins. Windows that lack a sample are left out.

    One pass makes the spectra of all pairs. window is a multiple of step, so that samples are counted by steps.
    """
    if window % step:
        raise ValueError("the window is a multiple of the step")
    channels = sorted({c for p in pairs for c in p})
    there = rows.select(*keys, F.col(k).alias("k"), *(F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in channels))
    spec = welch.window_spectra(there, keys, channels, pairs, rate, window, step, segment)
    names = [*(f"psd_{c}" for c in channels), *(f"csd_{a}_{b}_{p}" for a, b in pairs for p in ("re", "im"))]
    f = welch.by_frequency(spec, keys, names, rate, segment).withColumn("_bin", welch.log_bin(F.col("f"), shortest, longest, per_decade)).where("_bin is not null")
    bins = f.groupBy(*keys, "w", "_bin").agg(*(F.avg(welch.coherence(a, b)).alias(f"{a}_{b}") for a, b in pairs))
    means = bins.groupBy(*keys, "w").agg(*(F.avg(f"{a}_{b}").alias(f"{a}_{b}") for a, b in pairs))
    first = ends(there, keys).select(*keys, F.col("lo").alias("_lo"))
    cells = there.dropna(subset=channels).join(small(first), keys).groupBy(*keys, F.floor((F.col("k") - F.col("_lo")) / step).alias("_cell")).agg(F.count("*").alias("_n"))
    counts = cells.select(*keys, F.explode(F.sequence(F.col("_cell") - (window // step - 1), F.col("_cell"))).alias("w"), "_n").groupBy(*keys, "w").agg(F.sum("_n").alias("_n"))
    return means.join(counts.where(F.col("_n") == window).drop("_n"), [*keys, "w"])


def line_series(rows: DataFrame, keys: list[str], rate: float, window: int, step: int, segment: int, shortest: float = 20.0, longest: float = 200.0, per_decade: int = 8, agree: float = 0.5, margin: float = 0.15, k: str = "k") -> DataFrame:
    """keys, w, xy, yx, swapped: coherence of each electric line with its magnetic partner, in the windows that are whole in all four channels.

    Lines are exchanged (swapped) where each agrees, in a larger share of the windows by the margin, with the other's partner; each is then read with that. The fields are taken as they come: turn them first.
    """
    c = stash(pair_coherence(rows, keys, list(LINES), rate, window, step, segment, shortest, longest, per_decade, k), "pairs")
    share = {f"{a}_{b}": F.avg((F.col(f"{a}_{b}") > agree).cast("double")) for a, b in LINES[:4]}
    verdict = c.groupBy(*keys).agg(*(v.alias(n) for n, v in share.items()))
    verdict = verdict.select(*keys, ((F.col("hx_ex") > F.col("hx_ey") + margin) & (F.col("hy_ey") > F.col("hy_ex") + margin)).alias("swapped"))
    return c.join(small(verdict), keys).select(*keys, "w", F.when(F.col("swapped"), F.col("hx_ex")).otherwise(F.col("hy_ex")).alias("xy"), F.when(F.col("swapped"), F.col("hy_ey")).otherwise(F.col("hx_ey")).alias("yx"), "swapped")


def kept_slots(series: DataFrame, keys: list[str], value: str, threshold: float, window: int, step: int, grain: int) -> DataFrame:
    """keys, slot, kept: slots of `grain` samples that whole windows cover, kept where one of these is over the threshold. Only windows that begin on a slot count."""
    if window % grain:
        raise ValueError("a window holds whole slots")
    start = F.col("w") * step
    on = series.where(start % grain == 0)
    first = F.floor(start / grain)
    slots = on.select(*keys, F.explode(F.sequence(first, first + (window // grain - 1))).alias("slot"), (F.col(value) > threshold).alias("_good"))
    return slots.groupBy(*keys, "slot").agg(F.coalesce(F.max("_good"), F.lit(False)).alias("kept"))


def stretch_masks(slots: DataFrame, keys: list[str], records: DataFrame, grain: int, channel: str, longest: float) -> DataFrame:
    """keys, a, b, pmin, pmax, channel, scope, found_by: masks of one electric channel, for the bands up to the longest period, on what the kept slots leave of records(keys, lo, hi); slot 0 begins at lo."""
    runs = intervals.islands(slots.where("kept"), keys, "slot").join(small(records.select(*keys, F.col("lo").alias("_lo"))), keys)
    at = runs.select(*keys, (F.col("_lo") + F.col("a") * grain).alias("a"), (F.col("_lo") + F.col("b") * grain).alias("b"))
    out = intervals.complement(at, keys, records)
    return out.select(*keys, "a", "b", F.lit(0.0).alias("pmin"), F.lit(longest).alias("pmax"), F.lit(channel).alias("channel"), F.lit("local").alias("scope"), F.lit("stretch").alias("found_by"))


def polarity(spectra: DataFrame, keys: list[str], member: str = "member", reject: float = stacks.REJECT, w: str = "w", h: str = "h") -> DataFrame:
    """keys, member, correlation: real correlation of a member's spectra with the mean of the others' kept in the same window, each over its scale. The others' sum is the total less the member's own; windows that keep one member alone don't count."""
    spectra = stash(spectra.select(*keys, member, w, h, "re", "im"), "spectra")  # read for the powers and again for what is kept
    kept = stacks.kept_members(spectra, keys, member, reject, w).where("kept").select(*keys, member, w, "scale")
    scaled = spectra.join(kept, [*keys, member, w]).select(*keys, member, w, h, (F.col("re") / F.col("scale")).alias("_re"), (F.col("im") / F.col("scale")).alias("_im"))
    scaled = stash(scaled, "scaled")
    # A window's members are many: their sums meet, not their rows.
    total = scaled.groupBy(*keys, w, h).agg(F.count("*").alias("_n"), F.sum("_re").alias("_re_o"), F.sum("_im").alias("_im_o")).where("_n > 1")
    others = scaled.join(small(stash(total, "total")), [*keys, w, h]).select(*keys, member, "_re", "_im", "_n", *((F.col(f"{c}_o") - F.col(c)).alias(f"{c}_o") for c in ("_re", "_im")))
    o_re, o_im = F.col("_re_o") / (F.col("_n") - 1), F.col("_im_o") / (F.col("_n") - 1)
    sums = others.groupBy(*keys, member).agg(F.sum(F.col("_re") * o_re + F.col("_im") * o_im).alias("_c"), F.sum(F.col("_re") ** 2 + F.col("_im") ** 2).alias("_a"), F.sum(o_re**2 + o_im**2).alias("_b"))
    return sums.where("_a > 0 and _b > 0").select(*keys, member, (F.col("_c") / F.sqrt(F.col("_a") * F.col("_b"))).alias("correlation"))


def polarity_summary(bands: DataFrame, members: DataFrame, keys: list[str], shortest: float = 1.0, longest: float = 100.0) -> DataFrame:
    """keys of members, correlation, bands, flagged: the median over the bands of these periods; flagged if below 0. A member without a band has none."""
    inside = bands.where(F.col("period").between(shortest * (1 - 1e-9), longest * (1 + 1e-9)))
    got = inside.groupBy(*keys).agg(F.percentile("correlation", F.lit(0.5)).alias("correlation"), F.count("correlation").alias("bands"))
    return members.select(*keys).distinct().join(got, keys, "left").select(*keys, "correlation", F.coalesce("bands", F.lit(0)).alias("bands"), F.coalesce(F.col("correlation") < 0, F.lit(False)).alias("flagged"))


def membership_changes(runs: DataFrame, keys: list[str], windows: DataFrame, edge: int) -> DataFrame:
    """keys, change, at: where a member's record, its runs merged over gaps up to `edge`, starts or ends more than `edge` inside the window(keys, lo, hi)."""
    spans = intervals.union(runs, keys, edge)
    both = spans.select(*keys, F.explode(F.array(F.struct(F.lit("starts").alias("change"), F.col("a").alias("at")), F.struct(F.lit("ends").alias("change"), F.col("b").alias("at")))).alias("_c"))
    return both.select(*keys, "_c.change", "_c.at").join(small(windows), keys).where(F.col("at").between(F.col("lo") + edge + 1, F.col("hi") - edge - 1)).select(*keys, "change", "at")


def layout(rows: DataFrame, period: str = "period", same: float = 1e-9, other: float = 0.1) -> DataFrame:
    """cell, first, last, point, clash: periods of all rows by cells of log period, each a tenth wide, with the point of the lattice that the cell's shortest belongs to; clash where two periods are neither the same nor a tenth apart.

    A cell holds one point at most, and a double's range has some 14,000 cells, which is what meets in one order.
    """
    width = -float(np.log1p(-other))
    cells = rows.where(F.col(period) > 0).groupBy(F.floor(F.log(period) / width).alias("cell")).agg(F.min(period).alias("first"), F.max(period).alias("last"))
    w = Window.orderBy("cell")
    before = F.lag("first").over(w)
    joins = (F.col("first") - before) / F.col("first") <= same
    c = cells.select("*", F.when(joins, before).otherwise(F.col("first")).alias("point"), before.alias("_before"))
    gap = (F.col("first") - F.col("_before")) / F.col("first")
    inside = (F.col("last") - F.col("point")) / F.col("last") > same
    return c.select("cell", "first", "last", "point", (inside | F.coalesce((gap > same) & (gap < other * (1 - 1e-12)), F.lit(False))).alias("clash"))


def equations(rows: DataFrame, lattice: DataFrame, angle: str, error: str, used: str, missing: str, leave_out: list[str], period: str = "period", other: float = 0.1) -> DataFrame:
    """rows with their lattice period, entered, and the first reason against them: not_estimated, no_error, use=false, then the flags named, in their order.

    lattice comes from `layout`; a row's period lies in one of its cells.
    """
    width = -float(np.log1p(-other))
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    reason = F.when(F.coalesce(F.col(missing), F.lit(True)) | ~finite(angle), "not_estimated").when(~(finite(error) & (F.col(error) > 0)), "no_error").when(~F.coalesce(F.col(used), F.lit(True)), "use=false")
    for name in leave_out:
        reason = reason.when(F.col(name), f"flag:{name}")
    at = rows.withColumn("_cell", F.floor(F.log(period) / width)).join(F.broadcast(lattice.select(F.col("cell").alias("_cell"), F.col("point").alias("lattice_period"))), "_cell", "left").drop("_cell")
    return at.withColumn("reason", reason.otherwise("")).withColumn("entered", F.col("reason") == "")


def cycle_period(rows: DataFrame, keys: list[str], x: str, rate: float, nominal: float, cycles: int = 50, within: float = 0.005, block: int = BLOCK, k: str = "k") -> DataFrame:
    """keys, period: the nominal period moved to the peak of the autocorrelation `cycles` periods out, on a parabola through the peak and its neighbours. Missing samples count as 0.

    Blocks reach as far as the longest lag and give a sum for each lag.
    """
    lag0 = round(cycles * nominal * rate)
    span = max(2, round(within * rate * cycles))
    lags = np.arange(lag0 - span, lag0 + span + 1)
    if lags[0] < 1:
        raise ValueError("the lags reach 0")
    held = packed(rows.select(*keys, F.col(k).alias(k), F.coalesce(F.nanvl(F.col(x).cast("double"), F.lit(0.0)), F.lit(0.0)).alias("_x")), keys, ["_x"], block, after=int(lags[-1]), k=k)
    schema = held.select(*keys).schema.add("lag", LongType()).add("ac", DoubleType())

    def run(batches):
        for batch in batches:
            out = {c: [] for c in schema.names}
            for row in batch.to_dict("records"):
                first = row["_block"] * block
                at = np.asarray(row["_k"], np.int64) - first
                d = np.zeros(block + lags[-1])
                d[at] = row["_x"]
                for lag in lags:
                    for key in keys:
                        out[key].append(row[key])
                    out["lag"].append(int(lag))
                    out["ac"].append(float(d[:block] @ d[lag : lag + block]))
            yield pd.DataFrame(out)

    sums = held.mapInPandas(run, schema).groupBy(*keys, "lag").agg(F.sum("ac").alias("ac"))
    return _peak(sums, keys, rate, cycles)


def _peak(sums: DataFrame, keys: list[str], rate: float, cycles: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("lag")  # a row for each lag
    near = sums.select(*keys, "lag", "ac", F.lag("ac").over(w).alias("_l"), F.lead("ac").over(w).alias("_r"))
    top = near.groupBy(*keys).agg(F.max_by(F.struct("lag", "ac", "_l", "_r"), F.struct("ac", -F.col("lag"))).alias("_p"))
    y0, y1, y2 = F.col("_p._l"), F.col("_p.ac"), F.col("_p._r")
    shift = F.coalesce(0.5 * (y0 - y2) / F.nullif(y0 - 2 * y1 + y2, F.lit(0.0)), F.lit(0.0))
    return top.select(*keys, ((F.col("_p.lag") + shift) / rate / cycles).alias("period"))


def refined_period(rows: DataFrame, keys: list[str], x: str, rate: float, nominal: float, cycles: int = 50, factor: int = 10, band: tuple[float, float] = (0.005, 5.0), block: int = BLOCK, k: str = "k") -> DataFrame:
    """`cycle_period` of a series without its median, filtered to the band forward and back, and brought to a rate `factor` times less. All of the record is used."""
    middle = order.percentile(rows, keys, x, name="_m")
    level = rows.join(small(middle), keys).select(*keys, F.col(k).alias("k"), (F.col(x) - F.col("_m")).alias("x"))
    passed = recursive.filtered(level, keys, "x", rate, list(band), "band", order=2, block=block)
    fewer = decimated(passed, keys, factor) if factor > 1 else passed
    return cycle_period(fewer, keys, "x", rate / factor, nominal, cycles, block=block)
