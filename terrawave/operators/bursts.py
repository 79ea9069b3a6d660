"""Local levels, burst ratios and despiking of long series. Medians are those of short blocks, each found for itself; blocks meet their neighbours by equality of number, so no series is put in order as a whole."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrawave.operators.blocks import BLOCK, ends, over_blocks
from terrawave.session import small, stash


def block_medians(rows: DataFrame, keys: list[str], x: str, size: int, k: str = "k") -> DataFrame:
    """keys, _c, v, centre: the median of each block of so many samples, counted from the key's first one; the last may be shorter."""
    cut = rows.join(small(ends(rows, keys, k)), keys).withColumn("_c", F.floor((F.col(k) - F.col("lo")) / size))
    first = F.col("lo") + F.col("_c") * size
    return cut.groupBy(*keys, "lo", "hi", "_c").agg(F.percentile(x, F.lit(0.5)).alias("v")).select(*keys, "_c", "v", ((first + F.least(first + size, "hi") - 1) / 2).alias("centre"), "lo")


def with_level(rows: DataFrame, keys: list[str], x: str, size: int, name: str = "level", k: str = "k") -> DataFrame:
    """rows with the local level: block medians joined by straight lines between the blocks' centres, flat beyond the first and last."""
    # Tables read by several joins are written once; none of them is broadcast, as files are packed and look small.
    m = stash(block_medians(rows, keys, x, size, k), "medians")
    before = m.select(*keys, (F.col("_c") + 1).alias("_c"), F.col("v").alias("_pv"), F.col("centre").alias("_pc"))
    after = m.select(*keys, (F.col("_c") - 1).alias("_c"), F.col("v").alias("_nv"), F.col("centre").alias("_nc"))
    known = m.join(before.hint("merge"), [*keys, "_c"], "left").join(after.hint("merge"), [*keys, "_c"], "left")
    at = rows.join(small(ends(rows, keys, k).select(*keys, F.col("lo").alias("_lo"))), keys).withColumn("_c", F.floor((F.col(k) - F.col("_lo")) / size))
    both = at.hint("merge").join(known.drop("lo").hint("merge"), [*keys, "_c"])
    rising = F.col("_pv") + (F.col("v") - F.col("_pv")) * (F.col(k) - F.col("_pc")) / (F.col("centre") - F.col("_pc"))
    falling = F.col("v") + (F.col("_nv") - F.col("v")) * (F.col(k) - F.col("centre")) / (F.col("_nc") - F.col("centre"))
    level = F.when(F.col(k) < F.col("centre"), F.coalesce(rising, "v")).otherwise(F.coalesce(falling, "v"))
    return both.select(*rows.columns, level.alias(name))


def moving_mean(rows: DataFrame, keys: list[str], x: str, width: int, name: str, block: int = BLOCK, k: str = "k") -> DataFrame:
    """keys, k, and the mean of x over `width` samples about each one; beyond the ends the first and last one are repeated. For series without gaps."""
    half = width // 2
    cells = F.explode(F.sequence(F.floor((F.col(k) - half) / block), F.floor((F.col(k) + half) / block))).alias("_cell")
    dealt = rows.select(*keys, k, x, cells)
    w = Window.partitionBy(*keys, "_cell").orderBy(k)
    frame = w.rowsBetween(-half, width - 1 - half)
    here = dealt.select(*keys, k, "_cell", F.sum(x).over(frame).alias("_s"), F.count("*").over(w.rowsBetween(-half, -1)).alias("_l") if half else F.lit(0).alias("_l"), F.count("*").over(w.rowsBetween(0, width - 1 - half)).alias("_r"), F.first(x).over(frame).alias("_a"), F.last(x).over(frame).alias("_b"))
    mean = (F.col("_s") + (half - F.col("_l")) * F.col("_a") + (width - half - F.col("_r")) * F.col("_b")) / width
    return here.where(F.col("_cell") == F.floor(F.col(k) / block)).select(*keys, k, mean.alias(name))


def samples_of(rate: float, least: float = 0.05, level: float = 1.0, scale: float = 60.0) -> dict[str, int]:
    """The widths in samples of `burst_ratio`, from seconds: of the mean, of a block, and of half the run of blocks."""
    return {"width": max(1, round(least * rate)), "size": max(8, round(level * rate)), "half": round(scale / level) // 2}


def _middles(sorted_rows: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Medians of the first n values of each row; not a number where there are none."""
    i, low = np.arange(len(n)), np.maximum(n - 1, 0) // 2
    return np.where(n > 0, 0.5 * sorted_rows[i, low] + 0.5 * sorted_rows[i, np.minimum(n // 2, sorted_rows.shape[1] - 1)], np.nan)


def _by_block(c: np.ndarray, x: np.ndarray, count: int, size: int) -> np.ndarray:
    """Medians of the values of each block 0 to count - 1; c are the blocks of the values, in order."""
    there = ~np.isnan(x)
    order = np.lexsort((x[there], c[there]))
    c, x = c[there][order], x[there][order]
    n = np.bincount(c, minlength=count)
    table = np.full((count, max(size, n.max(initial=1))), np.nan)
    table[c, np.arange(len(c)) - (np.cumsum(n) - n)[c]] = x
    return _middles(table, n)


def _ratios(x: str, width: int, size: int, half: int):
    """The ratios of a block's samples and those around it."""

    def run(at, arrays, lo, hi):
        v, c = arrays[x], (at - lo) // size
        base, count = c[0] - 1, int(c[-1] - c[0]) + 3
        c = c - base
        first = lo + (np.arange(count) + base) * size
        centre, middle = (first + np.minimum(first + size, hi) - 1) / 2, _by_block(c, v, count, size)
        there = np.bincount(c, minlength=count) > 0

        def line(a, b):
            return middle[a] + (middle[b] - middle[a]) * (at - centre[a]) / (centre[b] - centre[a])

        before = at < centre[c]
        joined = np.where(before, line(c - 1, c), line(c, c + 1))
        joined = np.where(there[np.where(before, c - 1, c + 1)] & ~np.isnan(joined), joined, middle[c])
        d = np.abs(v - joined)
        near = np.pad(d, (width // 2, width - 1 - width // 2), mode="edge")
        lost = np.isnan(near)
        frames = np.lib.stride_tricks.sliding_window_view(np.where(lost, 0.0, near), width)
        mean = np.where(lost[: len(d)] | lost[width - 1 :], np.nan, frames.sum(axis=1) / width)
        spread = _by_block(c, d, count, size)
        spread = np.pad(np.where(spread > 0, spread, np.nan), half, constant_values=np.nan)
        around = np.sort(np.lib.stride_tricks.sliding_window_view(spread, 2 * half + 1), axis=1)
        ratio = mean / _middles(around, (~np.isnan(around)).sum(axis=1))[c]
        return (np.where(np.isnan(ratio), 0.0, ratio),)

    return run


def burst_ratio(rows: DataFrame, keys: list[str], x: str, width: int, size: int, half: int, block: int = BLOCK, k: str = "k") -> DataFrame:
    """keys, k, ratio: the mean distance of x from its local level over `width` samples, over the median of the blocks' own median distances among the `half` blocks to either side. Blocks whose distance is 0 are left out; where no other is near, the ratio is 0. A sample that is null or not a number is left out of the medians.

    Samples are shuffled once, in blocks with the few that lie around them.
    """
    around = (half + 2) * size + width
    return over_blocks(rows, keys, [x], _ratios(x, width, size, half), ["ratio"], block, around, around, k)


def despiked(rows: DataFrame, keys: list[str], x: str, sigmas: float, around: int, block: int = BLOCK, k: str = "k") -> DataFrame:
    """rows without the samples from `around` before to `around` after a step to a sample of more than so many robust scales of all steps of the key. A step is from the sample before on the grid."""
    slim = rows.select(*keys, k, x)
    before = slim.select(*keys, (F.col(k) + 1).alias(k), F.col(x).alias("_before"))
    steps = slim.join(before, [*keys, k]).select(*keys, k, F.abs(F.col(x) - F.col("_before")).alias("_step"))
    scale = steps.groupBy(*keys).agg((1.4826 * F.percentile_approx("_step", F.lit(0.5), F.lit(1_000_000))).alias("_scale"))
    bad = steps.join(small(scale), keys).where(F.round("_step", 9) > F.round(sigmas * F.col("_scale"), 9))
    gone = bad.select(*keys, F.explode(F.sequence(F.col(k) - around, F.col(k) + around)).alias(k)).distinct()
    return rows.join(gone, [*keys, k], "left_anti")


def any_louder(ratios: list[DataFrame], keys: list[str], threshold: float, k: str = "k") -> DataFrame:
    """keys, k, loud: whether a burst ratio of any reference is over the threshold."""
    out = ratios[0]
    for r in ratios[1:]:
        out = out.unionByName(r)
    return out.groupBy(*keys, k).agg((F.max("ratio") > threshold).alias("loud"))

