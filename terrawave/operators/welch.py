"""Welch spectra in sliding windows and over whole records, on a ladder of coarser levels, and their stitching on one grid of times.

A task gets a block of many windows with the samples that its last one reaches into, and cuts windows and segments there;
a sample is sent to one block or two. Sums over a whole record are sums of those of blocks.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructType

from terrawave.operators.blocks import by_slices, ends, packed
from terrawave.operators.filters import decimated
from terrawave.operators.spectra import hann
from terrawave.session import small, stash

LEAST = 4  # segments of a window
MOST = 512
SAMPLES = 1 << 18  # of a block


def levels_plan(rate: float, record: float, window: float = 1200.0, step: float = 600.0, shortest: float = 0.01, longest: float = 1000.0, segment: int = 1024, factor: int = 4, segments: int = 8, windows: int = 3) -> list[dict]:
    """A row for each level: rate, samples of a segment, seconds of segment, window and step, numbers of segments and windows, and the periods it is for.

    A level takes the periods from where the one before ends to its own segment's length. Where the window holds too few segments it grows, and the step with it; the ladder ends at the longest period, or before a level whose window fits too few times into the record.
    """
    out: list[dict] = []
    low = shortest
    for level in range(32):
        at = rate / factor**level
        length = segment / at
        high = min(length, longest)
        if low >= high:
            break
        need = (segments + 1) / 2 * length
        wide, hop = (window, step) if need <= window else (need, max(step, length / 2))
        n = int((record - wide) // hop) + 1 if record >= wide else 0
        if n < windows:
            break
        out.append({"level": level, "rate": at, "segment": segment, "segment_s": length, "window_s": wide, "step_s": hop, "segments": int(2 * wide / length) - 1, "windows": n, "from_s": low, "to_s": high})
        if high >= longest:
            break
        low = high
    if not out:
        raise ValueError("the record is shorter than its windows need")
    return out


def segment_starts(window: int, segment: int, most: int = MOST) -> np.ndarray:
    """Starts of the segments of a window, half a segment apart, thinned evenly to so many."""
    starts = np.arange(0, window - segment + 1, segment // 2)
    if len(starts) > most:
        starts = starts[np.round(np.linspace(0, len(starts) - 1, most)).astype(int)]
    return starts


def density(segment: int, rate: float) -> np.ndarray:
    """What makes a one-sided density of the squared transform of a tapered segment."""
    scale = np.full(segment // 2 + 1, 2.0)
    scale[0] = 1.0
    if segment % 2 == 0:
        scale[-1] = 1.0
    return scale / (rate * (hann(segment) ** 2).sum())


def _transforms(x: np.ndarray, starts: np.ndarray, segment: int) -> np.ndarray:
    parts = np.lib.stride_tricks.sliding_window_view(x, segment)[starts]
    return np.fft.rfft((parts - parts.mean(axis=1, keepdims=True)) * hann(segment), axis=1)


def _whole(there: np.ndarray, length: int) -> np.ndarray:
    """Whether the stretch of so many samples from each place on has no gap."""
    sums = np.concatenate(([0], np.cumsum(there)))
    return sums[length:] - sums[:-length] == length


def _laid(row: dict, channels: list[str], first: int, size: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    at = np.asarray(row["_k"], np.int64) - first
    inside = (at >= 0) & (at < size)
    there = np.zeros(size, bool)
    series = {}
    for c in channels:
        series[c] = np.zeros(size)
        series[c][at[inside]] = np.asarray(row[c], float)[inside]
    there[at[inside]] = True
    return there, series


def window_spectra(rows: DataFrame, keys: list[str], channels: list[str], pairs: list[tuple[str, str]], rate: float, window: int, step: int, segment: int, most: int = MOST, k: str = "k") -> DataFrame:
    """keys, w, t, segments, and by frequency the arrays psd_<channel> and csd_<a>_<b>_re, _im (of conj(a) b): means over the segments without a gap of each window within the record.

    w counts windows from the key's first sample, t is a window's middle in seconds from there. A window that keeps fewer than LEAST or half of its segments has 0 segments and no arrays. A sample that lacks a channel is a gap.
    """
    starts = segment_starts(window, segment, most)
    if not len(starts):
        raise ValueError("a window is shorter than a segment")
    scale = density(segment, rate)
    per = max(1, SAMPLES // step)
    whole = rows.dropna(subset=channels)
    at = whole.join(small(ends(rows, keys, k)), keys).withColumn("_at", F.col(k) - F.col("lo")).withColumn("_n", F.col("hi") - F.col("lo"))
    held = packed(at.select(*keys, "_n", "_at", *channels), [*keys, "_n"], channels, per * step, after=max(0, window - step), k="_at").where("_block >= 0")
    names = [f"psd_{c}" for c in channels] + [f"csd_{a}_{b}_{p}" for a, b in pairs for p in ("re", "im")]
    schema = held.select(*keys).schema.add("w", LongType()).add("t", DoubleType()).add("segments", IntegerType())
    for n in names:
        schema = schema.add(n, ArrayType(DoubleType()))
    least = max(LEAST, math.ceil(len(starts) / 2))

    def run(part):
        out = {c: [] for c in schema.names}
        for row in part.to_dict("records"):
            first = row["_block"] * per * step
            there, series = _laid(row, channels, first, per * step + max(0, window - step))
            clear = _whole(there, segment)
            for i in range(per):
                if first + i * step + window > row["_n"]:
                    break
                good = starts[clear[i * step + starts]]
                for key in keys:
                    out[key].append(row[key])
                out["w"].append(row["_block"] * per + i)
                out["t"].append((first + i * step + window / 2) / rate)
                if len(good) < least:
                    out["segments"].append(0)
                    for n in names:
                        out[n].append(None)
                    continue
                out["segments"].append(len(good))
                f = {c: _transforms(series[c], i * step + good, segment) for c in channels}
                for c in channels:
                    out[f"psd_{c}"].append(scale * np.mean(np.abs(f[c]) ** 2, axis=0))
                for a, b in pairs:
                    z = scale * np.mean(f[a].conj() * f[b], axis=0)
                    out[f"csd_{a}_{b}_re"].append(z.real.copy())
                    out[f"csd_{a}_{b}_im"].append(z.imag.copy())
        return pd.DataFrame(out)

    return by_slices(held, run, schema)


def by_frequency(spectra: DataFrame, keys: list[str], arrays: list[str], rate: float, segment: int) -> DataFrame:
    """keys, w, t, segments, h, f and the arrays' values, a row for each harmonic from 1 on."""
    rows = spectra.where("segments > 0").select(*keys, "w", "t", "segments", F.posexplode(F.arrays_zip(*arrays)).alias("h", "_v"))
    return rows.where("h > 0").select(*keys, "w", "t", "segments", "h", (F.col("h") * rate / segment).alias("f"), *(F.col(f"_v.{a}").alias(a) for a in arrays))


def coherence(a: str, b: str) -> Column:
    """Squared coherence of two channels of `by_frequency`."""
    return (F.col(f"csd_{a}_{b}_re") ** 2 + F.col(f"csd_{a}_{b}_im") ** 2) / F.nullif(F.col(f"psd_{a}") * F.col(f"psd_{b}"), F.lit(0.0))


def log_bin(f: Column, shortest: float, longest: float, per_decade: int) -> Column:
    """Number of the bin of even width in log period that a frequency falls in; null outside."""
    bins = max(1, round(math.log10(longest / shortest) * per_decade))
    i = F.floor(F.log(1 / f / shortest) / math.log(longest / shortest) * bins)
    return F.when((1 / f >= shortest) & (1 / f < longest), i.cast("int"))


def bin_period(i: Column, shortest: float, longest: float, per_decade: int) -> Column:
    """Middle period of a bin."""
    bins = max(1, round(math.log10(longest / shortest) * per_decade))
    return shortest * F.exp((i + 0.5) / bins * math.log(longest / shortest))


def levels_of(rows: DataFrame, keys: list[str], channels: list[str], factor: int, levels: int, k: str = "k") -> list[DataFrame]:
    """keys, k, channels of each level; each is written once and the next is made of it."""
    now = rows.select(*keys, F.col(k).alias("k"), *channels)
    out = [now]
    for _ in range(1, levels):
        each = [decimated(now, keys, factor, "k", c).withColumnRenamed("x", c) for c in channels]
        now = stash(reduce(lambda a, b: a.join(b, [*keys, "k"]), each), "level")
        out.append(now)
    return out


def stitched(levels: list[tuple[DataFrame, float, int, int]], keys: list[str], value: str, base: DataFrame) -> DataFrame:
    """keys, t, period, value on the base's times: each level is read at its first window at or after each time, at its last one beyond the end.

    levels are (rows(keys, w, period, value), rate, window, step), base is (keys, t). As windows lie on a grid, the window to read is a matter of arithmetic, and the join one on equality.
    """
    out = []
    for rows, rate, window, step in levels:
        last = rows.groupBy(*keys).agg(F.max("w").alias("_last"))
        i = F.ceil(F.round((F.col("t") * rate - window / 2) / step, 9))
        at = base.join(small(last), keys).select(*keys, "t", F.least(F.greatest(i, F.lit(0)), "_last").cast("long").alias("w"))
        out.append(at.join(rows, [*keys, "w"]).select(*keys, "t", "period", value))
    return reduce(DataFrame.unionByName, out)


def band_line(levels: list[tuple[DataFrame, float, int, int]], keys: list[str], value: str, base: DataFrame, shortest: float, longest: float) -> DataFrame:
    """keys, t, value: the mean over a band's periods at each time and level, and of these over the levels that reach the band."""
    means = []
    for rows, *grid in levels:
        inside = rows.where(F.col("period").between(shortest, longest)).groupBy(*keys, "w").agg(F.avg(value).alias(value)).withColumn("period", F.lit(0.0))
        means.append((inside, *grid))
    return stitched(means, keys, value, base).groupBy(*keys, "t").agg(F.avg(value).alias(value))


def record_spectrum(rows: DataFrame, keys: list[str], channels: list[str], rate: float, segment: int, least: int = LEAST, k: str = "k") -> DataFrame:
    """keys, h, f, segments and psd_<channel> of whole records, segments half overlapping from each key's first sample on; missing samples are zero. Keys with fewer than `least` segments' lengths are left out."""
    hop = segment // 2
    per = max(1, SAMPLES // hop)
    scale = density(segment, rate)
    span = ends(rows, keys, k).where(F.col("hi") - F.col("lo") >= least * segment)
    at = rows.join(small(span), keys).withColumn("_at", F.col(k) - F.col("lo")).withColumn("_n", F.col("hi") - F.col("lo"))
    filled = at.select(*keys, "_n", "_at", *(F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in channels))
    held = packed(filled, [*keys, "_n"], channels, per * hop, after=segment - hop, k="_at").where("_block >= 0")
    schema: StructType = held.select(*keys).schema.add("n", IntegerType())
    for c in channels:
        schema = schema.add(f"psd_{c}", ArrayType(DoubleType()))

    def run(batches):
        for batch in batches:
            out = {c: [] for c in schema.names}
            for row in batch.to_dict("records"):
                first = row["_block"] * per * hop
                _, series = _laid(row, channels, first, per * hop + segment - hop)
                starts = np.arange(per) * hop
                starts = starts[first + starts + segment <= row["_n"]]
                if not len(starts):
                    continue
                for key in keys:
                    out[key].append(row[key])
                out["n"].append(len(starts))
                for c in channels:
                    out[f"psd_{c}"].append(sum(np.sum(np.abs(_transforms(series[c], starts[i : i + 64], segment)) ** 2, axis=0) for i in range(0, len(starts), 64)) * scale)
            yield pd.DataFrame(out)

    names = [f"psd_{c}" for c in channels]
    parts = held.mapInPandas(run, schema).select(*keys, "n", F.posexplode(F.arrays_zip(*names)).alias("h", "_v"))
    sums = parts.groupBy(*keys, "h").agg(F.sum("n").alias("segments"), *(F.sum(f"_v.{n}").alias(n) for n in names))
    return sums.select(*keys, "h", (F.col("h") * rate / segment).alias("f"), "segments", *((F.col(n) / F.col("segments")).alias(n) for n in names))


def psd_ladder(rows: DataFrame, keys: list[str], channels: list[str], rate: float, segment: int = 1 << 16, factor: int = 10, stages: int = 4, least: int = LEAST, k: str = "k") -> DataFrame:
    """keys, stage, h, f, segments, psd_<channel>: whole-record spectra at the native rate and at `factor` times less each stage, for the keys whose stage is long enough."""
    out = [record_spectrum(level, keys, channels, rate / factor**i, segment, least).withColumn("stage", F.lit(i)) for i, level in enumerate(levels_of(rows, keys, channels, factor, stages, k))]
    return reduce(DataFrame.unionByName, out)


def continuity(ladder: DataFrame, keys: list[str], psd: str, segment: int, rate: float, factor: int, share: float = 0.2) -> DataFrame:
    """keys, stage, step: how far, in dB, a stage's median density lies above that of the one after it, over the frequencies within `share` of the later stage's handover (four tenths of its rate)."""
    handover = 0.4 * rate / F.pow(F.lit(float(factor)), F.col("stage") + 1)
    fine = ladder.where(F.col("f").between(handover * (1 - share), handover * (1 + share))).groupBy(*keys, "stage").agg(F.percentile(psd, F.lit(0.5)).alias("_a"))
    at = 0.4 * rate / F.pow(F.lit(float(factor)), F.col("stage"))
    coarse = ladder.where(F.col("f").between(at * (1 - share), at * (1 + share))).groupBy(*keys, (F.col("stage") - 1).alias("stage")).agg(F.percentile(psd, F.lit(0.5)).alias("_b"))
    return fine.join(coarse, [*keys, "stage"]).select(*keys, "stage", (10 * F.log10(F.col("_a") / F.col("_b"))).alias("step"))
