"""Windows, spectra and band sums.

Samples are gathered into windows on a global grid (window w of a level starts at sample w * hop), so results depend on
neither blocks nor read order. A window is an array of bounded length; transforms run on batches of windows in numpy.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windows(rows: DataFrame, keys: list[str], channels: list[str], win: int, hop: int, k: str = "k") -> DataFrame:
    """keys, w and an array for each channel, for windows without a missing sample."""
    ws = F.explode(F.sequence(F.ceil((F.col(k) - (win - 1)) / hop), F.floor(F.col(k) / hop)))
    held = rows.dropna(subset=channels).select(*keys, k, *channels, ws.alias("w")).withColumn("_n", F.col(k) - F.col("w") * hop)
    packed = held.groupBy(*keys, "w").agg(F.sort_array(F.collect_list(F.struct("_n", *channels))).alias("_s")).where(F.size("_s") == win)
    return packed.select(*keys, "w", *(F.col(f"_s.{c}").alias(c) for c in channels))


def window_counts(rows: DataFrame, keys: list[str], win: int, hop: int, k: str = "k") -> DataFrame:
    """keys, possible, used: windows that the record's ends allow, and those without a gap."""
    ws = F.explode(F.sequence(F.ceil((F.col(k) - (win - 1)) / hop), F.floor(F.col(k) / hop)))
    full = rows.select(*keys, k, ws.alias("w")).groupBy(*keys, "w").agg(F.count("*").alias("n")).where(F.col("n") == win).groupBy(*keys).agg(F.count("*").alias("used"))
    ends = rows.groupBy(*keys).agg(F.min(k).alias("lo"), F.max(k).alias("hi"))
    possible = F.greatest(F.lit(0), F.floor((F.col("hi") - win + 1) / hop) - F.ceil(F.col("lo") / hop) + 1)
    return ends.join(full, keys, "left").select(*keys, possible.cast("long").alias("possible"), F.coalesce("used", F.lit(0)).cast("long").alias("used"))


def hann(n: int) -> np.ndarray:
    return 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)


def taper(name: str, n: int) -> np.ndarray:
    """hann, hamming, boxcar, or dpss (the first Slepian sequence of time-bandwidth product 3, of unit peak)."""
    t = np.arange(n)
    if name == "dpss":
        w = 3 / n
        off = (t[1:] * (n - t[1:])) / 2
        matrix = np.diag(((n - 1 - 2 * t) / 2) ** 2 * np.cos(2 * np.pi * w)) + np.diag(off, 1) + np.diag(off, -1)
        v = np.abs(np.linalg.eigh(matrix)[1][:, -1])
        return v / v.max()
    return {"hann": hann(n), "hamming": 0.54 - 0.46 * np.cos(2 * np.pi * t / n), "boxcar": np.ones(n)}[name]


def hop_of(win: int, rate: float, half: bool = False) -> int:
    """Samples from a window to the next: windows overlap by a quarter, by three quarters if longer than 600 s, or by half if asked for."""
    share = 0.5 if half else 0.25 if win / rate > 600 else 0.75
    return max(1, round(win * share))


def spectra(wins: DataFrame, keys: list[str], channels: list[str], first: int, last: int, taper: np.ndarray | None = None, whiten: bool = False) -> DataFrame:
    """keys, w, h and re, im of each channel: transforms of windows less their means, tapered, for harmonics first..last (from 1). Whitened, the first differences of windows a sample longer are transformed and the difference's response is divided out."""
    fields = ", ".join(f"{wins.schema[k].name} {wins.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{fields}, w long, h int, " + ", ".join(f"{c}_re double, {c}_im double" for c in channels)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.num_rows
            columns = []
            h = np.arange(first, last + 1, dtype=np.int32)
            for c in channels:
                x = batch.column(batch.schema.get_field_index(c)).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                if whiten:
                    x = np.diff(x, axis=1)
                t = hann(x.shape[1]) if taper is None else taper
                s = np.fft.rfft((x - x.mean(axis=1, keepdims=True)) * t, axis=1)[:, first : last + 1]
                s = (s / (np.exp(2j * np.pi * h / x.shape[1]) - 1) if whiten else s).ravel()
                columns += [pa.array(s.real), pa.array(s.imag)]
            rows = pa.array(np.repeat(np.arange(n), len(h)))
            front = [batch.column(i).take(rows) for i in range(len(keys) + 1)]
            yield pa.RecordBatch.from_arrays([*front, pa.array(np.tile(h, n)), *columns], [*keys, "w", "h", *(f"{c}_{p}" for c in channels for p in ("re", "im"))])

    return wins.select(*keys, F.col("w").cast("long").alias("w"), *channels).mapInArrow(run, schema)


def log_bands(win: int, first: int, last: int, count: int) -> list[tuple[int, float, float]]:
    """band, f_lo, f_hi in cycles a sample: `count` bands even in log frequency over harmonics first..last."""
    edges = np.exp(np.linspace(math.log(first - 0.5), math.log(last + 0.5), count + 1)) / win
    return [(i, float(edges[i]), float(edges[i + 1])) for i in range(count)]


def harmonics(spark, bands: list[tuple[int, float, float]], win: int) -> DataFrame:
    """band, h for harmonics with f_lo <= f < f_hi; a few rows for each band."""
    rows = [(b, h) for b, lo, hi in bands for h in range(math.ceil(lo * win), math.ceil(hi * win))]
    return spark.createDataFrame(rows, "band int, h int")


def cross(a: str, b: str):
    """re and im of a times the conjugate of b."""
    ar, ai, br, bi = (F.col(f"{x}_{p}") for x in (a, b) for p in ("re", "im"))
    return ar * br + ai * bi, ai * br - ar * bi


def band_sums(spec: DataFrame, bands: DataFrame, keys: list[str], pairs: list[tuple[str, str]]) -> DataFrame:
    """keys, band, n and sums of cross-powers a_b_re, a_b_im over windows and harmonics; add w to keys for sums by window."""
    parts = [F.sum(v).alias(f"{a}_{b}_{p}") for a, b in pairs for p, v in zip(("re", "im"), cross(a, b), strict=True)]
    return spec.join(F.broadcast(bands), "h").groupBy(*keys, "band").agg(F.count("*").alias("n"), *parts)
