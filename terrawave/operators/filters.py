"""Filters over long series, in blocks that reach into their neighbours: a sample is dealt to the blocks that need it, and no series is gathered."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def low_pass(q: int) -> np.ndarray:
    """20 q + 1 taps of a Hamming-windowed sinc with its cutoff at the output's Nyquist frequency, of sum 1."""
    half = 10 * q
    m = np.arange(-half, half + 1)
    taps = np.sinc(m / q) * (0.54 + 0.46 * np.cos(np.pi * m / half))
    return taps / taps.sum()


def decimated(rows: DataFrame, keys: list[str], q: int, k: str = "k", x: str = "x", block: int = 16_384) -> DataFrame:
    """keys, k, x at every q-th sample of the grid that is there, low-passed without a shift of phase; missing samples count as zero (take the level out first)."""
    taps, half = low_pass(q), 10 * q
    at = F.col(k).cast("long")
    blocks = F.explode(F.sequence(F.floor((at - half) / (q * block)), F.floor((at + half) / (q * block)))).alias("_block")
    dealt = rows.where(F.col(x).isNotNull()).select(*keys, at.alias("k"), F.col(x).cast("double").alias("x"), blocks)
    fields = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in keys)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        first = int(part["_block"].iloc[0]) * block * q - half
        series, there = np.zeros(block * q + 2 * half), np.zeros(block * q + 2 * half, bool)
        places = part["k"].to_numpy() - first
        inside = (places >= 0) & (places < len(series))
        series[places[inside]], there[places[inside]] = part["x"].to_numpy()[inside], True
        out = np.flatnonzero(there[half : half + block * q : q])
        near = np.lib.stride_tricks.sliding_window_view(series, 2 * half + 1)[out * q]
        made = {n: np.repeat(part[n].iloc[:1].to_numpy(), len(out)) for n in keys}
        return pd.DataFrame(made | {"k": out + (first + half) // q, "x": near @ taps})

    return dealt.groupBy(*keys, "_block").applyInPandas(run, f"{fields}, k long, x double")


def ladder(rows: DataFrame, keys: list[str], factor: int, levels: int, k: str = "k", x: str = "x") -> DataFrame:
    """keys, level, k, x: a series and its coarser levels, each made of the one before; sample j of a level lies at j * factor ** level."""
    now = rows.select(*keys, F.col(k).alias("k"), F.col(x).cast("double").alias("x"))
    out = now.withColumn("level", F.lit(0))
    for level in range(1, levels):
        now = decimated(now, keys, factor)
        out = out.unionByName(now.withColumn("level", F.lit(level)))
    return out
