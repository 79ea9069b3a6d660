"""Series as blocks of the grid, packed in arrays of bounded length, with or without the samples around them."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType

from terrawave.session import small

BLOCK = 1 << 16  # samples
SLICE = 16  # blocks of an Arrow batch that are worked on at once


def ends(rows: DataFrame, keys: list[str], k: str = "k") -> DataFrame:
    """keys, lo, hi: first sample of each key and one past the last."""
    return rows.groupBy(*keys).agg(F.min(k).alias("lo"), (F.max(k) + 1).alias("hi"))


def packed(rows: DataFrame, keys: list[str], columns: list[str], block: int = BLOCK, before: int = 0, after: int = 0, k: str = "k") -> DataFrame:
    """keys, _block, _k and an array for each column: the samples of each block, and so many more before and after it, in order."""
    at = F.col(k).cast("long")
    own = F.floor(at / block)
    dealt = own if not before and not after else F.explode(F.sequence(F.floor((at - after) / block), F.floor((at + before) / block)))
    cut = rows.select(*keys, at.alias("_k"), *columns, dealt.alias("_block"))
    held = cut.groupBy(*keys, "_block").agg(F.sort_array(F.collect_list(F.struct("_k", *columns))).alias("_s"))
    return held.select(*keys, "_block", F.col("_s._k").alias("_k"), *(F.col(f"_s.{c}").alias(c) for c in columns))


def unpacked(blocks: DataFrame, keys: list[str], columns: list[str], k: str = "k") -> DataFrame:
    """keys, k and columns of packed blocks, a row for each sample."""
    rows = blocks.select(*keys, F.explode(F.arrays_zip("_k", *columns)).alias("_r"))
    return rows.select(*keys, F.col("_r._k").alias(k), *(F.col(f"_r.{c}").alias(c) for c in columns))


def over_blocks(rows: DataFrame, keys: list[str], columns: list[str], fn: Callable, made: list[str], block: int, before: int, after: int, k: str = "k") -> DataFrame:
    """keys, k, made: fn(k, arrays, lo, hi) of each block with its surroundings, of which the block's own samples are kept; lo and hi are the ends of the key."""
    span = ends(rows, keys, k)
    held = packed(rows, keys, columns, block, before, after, k).join(small(span), keys)
    schema = held.select(*keys, "_block", "_k").schema
    for c in made:
        schema = schema.add(c, ArrayType(DoubleType()))

    def run(part):
        out = part[[*keys, "_block", "_k"]].copy()
        results = {c: [] for c in made}
        for i, row in enumerate(part.to_dict("records")):
            at = np.asarray(row["_k"], np.int64)
            values = fn(at, {c: np.asarray(row[c], np.float64) for c in columns}, row["lo"], row["hi"])
            own = at // block == row["_block"]
            out.at[out.index[i], "_k"] = at[own]
            for c, v in zip(made, values, strict=True):
                results[c].append(v[own])
        return out.assign(**results)

    return unpacked(by_slices(held, run, schema), keys, made, k)


def by_slices(blocks: DataFrame, fn: Callable, schema, rows: int = SLICE) -> DataFrame:
    """fn of so many blocks at a time, pandas to pandas: a batch may hold ten thousand, of which copies would fill a worker."""

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                part = fn(batch.slice(i, rows).to_pandas())
                yield pa.RecordBatch.from_pandas(part, schema=to_arrow_schema(schema), preserve_index=False)

    return blocks.mapInArrow(run, schema)


def running_total(rows: DataFrame, keys: list[str], value: str, name: str, block: int = BLOCK, k: str = "k") -> DataFrame:
    """rows with the sum of value up to and including each row, summed in blocks of the grid that hand on their totals."""
    rows = rows.withColumn("_block", F.floor(F.col(k) / block))
    over = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys, "_block").agg(F.sum(value).alias("_t")).select(*keys, "_block", F.coalesce(F.sum("_t").over(over), F.lit(0.0)).alias("_t"))
    inside = Window.partitionBy(*keys, "_block").orderBy(k)
    return rows.join(totals, [*keys, "_block"]).withColumn(name, F.col("_t") + F.sum(value).over(inside)).drop("_t", "_block")


def moving_median(rows: DataFrame, keys: list[str], x: str, before: int, after: int, name: str = "median", block: int = BLOCK, k: str = "k") -> DataFrame:
    """keys, k, and the median of x over the samples there are from so many before each to so many after it."""

    def run(at, arrays, lo, hi):
        return (rolling_median(at, arrays[x], before, after),)

    return over_blocks(rows, keys, [x], run, [name], block, before, after, k)


def rolling_median(at: np.ndarray, x: np.ndarray, before: int, after: int) -> np.ndarray:
    """Medians over frames [k - before, k + after] of the samples at increasing places; a sorted frame is kept for wide ones."""
    a, b = np.searchsorted(at, at - before, "left"), np.searchsorted(at, at + after, "right")
    width = before + after + 1
    if width <= 301:
        values = np.full(at[-1] - at[0] + width, np.nan)
        values[at - at[0] + before] = x
        frames = np.lib.stride_tricks.sliding_window_view(values, width)
        out = np.empty(len(at))
        for i in range(0, len(at), 8192):
            out[i : i + 8192] = np.nanmedian(frames[at[i : i + 8192] - at[0]], axis=1)
        return out
    held, out, left, right = [], np.empty(len(at)), 0, 0
    for i in range(len(at)):
        while right < b[i]:
            insort(held, x[right])
            right += 1
        while left < a[i]:
            del held[bisect_left(held, x[left])]
            left += 1
        n = len(held)
        out[i] = (held[(n - 1) // 2] + held[n // 2]) / 2
    return out
