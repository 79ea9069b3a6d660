"""True rates of samplers from the stamps of their files, and series put on a regular grid by cubic splines, block by block."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType

from terrawave.functions.names import SECOND
from terrawave.operators.blocks import BLOCK, packed
from terrawave.session import small

HALO = 64  # samples beside a block that its spline is fitted to as well; what lies farther weighs less than 1e-30


def header_rates(files: DataFrame, keys: list[str]) -> DataFrame:
    """keys, fs_rtc, latency: records a second by one line through the stamps of all files but the key's first and last, with an intercept for each run, and how far that of the first run lies after the first stamp.

    files(keys, run, stamp in seconds, records). Fewer than three stamps or a line that does not rise give a null rate; the latency is 0 if no file of the first run is left.
    """
    order = Window.partitionBy(*keys).orderBy("stamp", "run")
    inside = Window.partitionBy(*keys, "run").orderBy("stamp")
    rows = files.withColumn("_i", F.row_number().over(order)).withColumn("_n", F.count("*").over(Window.partitionBy(*keys))).withColumn("_first", F.min("stamp").over(Window.partitionBy(*keys)))
    rows = rows.withColumn("_k", F.coalesce(F.sum("records").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("double")).withColumn("_run1", F.min_by("run", F.struct("stamp", "run")).over(Window.partitionBy(*keys)))
    rows = rows.where((F.col("_i") > 1) & (F.col("_i") < F.col("_n"))).withColumn("_t", (F.col("stamp") - F.col("_first")).cast("double"))
    each = rows.groupBy(*keys, "run").agg(F.count("*").alias("_c"), F.avg("_k").alias("_mk"), F.avg("_t").alias("_mt"), F.var_pop("_k").alias("_v"), F.covar_pop("_k", "_t").alias("_cv"), F.first("_run1").alias("_run1"))
    own = F.col("run") == F.col("_run1")
    whole = each.groupBy(*keys).agg(F.sum("_c").alias("_c"), (F.sum(F.col("_c") * F.col("_cv")) / F.nullif(F.sum(F.col("_c") * F.col("_v")), F.lit(0.0))).alias("_s"), F.max(F.when(own, F.col("_mk"))).alias("_k0"), F.max(F.when(own, F.col("_mt"))).alias("_t0"))
    good = (F.col("_c") >= 3) & (F.col("_s") > 0)
    found = whole.select(*keys, F.when(good, 1 / F.col("_s")).alias("fs_rtc"), F.when(good, F.coalesce(F.col("_t0") - F.col("_s") * F.col("_k0"), F.lit(0.0))).otherwise(0.0).alias("latency"))
    return files.select(*keys).distinct().join(found, keys, "left").withColumn("latency", F.coalesce("latency", F.lit(0.0)))


def time_bases(files: DataFrame, keys: list[str], drift: str | None = None) -> DataFrame:
    """keys, run, n, fs_true, rtc_error, latency, start: each run's true rate, the clock's error at its first stamp, the header latency taken off it (none for the first run), and the time of its first sample in seconds.

    files(keys, run, stamp, finish, records): finish is the stamp at a file's end. The clock's error grows evenly from nothing at the key's first stamp to the column drift, in seconds, at its last end. Where stamps give no rate, records over the runs' spans do.
    """
    gone = F.coalesce(F.max(drift), F.lit(0.0)) if drift else F.lit(0.0)
    runs = files.groupBy(*keys, "run").agg(F.min("stamp").alias("_a"), F.max("finish").alias("_b"), F.sum("records").alias("n"))
    whole = files.groupBy(*keys).agg(F.min("stamp").alias("_first"), F.max("finish").alias("_last"), F.min_by("run", F.struct("stamp", "run")).alias("_run1"), gone.cast("double").alias("_drift"))
    spans = runs.groupBy(*keys).agg((F.sum("n") / F.sum(F.col("_b") - F.col("_a"))).alias("_plain"))
    rows = runs.join(whole, keys).join(spans, keys).join(header_rates(files, keys), keys)
    length = F.col("_last") - F.col("_first")
    rate = F.coalesce("fs_rtc", "_plain") / (1 + F.col("_drift") / length)
    error = F.col("_drift") * (F.col("_a") - F.col("_first")) / length
    late = F.when(F.col("run") == F.col("_run1"), 0.0).otherwise(F.col("latency"))
    return rows.where(length > 0).select(*keys, "run", "n", rate.alias("fs_true"), error.alias("rtc_error"), late.alias("latency"), (F.col("_a") + error - late).alias("start"))


def curvatures(x: np.ndarray) -> np.ndarray:
    """Second derivatives at evenly spaced knots of the cubic spline through x whose third derivative is continuous at the second and last but one."""
    n = len(x)
    r = 6 * (x[:-2] - 2 * x[1:-1] + x[2:])
    m = np.empty(n)
    m[1], m[-2] = r[0] / 6, r[-1] / 6
    if n > 5:
        # Rows 1 4 1 between two known ends: down once, up once.
        right = r[1:-1].copy()
        right[0] -= m[1]
        right[-1] -= m[-2]
        c, d = [], []
        top, last = 0.0, 0.0
        for v in right.tolist():
            top = 1 / (4 - top)
            last = (v - last) * top
            c.append(top)
            d.append(last)
        for i in range(len(d) - 2, -1, -1):
            d[i] -= c[i] * d[i + 1]
        m[2:-2] = d
    elif n == 5:
        m[2] = (r[1] - m[1] - m[3]) / 4
    m[0], m[-1] = 2 * m[1] - m[2], 2 * m[-2] - m[-3]
    return m


def spline(x: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The spline through x at places u between 0 and len(x) - 1."""
    m = curvatures(x)
    i = np.minimum(np.floor(u).astype(np.int64), len(x) - 2)
    t = u - i
    s = 1 - t
    return s * x[i] + t * x[i + 1] + ((s**3 - s) * m[i] + (t**3 - t) * m[i + 1]) / 6


def resampled(rows: DataFrame, keys: list[str], channels: list[str], bases: DataFrame, rate: int, block: int = BLOCK, i: str = "i") -> DataFrame:
    """keys, k, channels at the whole multiples k / rate of a second that lie within each run, by cubic splines of its samples.

    rows(keys, i, channels) are samples 0, 1, .. of runs without gaps, bases(keys, start_ns, fs_true) the time of sample 0 in nanoseconds and the true rate; a second must be a whole number of nanoseconds over rate. A run of fewer than four samples has no spline and no rows.
    """
    step = SECOND // rate
    if step * rate != SECOND:
        raise ValueError("a step is no whole number of nanoseconds")
    span = rows.groupBy(*keys).agg((F.max(i) + 1).alias("_n")).where("_n >= 4").join(bases.select(*keys, "start_ns", "fs_true"), keys)
    held = packed(rows.join(small(span), keys), [*keys, "_n", "start_ns", "fs_true"], channels, block, HALO, HALO, i).where((F.col("_block") >= 0) & (F.col("_block") * block < F.col("_n")))
    schema = held.select(*keys).schema.add("_k", ArrayType(LongType()))
    for c in channels:
        schema = schema.add(c, ArrayType(DoubleType()))

    def run(batches):
        for batch in batches:
            out = {c: [] for c in schema.names}
            for row in batch.to_dict("records"):
                at = np.asarray(row["_k"], np.int64)
                first, last = row["_block"] * block, min((row["_block"] + 1) * block, row["_n"])
                start, fs = int(row["start_ns"]), row["fs_true"]
                # Grid points whose place in samples lies in [first, last), the last sample's own with it.
                low = -(-(start + int(np.floor(first / fs * 1e9)) - step) // step)
                high = (start + int(np.ceil(last / fs * 1e9)) + step) // step
                k = np.arange(low, high + 1)
                u = (k * step - start).astype(np.float64) * (fs / 1e9)
                mine = (u >= first) & (u < last) & (u >= 0) & (u <= row["_n"] - 1)
                k, u = k[mine], u[mine]
                for key in keys:
                    out[key].append(row[key])
                out["_k"].append(k)
                for c in channels:
                    out[c].append(spline(np.asarray(row[c], float), u - at[0]) if len(k) else np.empty(0))
            yield pd.DataFrame(out)

    made = held.mapInPandas(run, schema)
    each = made.select(*keys, F.explode(F.arrays_zip("_k", *channels)).alias("_r"))
    return each.select(*keys, F.col("_r._k").alias("k"), *(F.col(f"_r.{c}").alias(c) for c in channels))
