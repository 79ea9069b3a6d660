"""Files and records into runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrawave.functions.names import SECOND, ceil_index, seconds, station_key
from terrawave.operators.intervals import as_of, union


def grouped(files: DataFrame, keys: list[str], start: str = "a", most: int | None = None, ends: Column | None = None) -> DataFrame:
    """files with run, from 1: a step of exactly the key's median spacing goes on; any other step, a full run of `most` files, or a file for which `ends` holds begins the next."""
    w = Window.partitionBy(*keys).orderBy(start)
    rows = files.withColumn("_d", F.col(start) - F.lag(start).over(w))
    if ends is not None:
        rows = rows.withColumn("_ended", F.coalesce(F.lag(ends).over(w), F.lit(False)))
    usual = rows.groupBy(*keys).agg(F.percentile("_d", F.lit(0.5)).cast("long").alias("_usual"))
    new = F.coalesce(F.col("_d") != F.col("_usual"), F.lit(True))
    if ends is not None:
        new = new | F.col("_ended")
    rows = rows.join(usual, keys).withColumn("run", F.sum(new.cast("int")).over(w))
    if most is not None:
        inside = Window.partitionBy(*keys, "run").orderBy(start)
        rows = rows.withColumn("_new", (((F.row_number().over(inside) - 1) % most) == 0).cast("int")).withColumn("run", F.sum("_new").over(w)).drop("_new")
    return rows.drop("_d", "_usual", "_ended")


def wrong_count(start: str, following: Column, records: str, rate: float) -> Column:
    """Whether a file holds another number of records than its span to the next file asks for, or part of a record."""
    return F.coalesce(F.col(records) != (following - F.col(start)) * rate, F.lit(False)) | (F.col(records) != F.floor(records))


def split_at_gaps(files: DataFrame, keys: list[str], tolerance: int, rate: str | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    """files(a, b) with run: a file that starts more than `tolerance` from the end of the one before, or has another rate, begins a run. Files of one span stand in the order of `ties`."""
    w = Window.partitionBy(*keys).orderBy("a", "b", *ties)
    new = F.coalesce(F.abs(F.col("a") - F.lag("b").over(w)) > tolerance, F.lit(True))
    if rate:
        new |= ~F.col(rate).eqNullSafe(F.lag(rate).over(w))
    return files.withColumn("_new", new.cast("int")).withColumn("run", F.sum("_new").over(w)).drop("_new")


def aligned(files: DataFrame, keys: list[str], folder: str, sequence: str, samples: str) -> DataFrame:
    """keys, sequence, samples of the sequences that every folder of a key holds with one number of samples."""
    folders = files.groupBy(*keys).agg(F.countDistinct(folder).alias("_folders"))
    held = files.groupBy(*keys, sequence).agg(F.countDistinct(folder).alias("_n"), F.min(samples).alias(samples), F.max(samples).alias("_most"))
    return held.join(folders, keys).where(F.col("_n").eqNullSafe(F.col("_folders")) & (F.col(samples) == F.col("_most"))).drop("_n", "_folders", "_most")


def of_other_rate(files: DataFrame, changes: DataFrame, keys: list[str], rate: float, channels: list[str] | None = None) -> DataFrame:
    """files(a) with `rates`, those in force at its start by changes(since, rate), where one of them is another one; files before any change are left alone.

    With channels, changes have a column of that name as well: each channel keeps its rate until its own next change, and a file is of another rate if any channel is.
    """
    if channels is None:
        found = as_of(files, changes, keys, "a", "since", "rate")
        return found.where(F.col("rate") != rate)
    for c in channels:
        mine = changes.where(F.col("channel") == c).select(*keys, "since", F.col("rate").alias(f"_rate_{c}"))
        files = as_of(files, mine, keys, "a", "since", f"_rate_{c}").drop("since")
    names = [f"_rate_{c}" for c in channels]
    found = files.withColumn("rates", F.array_compact(F.array(*names))).drop(*names)
    return found.where(F.exists("rates", lambda r: r != rate))


def placed(runs: DataFrame, origin: Column, rate: Column, tolerance: float = 1e-3) -> DataFrame:
    """Runs, of start in nanoseconds, with their index on the grid of an origin, the nearest one, and whether they stand on it to a share of a step; for a whole number of samples a second."""
    ns = F.col("start") - origin
    up = ceil_index(ns, rate)
    # The rest of a step by which the sample lies behind the start, from what is left of whole seconds alone.
    over = F.pmod(-seconds(ns)[1] * rate, F.lit(SECOND).cast("long"))
    rows = runs.withColumn("index", F.when(2 * over > SECOND, up - 1).otherwise(up))
    return rows.withColumn("on_grid", F.least(over, SECOND - over) / SECOND <= tolerance)


def carried_gaps(gaps: DataFrame, keys: list[str], levels: int, factor: int, reach: int = 32, samples: Column | None = None) -> DataFrame:
    """keys, level, a, b: gaps of level 0 on each coarser grid, widened by the filter's reach, merged, and within the level's number of samples if that of level 0 is given; a loop over levels, not over data."""
    now = gaps.select(*keys, "a", "b", *([samples.alias("_n")] if samples is not None else []))
    size = ["_n"] if samples is not None else []
    out = [now.select(*keys, "a", "b").withColumn("level", F.lit(0))]
    for level in range(1, levels):
        end = F.floor(F.col("b") / factor) + 1 + reach
        cut = [F.ceil(F.col("_n") / factor).alias("_n")] if size else []
        end = F.least(end, F.ceil(F.col("_n") / factor)) if size else end
        wide = now.select(*keys, *cut, F.greatest(F.lit(0), F.floor(F.col("a") / factor) - reach).alias("a"), end.alias("b"))
        now = union(wide.where("a < b"), [*keys, *size])
        out.append(now.select(*keys, "a", "b").withColumn("level", F.lit(level)))
    return reduce(DataFrame.unionByName, out)


def selected(files: DataFrame, keys: list[str], start: Column, end: Column, a: str = "a") -> DataFrame:
    """files that overlap [start, end): a file ends where the next one starts, the last one never."""
    w = Window.partitionBy(*keys).orderBy(a)
    return files.withColumn("_end", F.lead(a).over(w)).where((F.col(a) < end) & (F.col("_end").isNull() | (F.col("_end") > start))).drop("_end")


def stretches(rows: DataFrame, keys: list[str], value: str, k: str = "k", step: int = 1) -> DataFrame:
    """keys, value, a, b of consecutive records with one value."""
    w = Window.partitionBy(*keys).orderBy(k)
    new = ~(F.col(value).eqNullSafe(F.lag(value).over(w)) & (F.col(k) - F.lag(k).over(w) == step))
    cut = rows.withColumn("_run", F.sum(F.coalesce(new, F.lit(True)).cast("int")).over(w))
    return cut.groupBy(*keys, "_run", value).agg(F.min(k).alias("a"), (F.max(k) + step).alias("b")).drop("_run")


def recorded_span(files: DataFrame, keys: list[str], start: str = "a") -> DataFrame:
    """keys, a, b, files: from the first start to the last one and the median spacing more (nothing more for one file)."""
    w = Window.partitionBy(*keys).orderBy(start)
    rows = files.withColumn("_d", F.col(start) - F.lag(start).over(w))
    return rows.groupBy(*keys).agg(F.min(start).alias("a"), (F.max(start) + F.coalesce(F.percentile("_d", F.lit(0.5)), F.lit(0))).alias("b"), F.count("*").alias("files"))


def burst_grid(bursts: DataFrame, keys: list[str], slot: str, sample: str, per: int) -> DataFrame:
    """bursts with their index on a compact grid: bursts of `per` samples laid back to back, a sample's room between them."""
    places = bursts.select(*keys, slot).distinct().withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(slot)) - 1)
    return bursts.join(places, [*keys, slot]).withColumn("index", F.col("_r") * (per + 1) + F.col(sample)).drop("_r")


def own_station(files: DataFrame, folder: str, station: str, header: str) -> DataFrame:
    """files of each folder's own station: the one named like the folder; else, where the log's header names one that has files, that one, or the first by name of those with most files if others have more. Where neither has files, all of the folder's files stay. Names are compared by `station_key`; a file without a station is none's."""
    name, like, head = (station_key(F.col(c)) for c in (station, folder, header))
    n = files.withColumn("_s", F.nullif(name, F.lit(""))).where("_s is not null").groupBy(folder, "_s").agg(F.count("*").alias("_n"), F.max((name == like).cast("int")).alias("_named"), F.max((name == head).cast("int")).alias("_head"))
    logged = F.col("_head") == 1
    facts = n.groupBy(folder).agg(F.max(F.when(F.col("_named") == 1, F.col("_s"))).alias("_own"), F.max(F.when(logged, F.col("_s"))).alias("_log"), F.max(F.when(logged, F.col("_n"))).alias("_log_n"), F.max("_n").alias("_most"), F.min_by("_s", F.struct(-F.col("_n"), "_s")).alias("_top"))
    own = facts.select(folder, F.coalesce("_own", F.when(F.col("_log_n") >= F.col("_most"), F.col("_log")).when(F.col("_log").isNotNull(), F.col("_top"))).alias("_own"))
    return files.join(own, folder, "left").where(F.col("_own").isNull() | (name == F.col("_own"))).select(*files.columns)
