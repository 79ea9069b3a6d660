"""Masks: rows made fit for use, split by what takes them, and laid over groups of windows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrawave.functions.names import ceil_index, seconds_at
from terrawave.operators.intervals import complement, islands, overlap_join, union
from terrawave.session import stash

SCOPES = ("local", "remote", "both")


def normalised(masks: DataFrame) -> DataFrame:
    """masks(site, a, b, pmin, pmax, scope, channels) with channels sorted and without repeats (none: null), scope in lower case (none: both), and `refused`, the first reason against a row (null if it is fit)."""
    channels = F.array_sort(F.array_distinct(F.transform(F.filter("channels", lambda c: c.isNotNull() & (F.trim(c) != "")), lambda c: F.lower(F.trim(c)))))
    rows = masks.withColumn("scope", F.coalesce(F.lower("scope"), F.lit("both"))).withColumn("channels", F.when(F.size(channels) > 0, channels))
    reason = (
        F.when(F.col("site").isNull(), "no site")
        .when(F.col("a").isNull() | F.col("b").isNull(), "no time")
        .when(F.col("a") >= F.col("b"), "ends before it starts")
        .when(F.col("pmin").isNull() != F.col("pmax").isNull(), "half a band")
        .when(F.col("pmin") > F.col("pmax"), "band upside down")
        .when(~F.col("scope").isin(*SCOPES), "unknown scope")
    )
    return rows.withColumn("refused", reason)


def split(masks: DataFrame, role: str, channels: list[str], bands: bool) -> DataFrame:
    """masks with `left_out`, the first reason why a site in this role does not take them; null if it does."""
    other = ~F.col("scope").isin(role, "both")
    apart = F.col("channels").isNotNull() & ~F.arrays_overlap("channels", F.array(*map(F.lit, channels)))
    banded = F.col("pmin").isNotNull()
    return masks.withColumn("left_out", F.when(other, "other role").when(apart, "other channels").when(banded & F.lit(not bands), "one band only"))


def replaced(masks: DataFrame, new: DataFrame, origin: str) -> DataFrame:
    """Masks with those of one origin replaced by new ones; others, and those without an origin, stay."""
    return masks.where(~F.col("found_by").eqNullSafe(F.lit(origin))).unionByName(new.withColumn("found_by", F.lit(origin)), allowMissingColumns=True)


def states(windows: DataFrame, keys: list[str], hit: Column, kept: Column) -> DataFrame:
    """keys, state of each group of windows: 0 clear, 1 in part, 2 all kept windows hit."""
    n = windows.groupBy(*keys).agg(F.sum(kept.cast("int")).alias("_kept"), F.sum((kept & hit).cast("int")).alias("_hit"))
    return n.select(*keys, F.when((F.col("_kept") > 0) & (F.col("_hit") == F.col("_kept")), 2).when(F.col("_hit") > 0, 1).otherwise(0).alias("state"))


def nights(records: DataFrame, keys: list[str], first_hour: int, last_hour: int, zone: str) -> DataFrame:
    """keys, a, b (seconds): local nights, from first_hour to last_hour of the next day, of each day of records(a, b); hours are those of the zone's clock, whatever the session's zone is."""
    day = F.explode(F.sequence(F.floor(F.col("a") / 86400) - 2, F.floor(F.col("b") / 86400) + 1)).alias("day")

    def at(days: int, hour: int) -> Column:
        return seconds_at((F.col("day") + days) * 86400 + hour * 3600, zone)

    rows = records.select(*keys, "a", "b", day).select(*keys, "a", "b", at(0, first_hour).alias("_a"), at(1, last_hour).alias("_b"))
    return rows.select(*keys, F.greatest("a", "_a").alias("a"), F.least("b", "_b").alias("b")).where("a < b")


def night_masks(records: DataFrame, keys: list[str], first_hour: int, last_hour: int, zone: str) -> DataFrame:
    """keys, a, b: what local nights leave of each record."""
    whole = union(records, keys).groupBy(*keys).agg(F.min("a").alias("lo"), F.max("b").alias("hi"))
    return complement(nights(records, keys, first_hour, last_hour, zone), keys, whole)


def on_grid(masks: DataFrame, origin: Column, samples: Column, rate: Column) -> DataFrame:
    """masks(a, b in nanoseconds) with the samples [first, last) of a grid that they cover; those off the grid left out."""
    def index(t: str) -> Column:
        return ceil_index(F.col(t) - origin, rate)

    rows = masks.withColumn("first", F.greatest(F.lit(0), index("a")).cast("long")).withColumn("last", F.least(samples, index("b")).cast("long"))
    return rows.where("first < last")


def shifted_control(slots: DataFrame, keys: list[str], kept: str, shift: int, k: str = "k") -> DataFrame:
    """keys, k, kept: the pattern of kept slots moved round by so many slots of those that hold data."""
    w = Window.partitionBy(*keys).orderBy(k)
    ranked = slots.select(*keys, F.col(k).alias("k"), F.col(kept).alias("kept"), (F.row_number().over(w) - 1).alias("_r"), F.count("*").over(Window.partitionBy(*keys)).alias("_n"))
    moved = ranked.select(*keys, F.pmod(F.col("_r") + shift, F.col("_n")).alias("_r"), "kept")
    return ranked.select(*keys, "k", "_r").join(moved, [*keys, "_r"]).drop("_r")


def alternate_runs(slots: DataFrame, keys: list[str], kept: str, half: int, k: str = "k") -> DataFrame:
    """keys, a, b of every other run of kept slots: the first, third, .. for half 0, else the second, fourth, .."""
    runs = islands(slots.where(F.col(kept)), keys, k)
    n = F.row_number().over(Window.partitionBy(*keys).orderBy("a")) - 1
    return runs.withColumn("_n", n).where(F.col("_n") % 2 == half).drop("_n")


def bursts(rows: DataFrame, keys: list[str], loud: Column, width: int, pad: int, k: str = "k") -> DataFrame:
    """keys, a, b: stretches on which loud holds for `width` samples or more beyond the width - 1 by which a mean over `width` widens them, padded within the record and merged."""
    rows = stash(rows.select(*keys, k, loud.alias("_loud")), "loud")
    runs = islands(rows.where("_loud"), keys, k).where(F.col("b") - F.col("a") - (width - 1) >= width)
    record = rows.groupBy(*keys).agg(F.min(k).alias("_lo"), (F.max(k) + 1).alias("_hi"))
    return union(runs.join(record, keys).select(*keys, F.greatest(F.col("a") - pad, "_lo").alias("a"), F.least(F.col("b") + pad, "_hi").alias("b")), keys)


def spans_filled(rows: DataFrame, spans: DataFrame, keys: list[str], x: str, level: str, taper: int, width: int, k: str = "k") -> DataFrame:
    """rows with x inside the spans(keys, a2, b2), which don't overlap, set to the column `level`, by a cosine from the first and to the last sample, which stay as they are; it takes `taper` samples, half the span at most."""
    cells = F.explode(F.sequence(F.floor(F.col("a2") / width), F.floor((F.col("b2") - 1) / width))).alias("_cell")
    dealt = spans.where("a2 < b2").select(*keys, "a2", "b2", cells).alias("s")
    r = rows.withColumn("_cell", F.floor(F.col(k) / width)).alias("r")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in keys]
    # Taken for as small as the spans were before they were dealt, cells would be broadcast.
    inside = r.join(dealt.hint("merge"), [*same, F.col("r._cell") == F.col("s._cell"), F.col(f"r.{k}") >= F.col("s.a2"), F.col(f"r.{k}") < F.col("s.b2")], "left")
    edge = F.least(F.col(f"r.{k}") - F.col("s.a2"), F.col("s.b2") - 1 - F.col(f"r.{k}"))
    half = F.least(F.lit(taper), F.floor((F.col("s.b2") - F.col("s.a2")) / 2))
    keep = F.when(edge < half, (1 + F.cos(math.pi * edge / half)) / 2).otherwise(0.0)
    new = F.when(F.col("s.a2").isNull(), F.col(f"r.{x}")).otherwise(F.col(f"r.{level}") + keep * (F.col(f"r.{x}") - F.col(f"r.{level}")))
    return inside.select(*(new.alias(c) if c == x else F.col(f"r.{c}") for c in rows.columns))
