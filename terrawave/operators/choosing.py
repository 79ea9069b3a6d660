"""Choosing remotes and members of stacks, and merging products on a union of periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrawave.operators.intervals import intersect, overlap_join


def overlaps(locals_: DataFrame, others: DataFrame, width: int) -> DataFrame:
    """site, other, overlap, share: time that the spans(site, a, b) of two sites have in common, and its share of the first one's."""
    total = locals_.groupBy("site").agg(F.sum(F.col("b") - F.col("a")).alias("_total"))
    x = locals_.withColumn("_all", F.lit(0))
    y = others.select(F.lit(0).alias("_all"), F.col("site").alias("other"), F.col("a").alias("a2"), F.col("b").alias("b2"))
    both = overlap_join(x, y, ["_all"], width).where("site <> other")
    sums = both.groupBy("site", "other").agg(F.sum(F.least("b", "b2") - F.greatest("a", "a2")).alias("overlap"))
    return sums.join(total, "site").select("site", "other", "overlap", (F.col("overlap") / F.col("_total")).alias("share"))


def with_reason(pairs: DataFrame, rules: list[tuple[Column, str]]) -> DataFrame:
    """pairs with `left_out`, the text of the first rule that holds against each; null for those to keep."""
    reason = F.lit(None).cast("string")
    for against, text in reversed(rules):
        reason = F.when(F.coalesce(against, F.lit(False)), text).otherwise(reason)
    return pairs.withColumn("left_out", reason)


def nearest_eligible(pairs: DataFrame, n: int) -> DataFrame:
    """pairs(site, other, km, left_out) with `place` among the site's eligible ones by distance, then name, and `taken` for the first n."""
    w = Window.partitionBy("site", F.col("left_out").isNull()).orderBy("km", "other")
    return pairs.withColumn("place", F.when(F.col("left_out").isNull(), F.row_number().over(w))).withColumn("taken", F.coalesce(F.col("place") <= n, F.lit(False)))


def members(candidates: DataFrame, share: float, fallback: float, n: int, least: int) -> DataFrame:
    """candidates(site, other, km, best_share) taken into each site's stack: the nearest n with their best run's share above `share`, or above `fallback` where fewer than `least` reach that; none where fewer than `least` reach that either."""
    w = Window.partitionBy("site")
    reach = F.sum((F.col("best_share") >= share).cast("int")).over(w)
    rows = candidates.withColumn("_floor", F.when(reach >= least, share).otherwise(fallback)).where(F.col("best_share") >= F.col("_floor"))
    rows = rows.withColumn("place", F.row_number().over(w.orderBy("km", "other"))).withColumn("_n", F.count("*").over(w))
    return rows.where((F.col("_n") >= least) & (F.col("place") <= n)).drop("_floor", "_n")


def simultaneous(runs: DataFrame, remote: DataFrame, start: int, end: int, width: int, least: int) -> DataFrame:
    """site, a, b: runs within [start, end) and within the site's remote runs, of `least` or more."""
    cut = runs.select("site", F.greatest("a", F.lit(start)).alias("a"), F.least("b", F.lit(end)).alias("b")).where("a < b")
    return intersect(cut, remote, ["site"], width).where(F.col("b") - F.col("a") >= least)


def on_union(x: DataFrame, y: DataFrame, keys: list[str], of_x: list[str], of_y: list[str], digits: int = 9) -> DataFrame:
    """Rows of x and y on the union of their periods; periods that agree to so many digits of their logarithm are one, x's. What one side lacks is null."""
    def side(df: DataFrame, names: list[str], name: str) -> DataFrame:
        return df.select(*keys, F.round(F.log("period"), digits).alias("_p"), F.col("period").alias(name), *names)

    both = side(x, of_x, "_x").join(side(y, of_y, "_y"), [*keys, "_p"], "full")
    return both.select(*keys, F.coalesce("_x", "_y").alias("period"), *of_x, *of_y)


def under_most_overlapped(pairs: DataFrame) -> DataFrame:
    """site, other of the pair(site, other, overlap, start) with the largest overlap of each site, ties to the earlier, then by name."""
    w = Window.partitionBy("site").orderBy(F.desc("overlap"), "start", "other")
    return pairs.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
