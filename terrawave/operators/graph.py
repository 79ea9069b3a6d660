"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrawave.session import release, stash

ROUNDS = 60
INLINE, PARTS = 4_000_000, 16  # links up to which even one node's share of them is a small task, and tasks for so few links


def _with_least(e: DataFrame, many: bool) -> tuple[DataFrame, list[DataFrame]]:
    """e(u, v) with m, the least of u and its neighbours. Of many links, m is written first, so that the join's sides are plain tables and AQE can split a hot u."""
    least = e.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    written = [stash(least, "least")] if many else []
    return e.join(written[0] if many else least, "u"), written


def _settled(e: DataFrame) -> bool:
    """Whether every node either points at one root or is one."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("child"), F.lit(0).alias("root")).unionByName(e.select(F.col("v").alias("x"), F.lit(0).alias("child"), F.lit(1).alias("root")))
    return ends.groupBy("x").agg(F.sum("child").alias("c"), F.max("root").alias("r")).where("c > 1 or (c > 0 and r > 0)").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root for each node of links: root is the smallest node reachable. Self links and repeats do no harm; an empty table gives an empty table.

    A round is two aggregations and two joins on tables in the shared folder; no group is gathered in a task. The number of rounds grows with the logarithm of the graph's size.
    """
    def write(df: DataFrame, name: str, many: bool) -> DataFrame:
        return stash(df if many else df.coalesce(PARTS), name)

    e = stash(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links")
    many = e.count() > INLINE
    for _ in range(ROUNDS):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        joined, used = _with_least(both, many)
        large = write(joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large", many)
        joined, more = _with_least(large, many)
        # u's smaller neighbours and u itself go to the least of them.
        pairs = joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("p")).select("p.u", "p.v").where("u <> v")
        new = write(pairs.distinct(), "small", many)
        release(e, large, *used, *more)
        e = new
        if _settled(e):
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    raise RuntimeError("components did not settle")
