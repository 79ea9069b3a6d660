"""Ranks over a whole table, without a window over all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrawave.session import small, stash


def ranked(rows: DataFrame, order: list[Column], name: str = "place", parts: int | None = None) -> DataFrame:
    """rows with their place, from 1, in an order without ties: rows are dealt by ranges, ranked in their range, and moved by the sizes of the ranges before."""
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = stash(rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    sizes = cut.groupBy("_part").agg(F.count("*").alias("n")).select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return cut.join(small(stash(sizes, "sizes")), "_part").withColumn(name, (F.col("_before") + inside).cast("long")).drop("_part", "_before")


NEAR = 5e-4  # share of a key on either side of the quantile that is looked at value by value
FEW = 8000  # keys with fewer values are looked at whole


def percentiles(rows: DataFrame, keys: list[str], x: str, of: dict[str, float]) -> DataFrame:
    """keys and a column of each name: the exact quantiles of x, each on the line between its two neighbours; nulls and nan are passed over, a key without any value is left out.

    A first pass brackets each by a sketch, a second counts what lies below and the distinct values in the bracket, so that of a
    large key one value in a thousand, at most, meets in a task. rows are read twice.
    """
    there = rows.select(*keys, F.col(x).cast("double").alias("_x")).where("_x is not null and not isnan(_x)")
    sides = F.array(*(F.lit(min(1.0, max(0.0, q + d))) for q in of.values() for d in (-NEAR, NEAR)))
    sketch = there.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.percentile_approx("_x", sides, F.lit(10_000)).alias("_b"))
    few = F.col("_n") < FEW
    each = [F.struct(F.lit(i).alias("i"), F.lit(float(q)).alias("q"), F.when(few, F.col("_lo")).otherwise(F.col("_b")[2 * i]).alias("lo"), F.when(few, F.col("_hi")).otherwise(F.col("_b")[2 * i + 1]).alias("hi")) for i, q in enumerate(of.values())]
    bracket = stash(sketch.select(*keys, "_n", F.explode(F.array(*each)).alias("_e")).select(*keys, "_n", "_e.*"), "bracket")
    cut = there.join(small(bracket), keys).where("_x <= hi")
    own = [*keys, "_n", "i", "q"]
    # What lies below the bracket is one row, without a value.
    counts = cut.groupBy(*own, F.when(F.col("_x") >= F.col("lo"), F.col("_x")).alias("_x")).agg(F.count("*").alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*own).orderBy(F.col("_x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    place = F.col("q") * (F.col("_n") - 1)
    at = counts.withColumn("_u", upto).where("_x is not null")
    both = at.groupBy(*own).agg(F.min(F.when(F.col("_u") > F.floor(place), F.col("_x"))).alias("_p"), F.min(F.when(F.col("_u") > F.ceil(place), F.col("_x"))).alias("_q"))
    value = F.col("_p") + (F.col("_q") - F.col("_p")) * (place - F.floor(place))
    return both.groupBy(*keys).agg(*(F.max(F.when(F.col("i") == i, value)).alias(name) for i, name in enumerate(of)))


def percentile(rows: DataFrame, keys: list[str], x: str, q: float = 0.5, name: str = "value") -> DataFrame:
    """One quantile of `percentiles`."""
    return percentiles(rows, keys, x, {name: q})
