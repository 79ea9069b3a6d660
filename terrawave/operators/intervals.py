"""Runs, gaps and intervals [a, b) on an integer grid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


BLOCK = 1 << 16  # grid steps whose rows are sorted together; of each block only its ends meet those of the others


def _block(k: str | Column, width: int) -> Column:
    return F.floor((F.col(k) if isinstance(k, str) else k) / width)


def islands(rows: DataFrame, keys: list[str], k: str = "k", tolerance: int = 1, block: int = BLOCK) -> DataFrame:
    """Contiguous stretches of k: keys, a, b with b one past the last; steps up to `tolerance` continue one.

    Stretches are found in blocks of the grid first; only these meet in the order of their key.
    """
    inner = [*keys, "_block"]
    w = Window.partitionBy(*inner).orderBy(k)
    new = (F.col(k) - F.lag(k).over(w) > tolerance).cast("int")
    cut = rows.select(*keys, k, _block(k, block).alias("_block")).distinct().withColumn("_run", F.sum(F.coalesce(new, F.lit(1))).over(w))
    parts = cut.groupBy(*inner, "_run").agg(F.min(k).alias("a"), (F.max(k) + 1).alias("b")).drop("_run", "_block")
    return _merged(parts, keys, tolerance - 1)


def true_runs(rows: DataFrame, keys: list[str], flag: Column, k: str = "k") -> DataFrame:
    return islands(rows.where(flag), keys, k)


def _merged(spans: DataFrame, keys: list[str], tolerance: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("a", "b")
    reach = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    cut = spans.withColumn("_new", F.coalesce((F.col("a") > reach + tolerance).cast("int"), F.lit(1)))
    cut = cut.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return cut.groupBy(*keys, "_run").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("_run")


def union(spans: DataFrame, keys: list[str], tolerance: int = 0, block: int = BLOCK) -> DataFrame:
    """Overlapping, touching, or (with a tolerance) close spans merged: those that begin in one block of the grid first, then what is left of each key."""
    cut = spans.select(*keys, "a", "b", _block("a", block).alias("_block")).where("a < b")
    return _merged(_merged(cut, [*keys, "_block"], tolerance).drop("_block"), keys, tolerance)


def complement(spans: DataFrame, keys: list[str], within: DataFrame) -> DataFrame:
    """What spans leave of within(keys, lo, hi), one row for each key."""
    inside = spans.join(within, keys).select(*keys, F.greatest("a", "lo").alias("a"), F.least("b", "hi").alias("b"), "lo", "hi").where("a < b")
    merged = union(inside, keys)
    edges = merged.unionByName(within.select(*keys, F.col("lo").alias("a"), F.col("lo").alias("b"))).unionByName(within.select(*keys, F.col("hi").alias("a"), F.col("hi").alias("b")))
    w = Window.partitionBy(*keys).orderBy("a", "b")
    return edges.select(*keys, F.col("b").alias("a"), F.lead("a").over(w).alias("b")).where("a < b")


def _buckets(a: str, b: str, width: int) -> Column:
    return F.explode(F.sequence(F.floor(F.col(a) / width), F.floor((F.col(b) - 1) / width)))


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], width: int, closed_columns: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Pairs of left(keys, a, b, ...) and right(keys, a2, b2, ...) that overlap. Both are dealt to buckets of `width`, so the join is an equi-join; a pair is kept in the bucket of the later start alone."""
    x = left.where("a < b").withColumn("_bucket", _buckets("a", "b", width))
    y = right.where("a2 < b2").withColumn("_bucket", _buckets("a2", "b2", width))
    # The optimizer takes a side for as small as it was before it was dealt, and would broadcast it.
    both = x.hint("merge").join(y.hint("merge"), [*keys, "_bucket"]).where("a < b2 and a2 < b")
    return both.where(F.col("_bucket") == F.floor(F.greatest("a", "a2") / width)).drop("_bucket")


def intersect(left: DataFrame, right: DataFrame, keys: list[str], width: int) -> DataFrame:
    other = right.select(*keys, F.col("a").alias("a2"), F.col("b").alias("b2"))
    return overlap_join(left, other, keys, width).select(*keys, F.greatest("a", "a2").alias("a"), F.least("b", "b2").alias("b"))


def difference(left: DataFrame, right: DataFrame, keys: list[str], width: int, least: int = 1) -> DataFrame:
    """Pieces of each left span that no right span covers, of `least` or more."""
    spans = left.select(*keys, "a", "b").distinct()
    ids = [*keys, "lo", "hi"]
    cover = overlap_join(spans, right.select(*keys, F.col("a").alias("a2"), F.col("b").alias("b2")), keys, width)
    cover = cover.select(*keys, F.col("a").alias("lo"), F.col("b").alias("hi"), F.greatest("a", "a2").alias("a"), F.least("b", "b2").alias("b"))
    # Each span is its own key here; its ends close the row of covers.
    merged = union(cover, ids)
    ends = spans.select(*keys, F.col("a").alias("lo"), F.col("b").alias("hi"))
    edges = reduce(DataFrame.unionByName, [merged, ends.withColumn("a", F.col("lo")).withColumn("b", F.col("lo")), ends.withColumn("a", F.col("hi")).withColumn("b", F.col("hi"))])
    w = Window.partitionBy(*ids).orderBy("a", "b")
    out = edges.select(*ids, F.col("b").alias("_a"), F.lead("a").over(w).alias("_b")).where(F.col("_b") - F.col("_a") >= least)
    return out.select(*keys, F.col("_a").alias("a"), F.col("_b").alias("b"))


def counts(spans: DataFrame, keys: list[str], block: int = BLOCK) -> DataFrame:
    """keys, a, b, n: stretches on which n spans lie, by a sweep over their ends in blocks; a block begins with the number of spans that earlier ones left open."""
    ends = spans.select(*keys, F.col("a").alias("at"), F.lit(1).alias("d")).unionByName(spans.select(*keys, F.col("b").alias("at"), F.lit(-1).alias("d")))
    steps = ends.groupBy(*keys, "at").agg(F.sum("d").alias("d")).withColumn("_block", _block("at", block))
    over = Window.partitionBy(*keys).orderBy("_block")
    starts = steps.groupBy(*keys, "_block").agg(F.sum("d").alias("d"), F.min("at").alias("first"))
    starts = starts.select(*keys, "_block", F.coalesce(F.sum("d").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_open"), F.lead("first").over(over).alias("_next"))
    w = Window.partitionBy(*keys, "_block").orderBy("at")
    rows = steps.join(starts, [*keys, "_block"])
    return rows.select(*keys, F.col("at").alias("a"), F.coalesce(F.lead("at").over(w), "_next").alias("b"), (F.sum("d").over(w) + F.col("_open")).alias("n")).where("b is not null and n > 0")


def carried(rows: DataFrame, keys: list[str], k: str, value: Column, names: tuple[str, str], ahead: bool = False, block: int = BLOCK) -> DataFrame:
    """rows with the last k at or before each one (ahead: the first at or after) at which value is not null, and the value there.

    It is sought within a block of the grid; blocks hand on what they end with, a row for each.
    """
    inner = [*keys, "_block"]
    rows = rows.withColumn("_block", _block(k, block)).withColumn("_at", F.when(value.isNotNull(), F.struct(F.col(k).alias("k"), value.alias("v"))))
    pick, side = (F.min, (1, Window.unboundedFollowing)) if ahead else (F.max, (Window.unboundedPreceding, -1))
    ends = rows.groupBy(*inner).agg(pick("_at").alias("_end"))
    over = Window.partitionBy(*keys).orderBy("_block").rowsBetween(*side)
    known = F.first if ahead else F.last
    ends = ends.select(*inner, known("_end", True).over(over).alias("_end"))
    near = Window.partitionBy(*inner).orderBy(k).rowsBetween(*((0, Window.unboundedFollowing) if ahead else (Window.unboundedPreceding, 0)))
    rows = rows.join(ends, inner).withColumn("_at", F.coalesce(known("_at", True).over(near), "_end"))
    return rows.withColumn(names[0], F.col("_at.k")).withColumn(names[1], F.col("_at.v")).drop("_block", "_at", "_end")


def as_of(rows: DataFrame, facts: DataFrame, keys: list[str], k: str, fact_k: str, value: str, earliest: bool = False, block: int = BLOCK) -> DataFrame:
    """rows with the value of the latest fact at or before k, by one pass over both in blocks; with `earliest`, rows before their key's first fact take that."""
    marked = rows.select(F.struct("*").alias("_row"), *keys, F.col(k).alias("_k"), F.lit(1).alias("_kind"))
    known = facts.select(*keys, F.col(fact_k).alias("_k"), F.col(value).alias("_v")).where(F.col("_v").isNotNull()).groupBy(*keys, "_k").agg(F.max("_v").alias("_v"))
    # A fact and the rows at its k share it: facts are joined there first.
    marked = marked.join(known, [*keys, "_k"], "left")
    both = marked.unionByName(known.withColumn("_row", F.lit(None).cast(marked.schema["_row"].dataType)).withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    out = carried(both, keys, "_k", F.col("_v"), ("_from", "_value"), block=block)
    if earliest:
        out = carried(out, keys, "_k", F.col("_v"), ("_later", "_first"), ahead=True, block=block)
        out = out.withColumn("_from", F.coalesce("_from", "_later")).withColumn("_value", F.coalesce("_value", "_first"))
    return out.where("_kind = 1").select("_row.*", F.col("_from").alias(fact_k if fact_k != k else f"{fact_k}_from"), F.col("_value").alias(value))


def fill_linear(rows: DataFrame, keys: list[str], k: str = "k", x: str = "x", most: int | None = None, hold_ends: bool = True, block: int = BLOCK) -> DataFrame:
    """Null x between known ones on the straight line between them, if the gap has `most` samples or fewer; at the ends the nearest known x, or null."""
    rows = carried(rows, keys, k, F.col(x), ("_p", "_u"), block=block)
    rows = carried(rows, keys, k, F.col(x), ("_q", "_v"), ahead=True, block=block)
    inside = F.col("_u") + (F.col("_v") - F.col("_u")) * (F.col(k) - F.col("_p")) / F.nullif(F.col("_q") - F.col("_p"), F.lit(0))
    if most is not None:
        inside = F.when(F.col("_q") - F.col("_p") - 1 <= most, inside)
    ends = F.coalesce("_u", "_v") if hold_ends else F.lit(None).cast("double")
    value = F.when(F.col(x).isNotNull(), F.col(x)).when(F.col("_p").isNotNull() & F.col("_q").isNotNull(), inside).otherwise(ends)
    return rows.withColumn(x, value).drop("_p", "_q", "_u", "_v")
