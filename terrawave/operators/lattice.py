"""The grid of periods of a merge that follows its first source's lattice. Periods meet by joins on cells of log period no narrower than the tolerance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrawave.session import stash

SAME, CLOSE = 1e-5, 0.02  # decades within which periods are one, and within which two of a grid are too close


def near(rows: DataFrame, others: DataFrame, keys: list[str], decades: float, name: str, strict: bool = False) -> DataFrame:
    """rows(keys, period, ..) with whether a period of others(keys, period) lies within so many decades (strict: nearer)."""
    x = F.log10("period")
    theirs = others.select(*keys, x.alias("_y")).distinct()
    theirs = theirs.select(*keys, "_y", F.explode(F.sequence(F.floor(F.col("_y") / decades) - 1, F.floor(F.col("_y") / decades) + 1)).alias("_cell"))
    mine = rows.select(*keys, "period").distinct().withColumn("_x", x).withColumn("_cell", F.floor(F.col("_x") / decades))
    apart = F.abs(F.col("_x") - F.col("_y"))
    hit = mine.join(theirs, [*keys, "_cell"]).where(apart < decades if strict else apart <= decades).select(*keys, "period").distinct().withColumn(name, F.lit(True))
    return rows.join(hit, [*keys, "period"], "left").withColumn(name, F.coalesce(name, F.lit(False)))


def merged(periods: DataFrame, keys: list[str], decades: float = SAME) -> DataFrame:
    """keys, period: of periods within so many decades of the one before, the shortest."""
    w = Window.partitionBy(*keys).orderBy("period")
    rows = periods.select(*keys, "period").distinct().withColumn("_b", F.lag("period").over(w))
    return rows.where(F.col("_b").isNull() | (F.log10("period") - F.log10("_b") > decades)).drop("_b")


def of_first(sources: DataFrame, keys: list[str], same: float = SAME) -> tuple[DataFrame, DataFrame]:
    """keys, period of the lattice of the first xy source, and keys, source of those on it.

    sources(keys, source, rank, mode, period) list every period of each entry of a recipe, the first having the least rank. A source is on the lattice if at least half of its periods within the first one's span are the first one's; the periods outside that span of those on it extend the lattice.
    """
    first = sources.where("mode = 'xy'").groupBy(*keys).agg(F.min_by("source", "rank").alias("_first"))
    ref = sources.join(first, keys).where((F.col("source") == F.col("_first")) & (F.col("mode") == "xy"))
    span = ref.groupBy(*keys).agg((F.log10(F.min("period")) - same).alias("_lo"), (F.log10(F.max("period")) + same).alias("_hi"))
    full = sources.select(*keys, "source", "period").distinct()
    at = near(full, ref, keys, same, "_on").join(span, keys).join(first, keys).withColumn("_in", F.log10("period").between(F.col("_lo"), F.col("_hi")))
    n = at.groupBy(*keys, "source").agg(F.sum(F.col("_in").cast("int")).alias("_n"), F.sum((F.col("_in") & F.col("_on")).cast("int")).alias("_m"), F.max((F.col("source") == F.col("_first")).cast("int")).alias("_f"))
    on = n.where((F.col("_f") == 1) | ((F.col("_n") > 0) & (2 * F.col("_m") >= F.col("_n")))).select(*keys, "source")
    beyond = at.where(~F.col("_in")).join(on, [*keys, "source"]).where(F.col("source") != F.col("_first"))
    return merged(ref.select(*keys, "period").unionByName(beyond.select(*keys, "period")), keys, same), on


def first_lattice(sources: DataFrame, keys: list[str], same: float = SAME, close: float = CLOSE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The grid (keys, period, added), what it leaves out (keys, source, period), and its close pairs (keys, period, next).

    sources(keys, source, rank, mode, period, usable, inside) are as in `of_first`, inside telling whether a period is in its entry's range. The grid holds the lattice's periods that a usable period in range equals, or that an entry off the lattice gives a value at: at one of its usable periods or between two neighbouring ones, with no unusable one between. Other usable periods stay only where none of these is within `close` decades. added marks periods that no entry holds.
    """
    lattice, on = of_first(sources, keys, same)
    lattice, on = stash(lattice, "lattice"), stash(on, "on")
    good = sources.where("usable and inside")
    union = stash(merged(good, keys, same), "union")
    flagged = near(union, lattice, keys, same, "_on")
    entry = [*keys, "source", "mode", "rank"]
    w = Window.partitionBy(*entry).orderBy("period")
    off = sources.where("inside").join(on, [*keys, "source"], "left_anti").withColumn("_next", F.lead("period").over(w)).withColumn("_good", F.lead("usable").over(w))
    pieces = off.where("usable and _good").select(*keys, F.col("period").alias("_a"), F.col("_next").alias("_b")).distinct()
    between = lattice.join(pieces, keys).where((F.col("period") > F.col("_a")) & (F.col("period") < F.col("_b"))).select(*keys, "period")
    exact = near(lattice, off.where("usable"), keys, same, "_hit").where("_hit").select(*keys, "period")
    kept = stash(merged(reduce(DataFrame.unionByName, [flagged.where("_on").select(*keys, "period"), between, exact]), keys, same), "kept")
    rest = near(flagged.where("not _on"), kept, keys, close, "_near", strict=True).where("not _near").select(*keys, "period")
    grid = near(merged(kept.unionByName(rest), keys, same), union, keys, same, "_held").select(*keys, "period", (~F.col("_held")).alias("added"))
    grid = stash(grid, "grid")
    gone = near(good.select(*keys, "source", "period").distinct(), grid, keys, same, "_held").where("not _held").select(*keys, "source", "period")
    pairs = grid.withColumn("next", F.lead("period").over(Window.partitionBy(*keys).orderBy("period"))).where(F.log10("next") - F.log10("period") < close)
    return grid, gone, pairs.select(*keys, "period", "next")
