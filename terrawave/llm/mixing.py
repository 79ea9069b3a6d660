"""Mixing sources to target weights by Pareto order sampling.

Each source has a target number of words: its share of all words by weight, at most CAP times its own words, the excess
shared out again. A source's target is floor(target / size) whole copies of all its documents, which are certain, and a
sample for the rest: documents are ranked by the odds of a random number over the odds of their inclusion probability,
and taken in this order up to the number of words that is left. The random number is a hash of the id, so reruns agree.

Ranks are cut into SLICES by value. Sums by source and slice give the slice in which the sample ends; only documents
of that slice are put in order, so a source of any size is never in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrawave.session import stash

WEIGHTS = (5, 2, 1)
CAP = 3
SLICES = 4096
WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """sizes(source, n_docs, source_size) with target: weights go round in the order of source, null last.

    With the sources by ascending cap / weight, `level` is the share of a weight if all before are capped and this one is not; the greatest level is the true one.
    """
    order = Window.orderBy(F.asc_nulls_last("source"))
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", w).withColumn("most", (F.col("source_size") * cap).cast("double"))
    rank = Window.orderBy(F.col("most") / F.col("weight"), F.asc_nulls_last("source"))
    everything = Window.partitionBy(F.lit(1))
    capped = F.coalesce(F.sum("most").over(rank.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(rank.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", (F.sum(F.col("source_size").cast("double")).over(everything) - capped) / open_weight)
    rows = rows.withColumn("target", F.least(F.max("level").over(everything) * F.col("weight"), F.col("most")))
    return rows.select("source", "n_docs", "source_size", "target")


def allocate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", size_col: str | None = None) -> DataFrame:
    """doc (a struct of all columns of docs), size, source_size, target, copies for each row of docs. Words are counted, unless size_col names a column that has their number; then no text is needed.

    A null text has no words; a null source is a source of its own. Rows that share an id share their random number; rows that tie in all ways are alike, so any order serves.
    """
    u = (F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.col("doc")[id_col].cast("string"))), 1, 12), 16, 10).cast("double") + 0.5) / 2.0**48
    rows = docs.select(F.struct("*").alias("doc")).select("doc", F.col("doc")[id_col].alias("_id"), F.coalesce(u, F.lit(0.5)).alias("_u"), (F.col("doc")[size_col].cast("long") if size_col else words_in(F.col("doc")[text_col])).alias("size"), F.col("doc")[source_col].cast("string").alias("source"))
    sizes = rows.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    plan = stash(targets(sizes), "targets").withColumnRenamed("source", "_source")
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.withColumn("_whole", F.floor(rate)).withColumn("_part", rate - F.floor(rate))
    rows = rows.withColumn("_quota", F.col("target") - F.col("_whole") * F.col("source_size"))
    likely = F.col("_part") * F.least(F.lit(2.0), F.greatest(F.lit(0.5), F.col("size").cast("double") * F.col("n_docs") / F.greatest(F.col("source_size"), F.lit(1))))
    p = F.least(F.lit(0.999999), F.greatest(F.lit(0.000001), likely))
    odds = (F.col("_u") / (1 - F.col("_u"))) * ((1 - p) / p)
    rows = rows.withColumn("_key", odds / (1 + odds)).withColumn("_slice", F.least(F.floor(F.col("_key") * SLICES), F.lit(SLICES - 1)))

    by_slice = stash(rows.groupBy("source", "_slice", "_quota").agg(F.sum("size").alias("_n")), "slices")
    upto = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    ends = by_slice.withColumn("_end", F.sum("_n").over(upto)).where("_end > _quota").groupBy(F.col("source").alias("_source")).agg(F.min_by(F.struct(F.col("_slice").alias("last"), (F.col("_end") - F.col("_n")).alias("before")), "_slice").alias("_cut"))
    rows = rows.join(stash(ends, "ends"), F.col("source").eqNullSafe(F.col("_source")), "left")
    last = F.coalesce(F.col("_cut.last"), F.lit(SLICES))
    inside = Window.partitionBy("source").orderBy("_key", "_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = rows.where(F.col("_slice") == last).withColumn("_sum", F.col("_cut.before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    edge = edge.withColumn("_more", (F.col("_quota") > 0) & (F.col("_sum") + F.col("size") / 2 <= F.col("_quota"))).drop("_sum")
    sure = rows.where(F.col("_slice") != last).withColumn("_more", (F.col("_slice") < last) & (F.col("_quota") > 0))
    return sure.unionByName(edge).select("doc", "size", "source_size", "target", (F.col("_whole") + F.col("_more").cast("int")).cast("int").alias("copies"))


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """id, source and number of words of each row, written once: all that an allocation needs."""
    return stash(docs.select(id_col, source_col, words_in(F.col(text_col)).alias("_words")), "words")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The columns of docs, each row as often as the mix takes it."""
    return allocate(docs, **options).where("copies > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")


#: The rows of op10, for DuckDB.
ORACLE = r"""
WITH rows AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         (CAST('0x' || substr(md5('mix:' || CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM documents),
sizes AS (SELECT source, count(*) AS n_docs, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         CAST(source_size * 3 AS DOUBLE) AS most FROM sizes),
levels AS (
  SELECT *, ((SELECT CAST(sum(source_size) AS DOUBLE) FROM sizes)
         - coalesce(sum(most) OVER (ORDER BY most / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY most / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
plan AS (SELECT source, n_docs, source_size, least(max(level) OVER () * weight, most) AS target FROM levels),
rated AS (
  SELECT r.doc_id, r.source, r.size, r.u, p.n_docs, p.source_size, p.target,
         CASE WHEN p.source_size > 0 THEN p.target / p.source_size ELSE 0 END AS rate
  FROM rows r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source),
parts AS (
  SELECT *, CAST(floor(rate) AS BIGINT) AS whole, target - floor(rate) * source_size AS quota,
         least(0.999999::DOUBLE, greatest(0.000001::DOUBLE, (rate - floor(rate)) * least(2.0::DOUBLE, greatest(0.5::DOUBLE, CAST(size AS DOUBLE) * n_docs / greatest(source_size, 1))))) AS p
  FROM rated),
keyed AS (SELECT *, (u / (1 - u)) * ((1 - p) / p) AS odds FROM parts),
summed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY odds / (1 + odds), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM keyed)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST(size * (whole + CASE WHEN quota > 0 AND before + size / 2.0 <= quota THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM summed
"""
