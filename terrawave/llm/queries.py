"""Queries of this subpackage, by name, and the SQL that gives their rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrawave.llm import conversations, embedding_dedup, fill_middle, language_id, line_dedup, mixing, near_dedup, packing, quality, spotsigs, suffix_dedup, toxicity, warc
from terrawave.llm.folds import fold

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated and nearly repeated lines."""
    rows = line_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc.doc_id", "n_lines", "n_removed", "text")


def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return spotsigs.compared(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learnt from three quarters of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = fold(F.col("doc_id"), 4) == 2
    model = language_id.train(docs.where(~held))
    return language_id.predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from three quarters of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, toxic_labels(spark, sf_dir))
    return _predicted(toxicity.score(docs, model), fold(F.col("doc_id"), 4) == 2)


def toxic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, label of the training rows."""
    rows = table(spark, sf_dir, "labels").where((fold(F.col("doc_id"), 4) != 2) & F.col("toxic").isNotNull())
    return rows.select("doc_id", F.col("toxic").alias("label"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learnt from four fifths of the positive labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = fold(F.col("doc_id"), 5) == 0
    good = table(spark, sf_dir, "labels").where(~held & (F.col("quality") == 1)).select("doc_id")
    return _predicted(quality.score(docs, quality.train(docs, good)), held)


def _predicted(scores: DataFrame, held) -> DataFrame:
    return scores.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 1024 ids."""
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written as WARC records and read back."""
    found = warc.resolved(warc.read(warc.write(table(spark, sf_dir, "pages"))))
    return found.withColumnRenamed("record_id", "page_id")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    rows = mixing.allocate(mixing.counted(table(spark, sf_dir, "documents")), size_col="_words")
    return rows.select("doc.doc_id", "size", "source_size", F.round("target", 6).alias("target"), (F.col("size") * F.col("copies")).alias("taken"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of all damaged conversations."""
    rows = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.digests(rows, conversations.audits(rows)).withColumnRenamed("conv", "conv_id")


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut and put in another order, and put together again."""
    rows = fill_middle.transformed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    again = fill_middle.restored(F.col("output"), F.col("form"))
    return rows.select("doc.doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes that repeat earlier ones."""
    rows = suffix_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def queries() -> dict[str, Callable]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op8_warc": warc.ORACLE, "op9_embedding_dedup": embedding_dedup.ORACLE, "op10_mixing": mixing.ORACLE, "op11_conversation_repair": conversations.ORACLE, "op12_fill_middle": fill_middle.ORACLE}
