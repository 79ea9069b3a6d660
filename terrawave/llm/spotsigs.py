"""Document fingerprints by spot signatures.

Every occurrence of an anchor, a very common word, starts a chain of the next CHAIN content words; anchor and chain hash
to a signature. Where common words are few, so would signatures be: therefore the first word of every text, and one in
SPARE content words, by their hash, start chains too, in all texts alike. The set of a text's signatures, in hexadecimal
and in order, is its fingerprint, and two fingerprints are compared by the Jaccard similarity of their sets. A text
without words has the empty fingerprint, unless it has white space, which then is its signature.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrawave.llm.language_id import letters
from terrawave.llm.text import KNOWN, mix, seed

CHAIN, SPARE = 2, 8
PER_BUCKET, BUCKETS = 2_000, 10_000  # documents in a bucket of neighbours, and buckets at most

# Anchors and further common words that chains pass over, by language.
ANCHORS = {
    "en": "a an be can did do had has is said that the this was were will",
    "fr": "au ce cette des est la le les que qui un une",
    "de": "das dem den der die ein eine ist nicht sie sich wird",
    "es": "del el ella es esta la las los que se un una",
}
PASSED = {
    "en": "about and are as at but by for from have he her his i if in into it its not of on or our she so their they to we which who with you",
    "fr": "ai aux avec dans de du elle en et eu il ils je leur mais ne nous on ou par pas plus pour sa se ses son sur tu vous",
    "de": "als am an auf aus bei bin bis er es für hat ich im in mit nach noch nur oder so um und von vor war was wie wir zu zum zur",
    "es": "a al como con de en entre eso esto fue ha hay ir lo me mi más muy no o para pero por si sin sobre su sus te tu y ya yo",
}
_ANCHORS = frozenset(w for s in ANCHORS.values() for w in s.split())
_COMMON = _ANCHORS | frozenset(w for s in PASSED.values() for w in s.split())


class Spots(dict):
    """Hashes of raw words, with the two lowest bits telling content words (0), passed words (1) and anchors (3)."""

    def __missing__(self, raw: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        word = letters(raw) or raw.decode("utf-8", "replace")
        kind = 3 if word in _ANCHORS else 1 if word in _COMMON else 0
        self[raw] = h = xxhash.xxh3_64_intdigest(word) & ~3 | kind
        return h


def signatures(text: str, known: Spots) -> np.ndarray:
    """Sorted distinct 32-bit signatures of a text."""
    raw = text.encode("utf-8", "replace").split()
    if not raw:
        return np.array([xxhash.xxh32_intdigest(text.encode("utf-8", "replace"))], np.uint32) if text else np.empty(0, np.uint32)
    h = np.fromiter(map(known.__getitem__, raw), np.uint64, len(raw))
    kind = (h & np.uint64(3)).astype(np.int8)
    content = np.flatnonzero(kind == 0)
    starts = (kind == 3) | ((kind == 0) & ((h >> np.uint64(2)) % np.uint64(SPARE) == 0))
    starts[0] = True
    spots = np.flatnonzero(starts)
    first = np.searchsorted(content, spots, side="right")
    c = np.concatenate([h[content], np.zeros(CHAIN, np.uint64)])
    sig = mix(h[spots])
    for i in range(CHAIN):
        sig = mix(sig + c[np.minimum(first + i, len(content))] + seed(i + 1))
    return np.unique((sig >> np.uint64(32)).astype(np.uint32))


def text_of(sigs: np.ndarray) -> str:
    return sigs.astype(">u4").tobytes().hex()


def set_of(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4")


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two sets; 0 without a look at their members if their sizes alone keep it below `least`."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < least * large or not small:
        return 0.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (small + large - shared)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint of each row; a null text is an empty one. Equal texts have equal fingerprints."""

    def run(batches):
        known = Spots()
        for batch in batches:
            out = [text_of(signatures(t or "", known)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, fingerprint string")


def near_duplicates(prints: DataFrame, least: float = 0.75) -> DataFrame:
    """a, b, similarity of unlike fingerprints with a Jaccard similarity of `least` or more, and each fingerprint's smallest doc_id stands for its copies.

    Sets are partitioned by length so that only a partition and the next can hold similar ones; within them, two sets must share a signature among the rarest of either, and only such pairs are compared in full.
    """
    reps = prints.where("fingerprint <> ''").groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"))
    n = F.length("fingerprint") / 8
    sigs = reps.select("doc_id", n.cast("int").alias("n"), F.explode(F.expr("transform(sequence(0, cast(length(fingerprint) / 8 as int) - 1), i -> substring(fingerprint, i * 8 + 1, 8))")).alias("sig"))
    df = sigs.groupBy("sig").agg(F.count("*").alias("df"))
    rank = Window.partitionBy("doc_id").orderBy("df", "sig")
    rare = sigs.join(df, "sig").withColumn("r", F.row_number().over(rank)).where(F.col("r") <= F.col("n") - F.ceil(F.col("n") * least) + 1)
    part = F.floor(F.log("n") / -math.log(least) + 1e-9)
    x = rare.select("sig", F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.explode(F.array(part, part + 1)).alias("part"))
    y = rare.select("sig", F.col("doc_id").alias("b"), F.col("n").alias("n_b"), part.alias("part"))
    pairs = x.join(y, ["sig", "part"]).where((F.col("a") != F.col("b")) & (F.col("n_a") <= F.col("n_b")) & (F.col("n_a") >= F.col("n_b") * least)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    full = pairs.join(reps.select(F.col("doc_id").alias("a"), F.col("fingerprint").alias("f_a")), "a").join(reps.select(F.col("doc_id").alias("b"), F.col("fingerprint").alias("f_b")), "b")

    def run(batches):
        for batch in batches:
            out = [likeness(set_of(p), set_of(q), least) for p, q in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], ["a", "b", "similarity"])

    return full.select("a", "b", "f_a", "f_b").mapInArrow(run, "a long, b long, similarity double").where(F.col("similarity") >= least)


def in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows in buckets of descending doc_id, each bucket followed by copies (guard = true) of the first rows of the next, and sorted within partitions. Only texts that head a bucket move twice, and a bucket holds about PER_BUCKET rows."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    key = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))
    n = rows.count()
    k = max(1, min(BUCKETS, n // PER_BUCKET))
    cuts = sorted(set(rows.select(key.alias("k")).agg(F.percentile_approx("k", [i / k for i in range(1, k)], 20 * k)).first()[0] or [])) if k > 1 else []
    splits = [-float("inf"), *(c for c in cuts if math.isfinite(c)), float("inf")]
    rows = rows.withColumn("key", key)
    if len(splits) > 2:
        rows = Bucketizer(splits=splits, inputCol="key", outputCol="bucket").transform(rows).withColumn("bucket", (F.lit(len(splits) - 2) - F.col("bucket")).cast("int"))
    else:
        rows = rows.withColumn("bucket", F.lit(0))
    heads = {r["bucket"]: r["head"] for r in rows.groupBy("bucket").agg(F.max("key").alias("head")).collect()}  # BUCKETS rows at most
    order = sorted(heads)
    before = [(b, order[i - 1], heads[b]) for i, b in enumerate(order)]  # the head of b also closes the bucket before it; the first closes the last
    table = docs.sparkSession.createDataFrame(before, "bucket int, closes int, head double")
    rows = rows.join(F.broadcast(table), "bucket", "left")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guard"))
    also = F.struct(F.col("closes").alias("bucket"), F.lit(True).alias("guard"))
    rows = rows.select("doc_id", "text", F.explode(F.when(F.col("key") == F.col("head"), F.array(own, also)).otherwise(F.array(own))).alias("to"))
    rows = rows.select(F.col("to.bucket").alias("bucket"), F.col("to.guard").alias("guard"), "doc_id", "text")
    return rows.repartition("bucket").sortWithinPartitions("bucket", "guard", F.desc_nulls_last("doc_id"), F.xxhash64("text"), "text")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many first characters of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The next row is that of the next smaller id, after the last the first; rows of one id follow each other in an order of their texts."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def following(batches) -> Iterator[tuple]:
        """Each row that is no guard, with the text after it in its bucket."""
        held = None
        for batch in batches:
            texts = batch.column(3)
            for i, (bucket, guard, doc_id) in enumerate(zip(*(batch.column(j).to_pylist() for j in range(3)), strict=True)):
                text = texts[i].as_py()
                if held and held[0] == bucket:
                    yield held[1], held[2], text
                held = None if guard else (bucket, doc_id, text)

    def run(batches):
        known, out, size, last = Spots(), [], 0, (None, None)
        for doc_id, text, after in following(batches):
            sigs = last[1] if last[0] is text else signatures(text, known)
            after_sigs = signatures(after, known)
            last = (after, after_sigs)
            changed = edited(text, after)
            c = signatures(changed, known)
            out.append((doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(), text_of(sigs), text_of(c), likeness(sigs, c), likeness(sigs, after_sigs)))
            size += len(text)
            if size > 2_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return in_order(docs, id_col, text_col).mapInArrow(run, schema)
