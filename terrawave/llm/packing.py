"""Packing of tokenised documents into sequences of fixed length: shortest pack first over the length histogram.

Documents are cut into pieces of at most LENGTH ids. The histogram of piece lengths (LENGTH rows at most) is packed on
the driver: lengths are placed longest first, each into the pattern with the most room that fits, and only counts of
patterns change. The slots of the patterns are then joined back to the pieces by length and rank.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrawave.session import stash

LENGTH = 1024
PER_BUCKET = 20_000  # pieces ranked together


# Fixed value: the pre-tokens of byte-level BPE.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_DEEP = re.compile(r"\s{1000}").search


def _merger(definition: dict):
    """A function from a text to its ids, for a byte-level tokenizer whose merges stand in the order of their ids; else None.

    Merging the pair with the least id first is then the same as merging by the list; merges of one token in two ways, or out of order, are left to the tokenizer itself.
    """
    model = definition.get("model", {})
    vocab, merges = model.get("vocab"), model.get("merges")
    kind = definition.get("pre_tokenizer") or {}
    plain = kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space") and not definition.get("normalizer")
    if not plain or model.get("type") != "BPE" or any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")):
        return None
    made = [vocab.get("".join(x) if isinstance(x, list) else x.replace(" ", "", 1)) for x in merges]
    if None in made or any(x >= y for x, y in zip(made, made[1:], strict=False)):
        return None
    printed = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    byte = {chr(b if b in printed else next(others)): b for b in range(256)}  # the letter that stands for each byte
    ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if all(c in byte for c in t)}
    if len(ranks) < 256 or len(made) and min(made) <= max(ranks[bytes([b])] for b in range(256)):
        return None
    import tiktoken

    return tiktoken.Encoding("bytes", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Ids:
    """Ids of texts as little-endian 32-bit bytes, without special tokens; nothing is remembered between texts.

    A text with a special token in it, or with so much white space in a row that cutting it would go too deep, is left to
    the tokenizer itself, as is any tokenizer of another kind.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.merge = _merger(json.loads(tokenizer.to_str()))

    def of(self, text: str) -> bytes:
        if self.merge is None or any(s in text for s in self.special) or _DEEP(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return array("I", self.merge(text)).tobytes()


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens (and ids, little-endian 32-bit) of each piece. Each document ends with id 0; a null text is empty."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids

    def run(batches):
        from tokenizers import Tokenizer

        known = Ids(Tokenizer.from_file(tokenizer_path))
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = known.of(text or "") + b"\0\0\0\0"
                n = len(ids) // 4
                for start in range(0, n, length):
                    piece = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), n, *[piece] * with_ids))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * (5 + with_ids)
            kinds = [pa.int64()] * 5 + [pa.binary()] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, schema)


def patterns(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how often each is used, for counts by length."""
    room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            free = max((r for r in room if r >= size and room[r]), default=None)
            if free is None:
                room[length - size].append((left, (size,)))
                break
            n, pattern = room[free].pop()
            if not room[free]:
                del room[free]
            used = min(n, left)
            if n > used:
                room[free].append((n - used, pattern))
            room[free - size].append((used, (*pattern, size)))
            left -= used
    return [(pattern, n) for packs in room.values() for n, pattern in packs]


def pack(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """cut (as of pieces, written or cheap to read twice) with sequence_id and offset. Ranks within a length are taken per bucket of about PER_BUCKET pieces, so no length meets in one task."""
    spark = cut.sparkSession
    hist = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # length rows at most
    slots, taken, base = [], defaultdict(int), 0
    for pattern, n in patterns(hist, length):
        at = 0
        for size in pattern:
            slots.append((size, taken[size], taken[size] + n, base, at))
            taken[size] += n
            at += size
        base += n
    buckets = max(16, sum(hist.values()) // PER_BUCKET)
    rows = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    counts = rows.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = rows.withColumn("_in", F.row_number().over(inside) - 1).join(stash(starts, "starts"), ["length", "_bucket"]).withColumn("_rank", F.col("_first") + F.col("_in"))
    # slots: at most two patterns for each of the lengths, whatever the input
    table = spark.createDataFrame(slots, "length long, _from long, _to long, _base long, offset long")
    placed = ranked.join(F.broadcast(table), ["length"]).where("_rank >= _from and _rank < _to")
    return placed.withColumn("sequence_id", F.col("_base") + F.col("_rank") - F.col("_from")).select(*cut.columns, "sequence_id", "offset")


def packed(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of docs with their places in sequences of at most length ids. An empty table gives an empty table."""
    return pack(stash(pieces(docs, tokenizer_path, id_col, text_col, length, with_ids), "pieces"), length)
