"""Removal of bytes that a LENGTH-byte string covers which also starts earlier, by sorting suffixes.

Every string of LENGTH bytes has a key, the least hash of the GRAM-byte strings in it, so equal strings share theirs.
Neighbouring strings of a document mostly share it too: a stretch of them is sent once, with its bytes, to the bucket of
its key. Stretches whose key is alone cannot repeat. In a bucket the suffixes of the others are sorted deep-shallow:
multikey quicksort, eight bytes a step, to SHALLOW bytes, then a blind trie for each group that is still tied, built from
its root: the common prefix of all members is skipped, and they part by the byte behind it. Suffixes that are equal to
LENGTH bytes are one class; all but the first in the order of documents are repeats.

* Equal stretches are merged before they are sent, in batches of a task, and again in the bucket before the sort; only
  the first of them can be the first of a class.
* A key in a great share of all stretches would fill its bucket. Strings with such a key take the least hash among their
  other grams, and so part by what stands around the frequent gram. Which keys are frequent changes no result.
* Buckets grow in number with the bytes; each holds about BUCKET bytes of text.

Documents are in the order of their id, null first; rows of one id with unlike texts go by a checksum of the text.
Repeated rows (equal in id and text) are one document, and each of them gets its result. A null text has no bytes. A
table needs one column besides the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrawave.session import release, stash

LENGTH, GRAM = 100, 16
BUCKET = 8 << 20  # bytes of text for a bucket
BATCH, SLICE = 6 << 20, 1 << 20  # bytes of text whose equal stretches are merged, and whose hashes are held
MOST = 256  # strings of a stretch
DOUBLE = 1 << 15  # added to their number where two of them may be equal
SHALLOW = 24
LEVEL = 3  # of compression of what is sent
CHUNK = 400_000  # suffixes sorted at once, but for those of one key
SAMPLED, FREQUENT, SHARE = 32, 10_000, 1_000_000  # one stretch in so many is counted; a key is frequent from so many stretches, and from one in SHARE of all
TOP = np.uint64(1 << 63)
C1, C2, C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as numbers."""
    return np.ndarray(max(0, len(data) - 7), "<u8", data, strides=(1,))


def minima(data: np.ndarray, frequent: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """The key of the string at each place, the least hash of its grams (those of frequent ones come after all others), and whether it is that of its first gram."""
    h = _words(data) * C1
    h ^= h >> np.uint64(31)
    h = h[:-8] * C2 + h[8:]  # of GRAM bytes
    h ^= h >> np.uint64(29)
    h *= C3
    h >>= np.uint64(1)
    if len(frequent):
        known = np.zeros(1 << 16, bool)
        known[(frequent & np.uint64(0xFFFF)).astype(np.int64)] = True
        at = np.flatnonzero(known[(h & np.uint64(0xFFFF)).astype(np.int64)])
        h[at[np.isin(h[at], frequent)]] |= TOP
    first, width, left = h, 1, length - GRAM + 1
    while 2 * width <= left:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    h = np.minimum(h[: len(h) - (left - width)], h[left - width :]) if left > width else h
    return h, h == first[: len(h)]


def stretches(data: np.ndarray, limits: list[tuple[int, int]], frequent: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and key of the stretches of strings that share a key, and whether the gram of the key repeats in them, so that a stretch may hold equal strings; limits are the ends of the documents in data."""
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)
    low, leads = minima(data, frequent, length)
    whole = np.zeros(len(low), bool)
    for a, b in limits:
        whole[a : max(a, b - length + 1)] = True
    cut = np.flatnonzero((low[1:] != low[:-1]) | (whole[1:] != whole[:-1])) + 1
    starts = np.concatenate(([0], cut))
    ends = np.append(cut, len(low))
    starts, ends = starts[whole[starts]], ends[whole[starts]]
    pieces = -(-(ends - starts) // MOST)
    first = np.repeat(starts, pieces)
    nth = np.arange(len(first)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = first + nth * MOST
    ends = np.minimum(starts + MOST, np.repeat(ends, pieces))
    before = np.concatenate(([0], np.cumsum(leads)))
    return starts, ends, low[starts], before[ends - 1] > before[starts]


def _slices(docs: list[tuple[int, int, bytes]], length: int) -> Iterator[tuple[bytes, list[tuple[int, int, int, int]]]]:
    """Bytes of about SLICE, with document, place in it, and start and end in these bytes, of each piece; pieces of a long document overlap by a string less a byte."""
    parts, table, size = [], [], 0
    for i, (_, _, text) in enumerate(docs):
        for at in range(0, max(1, len(text) - length + 1), SLICE):
            piece = text[at : at + SLICE + length - 1]
            if size and size + len(piece) > SLICE + length:
                yield b"".join(parts), table
                parts, table, size = [], [], 0
            parts.append(piece)
            table.append((i, at, size, size + len(piece)))
            size += len(piece)
    if parts:
        yield b"".join(parts), table


def _planes(x: np.ndarray) -> bytes:
    """Bytes of equal worth together, as they compress better so."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


_FIELDS = (("tag", "<u4"), ("doc", "<i8"), ("sum", "<i8"), ("at", "<i8"), ("n", "<u2"))


def _packed(rows: dict[str, np.ndarray], texts: bytes) -> bytes:
    rows = rows | {"doc": np.diff(rows["doc"], prepend=np.int64(0))}
    body = len(rows["at"]).to_bytes(8, "little") + b"".join(_planes(rows[c].astype(kind)) for c, kind in _FIELDS) + texts
    return zstandard.compress(body, LEVEL)


def _unpacked(part: bytes) -> tuple[dict[str, np.ndarray], bytes]:
    body = zstandard.decompress(part)
    n, at, rows = int.from_bytes(body[:8], "little"), 8, {}
    for c, kind in _FIELDS:
        size = np.dtype(kind).itemsize
        rows[c] = np.frombuffer(body, np.uint8, n * size, at).reshape(size, n).T.copy().view(kind).ravel()
        at += n * size
    rows["doc"] = np.cumsum(rows["doc"])
    return rows, body[at:]


def _cut(docs: list[tuple[int, int, bytes]], buckets: int, frequent: np.ndarray, length: int) -> Iterator[tuple[int, bool, bytes]]:
    """Bucket, whether the rows are repeats already, and the packed stretches of these documents, which come in order."""
    seen: dict[bytes, int] = {}
    names = ("key", "doc", "sum", "at", "n")
    new: dict[str, list] = {c: [] for c in names}
    old: dict[str, list] = {c: [] for c in names}
    texts: list[bytes] = []
    for data, table in _slices(docs, length):
        starts, ends, keys, inner = stretches(np.frombuffer(data, np.uint8), [(a, b) for *_, a, b in table], frequent, length)
        which = np.searchsorted([a for *_, a, _ in table], starts, "right") - 1
        for a, b, key, w, double in zip(starts.tolist(), ends.tolist(), keys.tolist(), which.tolist(), inner.tolist(), strict=True):
            text = data[a : b + length - 1]
            i, at, begin, _ = table[w]
            row = (key, docs[i][0], docs[i][1], at + a - begin, b - a + DOUBLE * double)
            first = seen.setdefault(text, len(texts))
            if first == len(texts):
                texts.append(text)
                put = new
            elif (new["doc"][first], new["sum"][first], new["at"][first]) == row[1:4]:
                continue  # the row itself, repeated
            else:
                put = old
            for c, v in zip(names, row, strict=True):
                put[c].append(v)
    if old["at"]:
        rows = {c: np.array(v, np.uint64 if c == "key" else np.int64) for c, v in old.items()} | {"tag": np.zeros(len(old["at"]), np.uint32)}
        rows["n"] %= DOUBLE
        yield int(rows["key"][0] >> np.uint64(32)) % buckets, True, _packed(_joined(rows), b"")
    if texts:
        rows = {c: np.array(v, np.uint64 if c == "key" else np.int64) for c, v in new.items()}
        rows["tag"] = (rows["key"] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        bucket = ((rows["key"] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        for part in np.split(order, cuts):
            yield int(bucket[part[0]]), False, _packed({c: v[part] for c, v in rows.items()}, b"".join([texts[i] for i in part]))


def _joined(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Stretches of a document that follow one another as one, as long as their number of strings allows."""
    doc, key, at, n = (rows[c] for c in ("doc", "sum", "at", "n"))
    new = np.ones(len(at), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]) | (at[1:] != at[:-1] + n[:-1])
    # No more strings than fit the field: a stretch has MOST at most.
    nth = np.arange(len(at)) - np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    new |= nth % (DOUBLE // MOST - 1) == 0
    heads = np.flatnonzero(new)
    return {c: rows[c][heads] for c in ("tag", "doc", "sum", "at")} | {"n": np.add.reduceat(n, heads)}


def _lcp(words: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int, known: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, depth at most; known bytes are equal."""
    out = np.full(len(a), depth, np.int64)
    left = np.arange(len(a))
    for j in range(known, depth, 8):
        x = words[a[left] + j] ^ words[b[left] + j]
        far = np.flatnonzero(x)
        y = x[far]
        out[left[far]] = np.minimum(depth, j + np.bitwise_count((y & (~y + np.uint64(1))) - np.uint64(1)) // 8)
        left = left[x == 0]
        if not len(left):
            break
    return out


def _tied(new: np.ndarray) -> np.ndarray:
    """Places of an order whose group has two members or more; new marks the first of each group."""
    return np.flatnonzero(~(new & np.append(new[1:], True)))


def deep_shallow(data: np.ndarray, starts: np.ndarray, depth: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes at starts by their first depth bytes, and which places of it begin a class of equal ones; data goes on for 8 bytes after the last suffix."""
    words = _words(data)
    key = words[starts].byteswap()
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.ones(len(order), bool)
    new[1:] = key[1:] != key[:-1]
    for at in range(8, min(SHALLOW, depth), 8):  # multikey quicksort, eight bytes being a letter
        pos = _tied(new)
        if not len(pos):
            break
        group = np.cumsum(new)[pos]
        key = words[starts[order[pos]] + at].byteswap()
        if at + 8 > depth:
            key >>= np.uint64(8 * (at + 8 - depth))
        sub = np.lexsort((key, group))
        order[pos] = order[pos][sub]
        key = key[sub]
        new[pos[1:]] |= key[1:] != key[:-1]
    if depth <= SHALLOW:
        return order, new
    pos, known = _tied(new), SHALLOW
    while len(pos):  # blind tries of all groups at once, a node of each in a turn
        heads = np.flatnonzero(new[pos])
        group = np.cumsum(new[pos]) - 1
        here = starts[order[pos]]
        skip = np.minimum.reduceat(_lcp(words, here, here[heads][group], depth, known), heads)
        part = (skip < depth)[group]  # the rest are leaves
        pos, group, here = pos[part], group[part], here[part]
        byte = data[here + skip[group]]
        sub = np.lexsort((byte, group))
        order[pos] = order[pos][sub]
        byte = byte[sub]
        new[pos[1:]] |= (group[1:] == group[:-1]) & (byte[1:] != byte[:-1])
        flags = np.append(new[pos[1:]] | (group[1:] != group[:-1]), True) if len(pos) else np.empty(0, bool)
        pos = pos[~(new[pos] & flags)]
    return order, new


def _repeats(rows: dict[str, np.ndarray], texts: list[bytes], length: int) -> dict[str, np.ndarray]:
    """doc, sum, at, n of stretches of strings that start earlier too, from all stretches of a bucket."""
    order = np.lexsort((rows["at"], rows["sum"], rows["doc"]))
    rows = {c: v[order] for c, v in rows.items()}
    same = np.zeros(len(order), bool)
    same[1:] = (rows["doc"][1:] == rows["doc"][:-1]) & (rows["sum"][1:] == rows["sum"][:-1]) & (rows["at"][1:] == rows["at"][:-1])
    rows, order = {c: v[~same] for c, v in rows.items()}, order[~same]
    double, rows["n"] = rows["n"] >= DOUBLE, rows["n"] % DOUBLE
    _, group, size = np.unique(rows["tag"], return_inverse=True, return_counts=True)
    seen: dict[bytes, int] = {}
    shared = np.flatnonzero((size[group] > 1) | double)
    first = np.array([seen.setdefault(texts[order[i]], i) == i for i in shared.tolist()], bool)
    found = [{c: rows[c][shared[~first]] for c in ("doc", "sum", "at", "n")}]  # equal to an earlier stretch
    left = shared[first]
    left = left[(np.bincount(group[left], minlength=len(size))[group[left]] > 1) | double[left]]
    left = left[np.argsort(group[left], kind="stable")]  # keys together, in the order of documents within
    if len(left):
        total = np.cumsum(rows["n"][left])
        fresh = np.flatnonzero(np.diff(group[left], prepend=-1))
        at = 0
        while at < len(left):
            ends = np.append(fresh[fresh > at], len(left))
            within = ends[total[ends - 1] - (total[at - 1] if at else 0) <= CHUNK]
            stop = int(within[-1]) if len(within) else int(ends[0])
            found.append(_sorted({c: rows[c][left[at:stop]] for c in ("doc", "sum", "at", "n")}, [texts[i] for i in order[left[at:stop]].tolist()], length))
            at = stop
    return {c: np.concatenate([f[c] for f in found]) for c in ("doc", "sum", "at", "n")}


def _sorted(rows: dict[str, np.ndarray], texts: list[bytes], length: int) -> dict[str, np.ndarray]:
    """The repeats among the suffixes of these stretches; of two of one key the earlier stands first."""
    data = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    n = rows["n"].astype(np.int64)
    owner = np.repeat(np.arange(len(n)), n)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    order, new = deep_shallow(data, (np.cumsum(sizes) - sizes)[owner] + nth, length)
    heads = np.flatnonzero(new)
    repeat = np.empty(len(order), bool)
    repeat[order] = order != np.repeat(np.minimum.reduceat(order, heads), np.diff(np.append(heads, len(order))))
    start = repeat.copy()
    start[1:] &= ~repeat[:-1] | (owner[1:] != owner[:-1])
    a = np.flatnonzero(start)
    stop = repeat.copy()
    stop[:-1] &= ~repeat[1:] | (owner[1:] != owner[:-1])
    b = np.flatnonzero(stop)
    return {"doc": rows["doc"][owner[a]], "sum": rows["sum"][owner[a]], "at": rows["at"][owner[a]] + nth[a], "n": b - a + 1}


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    sum_ = F.when(F.col(id_col).isNull(), F.xxhash64(text)).otherwise(F.crc32(text))
    return docs.select(F.struct("*").alias("doc"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("_id"), sum_.cast("long").alias("_sum"), text.cast("binary").alias("_bytes"))


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, bytes]]]:
    held, size = [], 0
    for batch in batches:
        for i, name, total in zip(range(batch.num_rows), batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held.append((name, total, batch.column(2)[i].as_py()))
            size += len(held[-1][2])
            if size >= BATCH:
                yield sorted(held, key=lambda r: r[:2])
                held, size = [], 0
    if held:
        yield sorted(held, key=lambda r: r[:2])


def survey(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> tuple[int, np.ndarray]:
    """Bytes of all texts, and the keys in a great share of their stretches; SHARE bounds their number."""
    slim = _keyed(docs, id_col, text_col).select("_id", "_sum", "_bytes")
    nothing = np.empty(0, np.uint64)

    def run(batches):
        for held in _batches(batches):
            keys = [stretches(np.frombuffer(d, np.uint8), [(a, b) for *_, a, b in t], nothing, length)[2][::SAMPLED] for d, t in _slices(held, length)]
            keys, n = np.unique(np.concatenate(keys), return_counts=True) if keys else (nothing, np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([sum(len(t) for *_, t in held)] + [0] * len(keys)), pa.array([None, *keys.astype(np.int64).tolist()], pa.int64()), pa.array([0, *n.tolist()], pa.int64())], ["size", "key", "n"])

    counts = stash(slim.mapInArrow(run, "size long, key long, n long").groupBy("key").agg(F.sum("size").alias("size"), F.sum("n").alias("n")), "keys")
    total = F.sum(F.coalesce(F.col("size"), F.lit(0)))
    size, n = counts.agg(total, F.sum("n")).first() or (0, 0)
    least = max(FREQUENT, (n or 0) * SAMPLED // SHARE) // SAMPLED
    frequent = counts.where(F.col("key").isNotNull() & (F.col("n") >= least)).select("key").collect() if n and n >= least else []
    release(counts)
    return size or 0, np.sort(np.array([r[0] for r in frequent], np.uint64))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """_id, _sum, at, n: stretches of places in a document at which a string of so many bytes begins that starts earlier too."""
    size, frequent = survey(docs, id_col, text_col, length)
    buckets = max(1, -(-size // BUCKET))
    slim = _keyed(docs, id_col, text_col).select("_id", "_sum", "_bytes")

    def cut(batches):
        for held in _batches(batches):
            for bucket, known, packed in _cut(held, buckets, frequent, length):
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([known]), pa.array([packed], pa.binary())], ["bucket", "known", "part"])

    def sort(part: pd.DataFrame) -> pd.DataFrame:
        found, rows, texts = [], [], []
        for known, packed in zip(part["known"], part["part"], strict=True):
            table, body = _unpacked(packed)
            if known:
                found.append(table)
                continue
            rows.append(table)
            at = np.concatenate(([0], np.cumsum(table["n"].astype(np.int64) % DOUBLE + length - 1))).tolist()
            texts += [body[a:b] for a, b in zip(at, at[1:], strict=False)]
        if rows:
            found.append(_repeats({c: np.concatenate([r[c] for r in rows]) for c, _ in _FIELDS}, texts, length))
        return pd.DataFrame({n: np.concatenate([f[c] for f in found]).astype(np.int64) for n, c in (("_id", "doc"), ("_sum", "sum"), ("at", "at"), ("n", "n"))})

    return slim.mapInArrow(cut, "bucket long, known boolean, part binary").groupBy("bucket").applyInPandas(sort, "_id long, _sum long, at long, n long")


def _compressed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc (a struct of the columns of docs but for the text), _id, _sum, and the text's bytes in few, as they are sent on."""
    rows = _keyed(docs, id_col, text_col)
    rows = rows.select(F.col("doc").dropFields(text_col).alias("doc"), "_id", "_sum", "_bytes")

    def run(batches):
        for batch in batches:
            packed = pa.array([zstandard.compress(t.as_py(), LEVEL) for t in batch.column(3)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), packed], ["doc", "_id", "_sum", "_packed"])

    return rows.mapInArrow(run, rows.drop("_bytes").schema.add("_packed", "binary"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """doc (a struct of the columns of docs but for the text), n_bytes, n_removed, n_spans, kept (the bytes that stay; a cut may split a character)."""
    spans = repeats(docs, id_col, text_col, length).groupBy("_id", "_sum").agg(F.collect_list(F.struct("at", "n")).alias("_spans"))
    rows = _compressed(docs, id_col, text_col).join(spans, ["_id", "_sum"], "left").select("doc", "_packed", F.col("_spans.at").alias("_at"), F.col("_spans.n").alias("_n"))
    schema = rows.select("doc").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary")

    def run(batches):
        for batch in batches:
            packed, at, n = (batch.column(i) for i in (1, 2, 3))
            begin = size = 0
            made = []
            for i, part in enumerate(packed):
                text = zstandard.decompress(part.as_py())
                made.append((len(text), *(_kept(text, at[i].values, n[i].values, length) if at[i].is_valid else (0, 0, text))))
                size += len(text)
                if size >= BATCH or i + 1 == len(packed):
                    columns = [pa.array(c, k) for c, k in zip(zip(*made, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, i + 1 - begin), *columns], ["doc", "n_bytes", "n_removed", "n_spans", "kept"])
                    begin, size, made = i + 1, 0, []

    return rows.mapInArrow(run, schema)


def _kept(text: bytes, at: pa.Array, n: pa.Array, length: int) -> tuple[int, int, bytes]:
    """Removed bytes, runs of them, and what stays."""
    a, n = at.to_numpy(), n.to_numpy()
    order = np.argsort(a, kind="stable")
    a, b = a[order], (a + n + length - 1)[order]
    reach = np.maximum.accumulate(b)
    new = np.ones(len(a), bool)
    new[1:] = a[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    starts, ends = a[heads].tolist(), reach[np.append(heads[1:] - 1, len(a) - 1)].tolist()
    kept = b"".join(text[x:y] for x, y in zip([0, *ends], [*starts, len(text)], strict=True))
    return len(text) - len(kept), len(starts), kept
