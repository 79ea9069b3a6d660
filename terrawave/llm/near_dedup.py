"""Near-duplicate documents by HyperMinHash.

Each text's set of five-word shingles is sketched into REGISTERS 16-bit registers. A shingle's hash picks a register
and gives it a value; a register keeps its least value as the number of leading zeros and a few mantissa bits. Hashing
is repeated in numbered rounds until no register is empty (a value of an earlier round is the lesser), so that small
sets fill all registers too and a register of two sets agrees with the probability of their Jaccard similarity.

BANDS groups of ROWS registers are hashed; two sets that agree in a band are candidates. A pair of similarity 0.75
meets in no band with a probability of (1 - 0.75^6)^64 = 4e-6. The share of equal registers, corrected for registers
that agree by collision, estimates the similarity; pairs far below the threshold go, and all others are verified on
the full sets. Thus no link rests on a sketch.

Documents of one set are one node. In a band's bucket every member is compared with one centre (its least id) first, and
those that this leaves apart with up to CENTRES more; then only members of different components are compared with each other, by
what sets them apart from the centre: two sets differ in just what their differences from the centre don't share, so a pair
is linked only if it shares enough of these, and it meets on the rarest. This leaves few pairs of a large group of near
copies, and loses no link.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrawave.llm.components import components
from terrawave.llm.text import WordHashes, mix, seed, shingle_sets, slices, words
from terrawave.session import release, small, stash

ROWS, BANDS = 6, 64
REGISTERS = ROWS * BANDS
BITS = 2  # of each register, for a first look at a pair
ROUNDS = 20  # of shared registers; what is empty then is filled by a round of its own for each register
LZ_BITS, MANTISSA_BITS = 5, 6
_OWN = np.array([seed(1000 + j) for j in range(REGISTERS)], np.uint64)
CENTRES = 3  # of a bucket, after the first
MARGIN = 0.12  # five standard errors of the estimate, sqrt(0.75 * 0.25 / 384) = 0.022


def registers_of(sets: list[np.ndarray]) -> np.ndarray:
    """uint16 registers [set, register] of non-empty sets: 5 bits round, 5 bits leading zeros, 6 bits mantissa."""
    n = len(sets)
    best = np.full(n * REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    x, doc = (np.concatenate(sets) if n else np.empty(0, np.uint64)), np.repeat(np.arange(n), sizes)
    for r in range(ROUNDS):
        h = mix(x + seed(2 * r + 1))
        bucket = ((h >> np.uint64(40)) % np.uint64(REGISTERS)).astype(np.int64)
        value = (np.uint64(r) << np.uint64(58)) | (mix(h) >> np.uint64(6))
        np.minimum.at(best, doc * REGISTERS + bucket, value)
        empty = best.reshape(n, REGISTERS).max(axis=1) == np.iinfo(np.uint64).max
        if not empty.any():
            break
        if not empty.all():
            keep = empty[doc]
            x, doc = x[keep], doc[keep]
    best = best.reshape(n, REGISTERS)
    for i in np.flatnonzero(best.max(axis=1) == np.iinfo(np.uint64).max):
        for part in np.array_split(empty := np.flatnonzero(best[i] == np.iinfo(np.uint64).max), 1 + len(empty) * len(sets[i]) // 1_000_000):
            value = mix(mix(sets[i][None, :] + _OWN[part][:, None])) >> np.uint64(6)
            best[i, part] = (np.uint64(ROUNDS) << np.uint64(58)) | value.min(axis=1)
    rounds, u = best >> np.uint64(58), (best & np.uint64((1 << 58) - 1)).astype(np.float64) / 2.0**58
    mantissa, exponent = np.frexp(np.maximum(u, 2.0**-58))
    lz = np.minimum(-exponent, (1 << LZ_BITS) - 1).astype(np.uint64)
    m = ((mantissa - 0.5) * 2 * (1 << MANTISSA_BITS)).astype(np.uint64)
    return ((rounds << np.uint64(LZ_BITS + MANTISSA_BITS)) | (lz << np.uint64(MANTISSA_BITS)) | m).astype(np.uint16)


def bits_of(regs: np.ndarray) -> list[list[int]]:
    """BITS well-mixed bits of each register, 64 in a long: bits of unlike registers agree by half."""
    h = mix(regs.astype(np.uint64) + seed(7))
    bit = np.concatenate([(h >> np.uint64(63 - i)) & np.uint64(1) for i in range(BITS)], axis=1).astype(np.uint8)
    return np.packbits(bit, axis=1).view(np.int64).tolist()


def collision_rate(per_register: np.ndarray) -> np.ndarray:
    """Probability that two registers of unlike minima agree, for sets with so many values in each register."""
    lz = np.arange(1 << LZ_BITS)
    m = np.arange(1 << MANTISSA_BITS) / (1 << MANTISSA_BITS)
    low = (2.0 ** -(lz[:, None] + 1.0) * (1 + m)).ravel()
    high = low + np.repeat(2.0 ** -(lz + 1.0), len(m)) / len(m)
    k = np.maximum(1.0, np.atleast_1d(per_register))[:, None]
    return (((1 - low) ** k - (1 - np.minimum(high, 1)) ** k) ** 2).sum(axis=1)


_GRID = 2.0 ** np.arange(0, 24)
_RATE = collision_rate(_GRID)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from registers, corrected for collisions."""
    equal = (a == b).mean(axis=1)
    c = np.interp(np.log2(np.maximum(1, (n_a + n_b) / 2 / REGISTERS)), np.arange(24), _RATE)
    return np.clip((equal - c) / (1 - c), 0, 1)


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, digest, regs and bits (BITS of each register, in longs) of each row; the last three are null for a set without shingles."""
    schema = "doc_id long, n_shingles long, digest binary, regs binary, bits array<long>"

    def run(batches):
        import xxhash

        known = WordHashes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for s in slices(texts):
                sets = shingle_sets(*known.of([words(t) for t in texts[s]]))
                full = [i for i, x in enumerate(sets) if len(x)]
                regs = registers_of([sets[i] for i in full])
                out: list = [(0, None, None, None)] * len(sets)
                bits = bits_of(regs)
                for r, b, i in zip(regs, bits, full, strict=True):
                    out[i] = (len(sets[i]), xxhash.xxh3_128_digest(sets[i].tobytes()), r.tobytes(), b)
                yield pa.RecordBatch.from_arrays([pa.array(ids[s], pa.int64()), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], pa.binary()), pa.array([x[3] for x in out], pa.list_(pa.int64()))], ["doc_id", "n_shingles", "digest", "regs", "bits"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, schema)


def sets_of(docs: DataFrame) -> DataFrame:
    """doc_id, shingles: the sorted distinct shingle hashes as bytes."""

    def run(batches):
        known = WordHashes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for s in slices(texts):
                sets = shingle_sets(*known.of([words(t) for t in texts[s]]))
                yield pa.RecordBatch.from_arrays([pa.array(ids[s], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], ["doc_id", "shingles"])

    return docs.mapInArrow(run, "doc_id long, shingles binary")


def _estimated(pairs: DataFrame, regs: DataFrame) -> DataFrame:
    """pairs(a, b) with est, the estimated similarity."""
    left = regs.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("n_a"), F.col("regs").alias("r_a"))
    right = regs.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("n_b"), F.col("regs").alias("r_b"))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("r_a", "r_b"))
            n_a, n_b = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("n_a", "n_b"))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(estimate(a, b, n_a, n_b))], ["a", "b", "est"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(run, "a long, b long, est double")


def _verified(pairs: DataFrame, sets: DataFrame, apart: bool = False) -> DataFrame:
    """pairs(a, b) with n_b, shared and total: the sizes of b's set, the intersection and the union of both full sets; and, if asked for, rest, the shingles that one of the two lacks."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("s_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("s_b"))
    names = ["a", "b", "n_b", "shared", "total", "rest"]

    def run(batches):
        for batch in batches:
            x, y = batch.column("s_a"), batch.column("s_b")
            out = []
            for i in range(batch.num_rows):
                p, q = np.frombuffer(x[i].as_py(), np.uint64), np.frombuffer(y[i].as_py(), np.uint64)
                lacks = q[~np.isin(q, p, assume_unique=True)] if len(p) else q
                k = len(q) - len(lacks)
                rest = np.concatenate([lacks, p[~np.isin(p, q, assume_unique=True)]]) if apart else lacks[:0]
                out.append((len(q), k, len(p) + len(q) - k, rest.view(np.int64)))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names)

    return pairs.join(left, "a").join(right, "b").select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long, n_b long, shared long, total long, rest array<long>")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs.

    Two texts are linked if 100 * |intersection| >= percent * |union| of their shingle sets. Null and blank texts have no shingles and stand alone. Rows that share an id are one node. Other columns of docs do no harm, whatever their names.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sk = stash(sketch(src), "sketch")
    copies = stash(sk.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1").select("digest", "rep"), "copies")
    member = stash(sk.select("doc_id", "n_shingles", "digest").join(small(copies), "digest", "left").select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep")), "member")
    regs = sk.where("digest is not null").join(small(copies), "digest", "left").where("rep is null or rep = doc_id").select("doc_id", "n_shingles", "regs", "bits")
    again = small(stash(sk.groupBy("doc_id").count().where("count > 1").select("doc_id"), "again"))  # only registers of repeated ids are shuffled
    regs = stash(regs.join(again, "doc_id", "left_anti").unionByName(regs.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])), "regs")
    release(sk)  # registers are kept once, for one text of each set

    width = 2 * ROWS
    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.col("regs").substr(i * width + 1, F.lit(width)))))
    bands = regs.select("doc_id", band.alias("key"))
    buckets = stash(bands.groupBy("key").agg(F.min("doc_id").alias("centre"), F.max("doc_id").alias("last"), F.count("*").alias("n")).where("n > 1"), "buckets")
    big = stash(buckets.where("n > 2").select("key", "centre"), "big")  # a bucket of two is a pair, and its bands aren't needed again
    members = stash(bands.join(small(big), "key"), "members")

    # Every member against its bucket's centre, as far as the estimate allows a link.
    pairs = buckets.where("n = 2").select(F.col("centre").alias("a"), F.col("last").alias("b")).unionByName(members.where("doc_id <> centre").select(F.col("centre").alias("a"), F.col("doc_id").alias("b"))).distinct()
    likely = F.col("est") >= percent / 100 - MARGIN
    star = _checked(_estimated(pairs, regs).where(likely).select("a", "b"), src)
    link = 100 * F.col("shared") >= percent * F.col("total")
    links = star.where(link).select("a", "b")
    root = stash(components(links), "root")

    # Further centres of the buckets that hold several components, before any of their other pairs.
    for _ in range(CENTRES):
        more = stash(_next_centres(members, root), "next")
        found = _checked(_estimated(more, regs).where(likely).select("a", "b"), src).where(link).select("a", "b")
        release(more)
        if found.isEmpty():
            break
        links = links.unionByName(found)
        root = stash(components(links), "root")

    # What is left: members of one bucket in different components.
    others = stash(_rest(members, root, src, regs.select("doc_id", "bits"), percent), "others")
    found = _checked(_estimated(others, regs).where(likely).select("a", "b"), src).where(link).select("a", "b")
    release(members, buckets, big, regs)
    if not found.isEmpty():
        root = stash(components(links.unionByName(found)), "root")
    out = member.join(small(root.withColumnRenamed("node", "rep")), "rep", "left").select("doc_id", "n_shingles", F.coalesce("root", "rep").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def _next_centres(members: DataFrame, root: DataFrame) -> DataFrame:
    """Pairs a, b: of each bucket's members outside its least component, the least one and those of other components than its own."""
    rows = members.select("key", "doc_id").join(small(root.withColumnRenamed("node", "doc_id")), "doc_id", "left").select("key", "doc_id", F.coalesce("root", "doc_id").alias("root"))
    least = rows.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("key", "r0")
    rows = rows.join(small(stash(least, "least")), "key").where("root <> r0").drop("r0")
    centre = rows.groupBy("key").agg(F.min("doc_id").alias("a"), F.min_by("root", "doc_id").alias("a_root"))
    return rows.join(small(stash(centre, "centre")), "key").where("root <> a_root").select("a", F.col("doc_id").alias("b")).distinct()


def _checked(pairs: DataFrame, src: DataFrame, rest: bool = False) -> DataFrame:
    """pairs(a, b) verified on the sets of src's texts, with the shingles that one of the two lacks if asked for; only texts in pairs are read into sets."""
    pairs = stash(pairs, "likely")
    wanted = stash(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "wanted")
    sets = stash(sets_of(src.join(small(wanted), "doc_id", "left_semi")).dropDuplicates(["doc_id"]), "sets")
    seen = _verified(pairs, sets, rest)
    seen = stash(seen if rest else seen.drop("rest"), "seen")
    release(pairs, wanted, sets)
    return seen


def _rest(members: DataFrame, root: DataFrame, src: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of one bucket in different components whose sets are similar enough.

    Of the centre c and two such texts x and y, let X be what only one of x and c has, and Y what only one of y and c has: x and y differ in |X| + |Y| - 2 |X & Y| shingles. They are linked if these are at most u (|x| + |y|) with u = (100 - percent) / (100 + percent), and x is linked with c if |X| <= u (|x| + |c|). As the components differ, one of the two, say y, is not linked with c, so that more than (|X| + u (|c| - |x|)) / 2 of X are shared; and of the Y of a text that is not linked, (|Y| - u (|y| + |c|)) / 2 at least, whatever x is. Thus each has a shared one among its rarest |X| - need + 1, and the pair meets there; all that they share is counted once for the pairs that met. Items of one component only can't be shared and count as the rarest. Bits of the registers that differ too often rule out further pairs, by five standard errors.
    """
    u = (100 - percent) / (100 + percent)
    rows = members.join(small(root.withColumnRenamed("node", "doc_id")), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    mixed = stash(rows.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("key"), "mixed")
    held = rows.join(small(mixed), "key", "left_semi").where("doc_id <> centre").select("centre", "doc_id", "root").distinct()
    held = stash(held, "held")
    star = _checked(held.select(F.col("centre").alias("a"), F.col("doc_id").alias("b")), src, rest=True)
    size, linked = F.col("total") + F.col("shared") - F.col("n_b"), 100 * F.col("shared") >= percent * F.col("total")
    facts = star.select(F.col("a").alias("centre"), F.col("b").alias("doc_id"), F.col("n_b").alias("n"), size.alias("c"), linked.alias("linked"), F.size("rest").alias("d"), "rest")
    facts = stash(held.join(facts, ["centre", "doc_id"]), "facts")

    # Only items that stand in several components can be shared by such a pair; the others come first in every order.
    items = facts.select("centre", "doc_id", "root", F.explode("rest").alias("item"))
    often = items.groupBy("centre", "item").agg(F.count("*").alias("often"), F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("centre", "item", "often")
    items = items.drop("root").join(small(stash(often, "often")), ["centre", "item"])
    lists = items.groupBy("centre", "doc_id").agg(F.array_sort(F.collect_list(F.struct("often", "item"))).alias("items")).withColumn("items", F.transform("items", lambda z: z["item"]))

    def prefix(need):
        return F.col("d") - F.greatest(F.lit(1), F.ceil(need - 1e-6 * F.col("d"))) + 1

    less, more = prefix((F.col("d") + u * (F.col("c") - F.col("n"))) / 2), prefix((F.col("d") - u * (F.col("n") + F.col("c"))) / 2)
    lists = lists.join(facts.drop("rest"), ["centre", "doc_id"]).withColumn("before", F.col("d") - F.size("items")).withColumn("less", less - F.col("before"))
    lists = lists.withColumn("most", F.greatest("less", F.when(F.col("linked"), 0).otherwise(more - F.col("before")))).where("most > 0")
    lists = stash(lists.join(bits, "doc_id"), "lists")
    def enough(both, apart, shared):
        return 100 * (both - apart + 2 * shared) >= percent * (both + apart - 2 * shared)

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("centre", F.col("doc_id").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in ("n", "d", "items", "bits")))

    pairs = stash(_meeting(lists, percent, enough), "meeting")
    pairs = pairs.join(side(lists, "x"), ["centre", "x"]).join(side(lists, "y"), ["centre", "y"])
    differ = sum(F.bit_count(F.col("x_bits")[i].bitwiseXOR(F.col("y_bits")[i])) for i in range(REGISTERS * BITS // 64))
    unlike = 1 - percent / 100
    usual = REGISTERS * unlike * BITS / 2
    error = (REGISTERS * (unlike * (BITS + BITS**2) / 4 - (unlike * BITS / 2) ** 2)) ** 0.5
    alike = (differ <= usual + 5 * error) & enough(F.col("x_n") + F.col("y_n"), F.col("x_d") + F.col("y_d"), F.size(F.array_intersect("x_items", "y_items")))
    return pairs.where(alike).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _meeting(lists: DataFrame, percent: int, enough) -> DataFrame:
    """centre, x, y of lists' texts that meet on an item and may share enough by its rank in both. What texts hold stays in lists: a row here is a few numbers."""
    head = F.transform(F.slice("items", F.lit(1), F.col("most").cast("int")), lambda z, i: F.struct((i + 1).alias("at"), z.alias("item")))
    items = lists.withColumn("p", F.explode(head)).select("centre", "doc_id", "root", "n", "d", "linked", (F.col("before") + F.col("p.at")).alias("rank"), (F.col("p.at") <= F.col("less")).alias("first"), "p.item")

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("centre", "item", F.col("doc_id").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in ("root", "n", "d", "linked", "first", "rank")))

    x, y = side(items.where("first"), "x"), side(items.where("not linked"), "y")
    once = F.col("x_linked") | (F.col("y_first") & (F.col("x") < F.col("y")))
    alike = (F.col("x_root") != F.col("y_root")) & once & (100 * F.least("x_n", "y_n") >= percent * F.greatest("x_n", "y_n"))
    alike &= enough(F.col("x_n") + F.col("y_n"), F.col("x_d") + F.col("y_d"), 1 + F.least(F.col("x_d") - F.col("x_rank"), F.col("y_d") - F.col("y_rank")))
    return x.join(y, ["centre", "item"]).where(alike).select("centre", "x", "y").distinct()
