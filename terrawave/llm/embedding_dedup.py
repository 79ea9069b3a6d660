"""Near-duplicate embeddings by hierarchical navigable small-world graphs.

Vectors are dealt by label and a hash of their id into shards of about SHARD bytes; each shard gets a graph. Every shard is
searched for the vectors of every shard of its label (once for each two shards: a hit counts for both). A search is
audited: AUDIT queries are compared with the whole shard, and as many members of the shard, moved to about the least
cosine, are looked for as queries, so that the audit has links to find where the queries have none; the beam doubles
until the audit finds them all, or until a scan of the shard costs less than a wider beam. Hits are
verified by their cosine in double precision; a block of two shards passes on each vector's number of links and one
link to the least vector that it is connected with inside the block, and components are joined from these.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrawave.llm import hnsw
from terrawave.llm.components import components
from terrawave.session import small, stash

SHARD, AUDIT, LEAST = 8 << 20, 64, 0.93  # bytes of vectors; queries
BEAM = 16  # to begin with
SCAN = 256  # a beam over one in so many nodes costs more than a scan of the shard, which is exact


def _unit(vectors: bytes, n: int) -> np.ndarray:
    x = np.frombuffer(vectors, np.float64).reshape(n, -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def shards(vectors: DataFrame) -> DataFrame:
    """A row for each shard of vectors(label, node, copies, vector): label, shard, nodes, copies, vectors and the graph."""
    sizes = vectors.groupBy("label", F.size("vector").alias("dim")).agg(F.ceil(F.count("*") * F.greatest(F.col("dim"), F.lit(64)) * 8 / SHARD).alias("n"))
    dealt = vectors.withColumn("dim", F.size("vector")).join(small(stash(sizes, "sizes")), ["label", "dim"])
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("node"), F.col("n")))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", key=lambda s: pd.util.hash_array(s.to_numpy()))
        x = np.stack(rows["vector"].to_numpy()).astype(np.float64)
        unit = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
        layers = hnsw.build(unit)
        links = b"".join(links.tobytes() for _, links in layers)
        return pd.DataFrame({"label": rows["label"].iloc[:1], "dim": rows["dim"].iloc[:1], "shard": rows["shard"].iloc[:1], "nodes": [rows["node"].to_numpy(np.int64).tobytes()], "copies": [rows["copies"].to_numpy(np.int64).tobytes()], "vectors": [x.tobytes()], "graph": [links]})

    return dealt.select("label", "dim", "shard", "node", "copies", "vector").groupBy("label", "dim", "shard").applyInPandas(pack, "label string, dim int, shard long, nodes binary, copies binary, vectors binary, graph binary")


def _layers(graph: bytes, n: int) -> list:
    flat, out, members = np.frombuffer(graph, np.int32).reshape(-1, hnsw.WIDTH), [], np.arange(n)
    while len(flat):
        out.append((members, flat[: len(members)]))
        flat, members = flat[len(members) :], members[:: hnsw.M]
    return out


def _planted(x: np.ndarray, least: float) -> np.ndarray:
    """Members of x, spread over it, each moved in a direction of its own to a cosine just above the least."""
    members = x[np.unique(np.linspace(0, len(x) - 1, min(AUDIT, len(x))).astype(int))]
    if x.shape[1] < 2:
        return members
    away = np.random.default_rng(len(x)).standard_normal(members.shape)
    away -= np.einsum("kd,kd->k", away, members)[:, None] * members
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
    cosine = min(least + 0.1 * (1 - least), 1.0)
    return cosine * members + np.sqrt(1 - cosine**2) * away


def _hits(q: np.ndarray, x: np.ndarray, layers: list, least: float) -> np.ndarray:
    """Bits [query, node] of the hits of a search whose beam is widened until its audit passes, verified in double precision. Only hnsw.QUERIES queries are compared at once."""
    small_q, small_x = q.astype(np.float32), x.astype(np.float32)
    audit = np.unique(np.linspace(0, len(q) - 1, min(AUDIT, len(q))).astype(int))
    asked = np.concatenate([q[audit], _planted(x, least)])
    true, small_asked = asked @ x.T >= least, asked.astype(np.float32)
    beam = BEAM
    widest = len(x) // SCAN
    while beam <= widest and not (true <= hnsw.within(small_x, layers, small_asked, least, beam)).all():
        beam *= 2
    bits = np.zeros((len(q), (len(x) + 7) // 8), np.uint8)
    for s in range(0, len(q), hnsw.QUERIES):
        part = q[s : s + hnsw.QUERIES]
        if beam <= widest:
            hits = hnsw.within(small_x, layers, small_q[s : s + hnsw.QUERIES], least, beam)
            i, j = np.nonzero(hits)
            for t in range(0, len(i), 50_000):
                some = slice(t, t + 50_000)
                hits[i[some], j[some]] = np.einsum("kd,kd->k", part[i[some]], x[j[some]]) >= least
        else:
            hits = part @ x.T >= least
        bits[s : s + hnsw.QUERIES] = np.packbits(hits, axis=1)
    return bits


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after joining a[i] with b[i]: each root points at the least it meets, until all that are joined agree."""
    while True:
        r, s = root[a], root[b]
        apart = r != s
        if not apart.any():
            return root
        a, b, r, s = a[apart], b[apart], r[apart], s[apart]
        np.minimum.at(root, np.maximum(r, s), np.minimum(r, s))
        while (root[root] != root).any():
            root = root[root]


def _block(a: dict, b: dict, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """node, links, root of the vectors of two shards (or one) that have a link in this block."""
    nodes_a, nodes_b = np.frombuffer(a["nodes"], np.int64), np.frombuffer(b["nodes"], np.int64)
    same = a["shard"] == b["shard"]
    q, x = _unit(a["vectors"], len(nodes_a)), _unit(b["vectors"], len(nodes_b))
    bits = _hits(q, x, _layers(b["graph"], len(nodes_b)), least)
    copies_a, copies_b = (np.frombuffer(z["copies"], np.int64).astype(np.float64) for z in (a, b))  # whole numbers, far below 2^53
    nodes = nodes_a if same else np.concatenate([nodes_a, nodes_b])
    links, root, shift = np.zeros(len(nodes)), np.arange(len(nodes)), 0 if same else len(nodes_a)
    for s in range(0, len(q), hnsw.QUERIES):
        hits = np.unpackbits(bits[s : s + hnsw.QUERIES], axis=1, count=len(x)).astype(bool)
        if same:  # a pair counts if either found the other
            back = np.unpackbits(bits[:, s // 8 : (s + hnsw.QUERIES) // 8], axis=1)[:, : len(hits)]
            hits |= back.T.astype(bool)
            hits[np.arange(len(hits)), s + np.arange(len(hits))] = False
        i, j = np.nonzero(hits)
        links[s : s + len(hits)] += np.bincount(i, copies_b[j], len(hits))
        if not same:
            links[shift:] += np.bincount(j, copies_a[s + i], len(x))
        root = _joined(root, s + i, shift + j)
    least_of = np.full(len(nodes), np.iinfo(np.int64).max)
    np.minimum.at(least_of, root, nodes)
    some = links > 0
    return nodes[some], links[some].astype(np.int64), least_of[root][some]


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = LEAST) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of vectors.

    Rows without id or label, vectors that are null, zero, or hold a null or a component that is not finite link with nothing. Only vectors of one length are compared. Rows of one vector and label are one node with copies. Rows that share an id count as links of each other only if their vectors link.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vector", lambda v: v != 0)
    key = F.when(F.coalesce(fine, F.lit(False)), F.unhex(F.md5(F.concat_ws("|", "label", F.col("vector").cast("string")))))
    rows = rows.withColumn("key", key)
    nodes = rows.where("key is not null").groupBy("key", "label", "vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    nodes = stash(nodes, "nodes")
    packed = stash(shards(nodes.select("label", "node", "copies", "vector")), "shards")
    # Numbers of blocks first, so that no label is one group; the vectors come to their blocks by shard.
    i, j = (packed.select("label", "dim", F.col("shard").alias(c)) for c in "ij")
    blocks = stash(i.join(j, ["label", "dim"]).where("i <= j"), "blocks")
    a = packed.select("label", "dim", F.col("shard").alias("i"), F.struct("shard", "nodes", "copies", "vectors").alias("a"))
    b = packed.select("label", "dim", F.col("shard").alias("j"), F.struct("shard", "nodes", "copies", "vectors", "graph").alias("b"))
    blocks = blocks.join(a, ["label", "dim", "i"]).join(b, ["label", "dim", "j"]).repartition("label", "dim", "i", "j").select("a", "b")

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                x, y = (batch.column(i)[row].as_py() for i in range(2))
                node, links, root = _block(x, y, least)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(links), pa.array(root)], ["node", "links", "root"])

    found = stash(blocks.mapInArrow(run, "node long, links long, root long"), "found")
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    root = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    facts = nodes.select("key", "node", "copies").join(small(stash(sums, "sums")), "node", "left").join(small(stash(root, "root")), "node", "left")
    facts = stash(facts.select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("root", "node").alias("root")), "facts")
    out = rows.select("vec_id", "key").join(facts, "key", "left").select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


#: The rows of op9, for DuckDB, as far as all links are found.
ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach(vec_id, other) AS (SELECT a, b FROM links UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(v.vec_id, coalesce(c.c, v.vec_id)) AS component_id,
       v.vec_id <= coalesce(c.c, v.vec_id) AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON v.vec_id = n.a
LEFT JOIN (SELECT vec_id, min(other) AS c FROM reach GROUP BY vec_id) c ON v.vec_id = c.vec_id
"""
