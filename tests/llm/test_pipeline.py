"""The stages of the corpus pipeline against plain versions, on documents with nulls, empty texts, repeated rows and clashing columns."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from terrawave.llm import mixing, toxicity
from terrawave.llm.queries import tokenizer_path, toxic_labels

WORDS = ["".join(random.Random(i).choices("abcdefghijk", k=3 + i % 7)) for i in range(500)]
STAGES = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, doc string, root long"


def _text(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


def _rows():
    r = random.Random(11)
    boiler = _text(r, 14)
    out = []
    for i in range(160):
        lines = [_text(r, r.randint(6, 25)) for _ in range(r.randint(1, 4))]
        if i % 9 == 0:
            lines.append(boiler)
        if i % 9 == 1:
            lines.append(boiler[:-2])  # nearly the same line
        if i % 4 == 0:
            lines[0] += " vilify rotten " * 2
        out.append((i, "\n".join(lines), f"s{i % 3}"))
    out += [(200 + i, " ".join([out[5][1], f"tail{i}"]), "s1") for i in range(4)]
    out += [(300, None, None), (301, "", "s0"), (302, " \n\t", "s2"), (303, _text(r, 5000), "s0"), (304, "one two", "s1")]
    out.append(out[7])
    return [(i, t, "xx", s, len(t) if t is not None else None, "x", "y", 1) for i, t, s in out]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(_rows(), SCHEMA).write.parquet(f"{at}/documents.parquet")
    labels = [(i, 1, int(i % 4 == 0)) for i in range(160)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def _same(a, b):
    return Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))


def test_toxicity_drops_what_the_classifier_rejects(spark, docs, sf):
    out = STAGES["toxicity"](spark, docs, sf)
    assert out.columns == docs.columns
    model = toxicity.train(docs.select("doc_id", "text"), toxic_labels(spark, sf))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs.select("doc_id", "text"), model).collect()}
    assert Counter(r["doc_id"] for r in out.collect()) == Counter(r["doc_id"] for r in docs.collect() if scores[r["doc_id"]] < 0.3)
    kept = {r["doc_id"] for r in out.collect()}
    assert not kept & {i for i in range(160) if i % 4 == 0} and {i for i in range(160) if i % 4} <= kept


def test_line_dedup_equals_brute_force(spark, docs, sf):
    out = STAGES["line_dedup"](spark, docs, sf)
    assert out.columns == docs.columns and out.schema == docs.schema
    norm = {}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    first = {}
    for i, t in sorted(rows, key=lambda x: x[0]):
        for at, line in enumerate((t or "").split("\n")):
            if w := " ".join(re.findall(r"[^\W_]+", line.lower())):
                norm[i, at] = w
                first.setdefault(w, (i, at))
    lines = sorted(first)
    parent = {w: w for w in lines}

    def find(w):
        while parent[w] != w:
            w = parent[w]
        return w

    pairs = [(a, b) for n, a in enumerate(lines) for b in lines[:n] if abs(len(a) - len(b)) <= 0.1 * max(len(a), len(b)) and len(set(a.split()) & set(b.split())) > 1]
    for a, b in pairs:
        if duckdb.execute("select levenshtein($1, $2)", [a, b]).fetchone()[0] <= int(0.1 * max(len(a), len(b)) + 1e-9):
            parent[find(a)] = find(b)
    keep = {}
    for w in lines:
        keep[find(w)] = min(first[w], keep.get(find(w), (1 << 60, 0)))
    want = Counter()
    seen = set()
    for i, t in rows:
        again = (i, t) in seen and t is not None  # one of equal rows keeps its lines
        seen.add((i, t))
        left = [line for at, line in enumerate((t or "").split("\n")) if (i, at) not in norm or not again and keep[find(norm[i, at])] == (i, at)]
        want[i, None if t is None else "\n".join(left)] += 1
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == want
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in out.collect())


def test_near_dedup_keeps_one_of_each_group(spark, docs, sf):
    out = STAGES["minhash_near_dedup"](spark, docs, sf)
    sets = {}
    for r in docs.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", (r["text"] or "").lower())
        sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                root[b] = min(root[b], root[a])
    assert {r["doc_id"] for r in out.collect()} == {i for i in root if root[i] == i} and out.columns == docs.columns


def test_mixing_takes_the_copies_of_the_sql(spark, docs, sf):
    out = Counter(r["doc_id"] for r in STAGES["mixing"](spark, docs, sf).collect())
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()])
    want = Counter()
    for doc_id, size, taken in con.execute(f"select doc_id, size, taken from ({mixing.ORACLE})").fetchall():
        if size:
            want[doc_id] += taken // size
    assert all(out[i] == n for i, n in want.items())


def test_packing_holds_every_id_once(spark, docs, sf):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = STAGES["packing"](spark, docs, sf).collect()
    want = Counter((r["doc_id"], len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1) for r in docs.collect())
    held = defaultdict(int)
    for r in rows:
        held[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert dict(held) == {k: k[1] * n for k, n in want.items()}
    used = defaultdict(list)
    for r in rows:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in used.values():
        ends = np.cumsum([0] + [n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == ends[:-1].tolist() and ends[-1] <= 1024


def test_run_and_empty_tables(spark, sf, tmp_path):
    assert corpus_pipeline.run(spark, sf).count() > 100
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_line_dedup_without_a_count_of_characters(spark, docs, sf):
    assert _same(STAGES["line_dedup"](spark, docs.drop("n_chars"), sf), STAGES["line_dedup"](spark, docs, sf).drop("n_chars"))
