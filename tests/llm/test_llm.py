"""Operators of training-data pipelines against plain versions, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from terrawave.llm import components, embedding_dedup, folds, language_id, line_dedup, mixing, near_dedup, packing, quality, spotsigs, toxicity, warc

SCHEMA = "doc_id long, text string, source string, size string, doc string"  # size and doc clash with names inside
WORDS = ["".join(random.Random(i).choices("abcdefgh", k=2 + i % 6)) for i in range(400)]


def _text(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


def _docs(n=60, seed=0):
    r = random.Random(seed)
    rows = [(i, _text(r, r.randint(1, 120)), f"s{i % 3}", "x", "y") for i in range(n)]
    for i in range(n, n + 20):  # near copies of document 5, 40 words at least
        w = (rows[5][1] + " " + _text(random.Random(9), 60)).split() if i == n else rows[n][1].split()
        w[r.randrange(len(w))] = "zz%d" % i
        rows.append((i, " ".join(w), "s0", "x", "y"))
    rows += [(200 + i, rows[3][1], None, "x", "y") for i in range(6)]
    rows += [(300, None, "s1", "x", "y"), (301, "", "s1", "x", "y"), (302, " \n\t", "s1", "x", "y"), (303, _text(r, 30_000), "s2", "x", "y"), (304, "a b", "s2", "x", "y"), (305, "A\tb", "s2", "x", "y")]
    return [*rows, rows[7]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_docs(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def _roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    r = random.Random(1)
    for links in ([(i, i + 1) for i in range(60)], [(r.randint(0, 300), r.randint(0, 300)) for _ in range(150)], []):
        got = {x["node"]: x["root"] for x in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
        nodes = {x for p in links if p[0] != p[1] for x in p}
        assert got == _roots(nodes, [p for p in links if p[0] != p[1]])


def test_near_duplicates_equal_brute_force(spark, docs, empty):
    sets = {d[0]: _shingles(d[1]) for d in _docs()}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = _roots(ids, links)
    rows = near_dedup.near_duplicates(docs).collect()
    assert len(rows) == len(_docs()) and len(links) > 50
    for r in rows:
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), root[r["doc_id"]], root[r["doc_id"]] == r["doc_id"])
    assert near_dedup.near_duplicates(empty).count() == 0


def test_register_estimate_is_near_the_similarity():
    r = np.random.default_rng(0)
    for size in (40, 400, 4000):
        a = np.unique(r.integers(0, 2**63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[: int(size * 0.857)], r.integers(0, 2**63, size - int(size * 0.857)).astype(np.uint64)]))
        regs = near_dedup.registers_of([a, b])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        est = near_dedup.estimate(regs[:1], regs[1:], np.array([len(a)]), np.array([len(b)]))[0]
        assert abs(est - true) < near_dedup.MARGIN


def test_line_dedup(spark, empty):
    base = "the quick brown fox jumps over the lazy dog near the old stone bridge at seven in the evening while rain falls"
    rows = [(1, f"{base}\nunique one\n\nfoo bar", "a", "x", "y"), (2, f"{base.upper()}!\nother line", "a", "x", "y"), (3, None, "a", "x", "y"), (4, "", "a", "x", "y"), (5, "foo bar\nfoo bar\n---", "a", "x", "y"), (6, "---\n" + "word " * 70_000, "a", "x", "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r["doc"]["doc_id"]: r for r in line_dedup.deduplicated(df).collect()}
    assert out[1]["text"] == rows[0][1] and out[1]["n_lines"] == 4
    assert out[2]["text"] == "other line" and out[2]["n_removed"] == 1
    assert out[3]["text"] is None and out[4]["text"] == ""
    assert out[5]["text"] == "---" and out[6]["text"] == rows[5][1]
    assert line_dedup.rewritten(df).columns == df.columns
    assert line_dedup.deduplicated(empty).count() == 0


def test_similar_lines_join_one_group(spark):
    r = random.Random(4)
    long = [_text(r, 150) for _ in range(5)]
    rows = [(i, t) for i, t in enumerate(long)] + [(100 + i, t[:-1] + ("x" if t[-1] != "x" else "y")) for i, t in enumerate(long)]
    found = line_dedup.occurrences(spark.createDataFrame([(i, i, t) for i, t in rows], "_row long, _doc long, _text string")).collect()
    sims = {x["_doc"]: x["sim"] & (2**64 - 1) for x in found}
    apart = [bin(sims[i] ^ sims[100 + i]).count("1") for i in range(5)]
    unlike = [bin(sims[i] ^ sims[j]).count("1") for i in range(5) for j in range(i)]
    assert max(apart) < min(unlike)
    out = {x["doc"]["doc_id"]: x["n_removed"] for x in line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[100 + i] == 1 for i in range(5)) and not any(out[i] for i in range(5))


def test_one_of_equal_rows_keeps_its_lines(spark):
    text = "first line of words\n\nsecond line of words\n---"
    rows = [(1, text, "a"), (1, text, "b"), (2, "second line of words", "c"), (None, "lines without an id", "d"), (None, "lines without an id", "d")]
    out = line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted((r["text"], r["n_removed"]) for r in out if r["doc"]["doc_id"] == 1) == [("\n---", 2), (text, 0)]
    assert sorted(r["text"] for r in out if r["doc"]["doc_id"] is None) == ["", "lines without an id"]
    assert [(r["text"], r["n_removed"]) for r in out if r["doc"]["doc_id"] == 2] == [("", 1)]


def _edited(r, text, share):
    """text with that share of its words changed: a letter replaced, or the word dropped, doubled or replaced."""
    w = text.split()
    for i in r.sample(range(len(w)), max(1, int(len(w) * share))):
        kind = r.randrange(4)
        at = r.randrange(len(w[i])) if w[i] else 0
        w[i] = [w[i][:at] + "q" + w[i][at + 1 :], "", w[i] + " " + w[i], "".join(r.choices("abcdefgh", k=len(w[i])))][kind]
    return " ".join(" ".join(w).split())


def test_recall_of_similar_lines(spark):
    """Pairs of a line of 3 to 1,000 words and its edited form, of similarity 0.9 or more: at least 0.9 are found, for every length."""
    r = random.Random(13)
    rows, true = [], []
    for n in (3, 5, 8, 12, 20, 30, 60, 130, 300, 1000):
        for k in range(25 if n < 1000 else 8):
            base = _text(r, n)
            other = _edited(r, base, r.uniform(0.02, 0.1))
            rows += [(len(rows), base), (len(rows) + 1, other)]
            apart = duckdb.execute("SELECT levenshtein($1, $2)", [base, other]).fetchone()[0]
            if 0 < apart <= int(0.1 * max(len(base), len(other)) + 1e-9):
                true.append((n, len(rows) - 1))
    out = {x["doc"]["doc_id"]: x["n_removed"] for x in line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = Counter(n for n, i in true if out[i])
    total = Counter(n for n, _ in true)
    print("recall by words:", {n: f"{hit[n]} of {total[n]}" for n in total})
    assert all(hit[n] >= 0.9 * total[n] for n in total) and not any(out[i] for i, _ in rows[::2])


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_similar_lines_of_every_length_are_found(spark):
    r = random.Random(9)
    lines = [w for n in (2, 3, 4, 5, 7, 10, 12, 20, 50) for w in (_text(r, n) for _ in range(5))]
    lines += ["".join(r.choice("abcdefghij") for _ in range(200)) for _ in range(3)]
    for t in list(lines):
        for edits in (1, len(t) // 20, len(t) // 10):  # edits in one place, as a changed word makes, or all over
            for spread in (False, True):
                at, c = r.randrange(len(t)), list(t)
                for i in range(edits):
                    c[(r.randrange(len(t)) if spread else at + i) % len(t)] = r.choice("abcdefghij ")
                lines.append(" ".join("".join(c).split()))
    lines = sorted(set(lines), key=lambda t: (len(t), t))
    most, counts = [int(0.1 * len(t) + 1e-9) for t in lines], [Counter(t) for t in lines]
    near = [(i, j) for j in range(len(lines)) for i in range(j) if len(lines[j]) - len(lines[i]) <= most[j] and (counts[j] - counts[i]).total() <= most[j]]
    links = [(i, j) for i, j in near if _distance(lines[i], lines[j]) <= most[j]]
    root = _roots(range(len(lines)), links)
    out = {x["doc"]["doc_id"]: x["n_removed"] for x in line_dedup.deduplicated(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()}
    assert len(links) > 200 and not any(out[i] for i in range(len(lines)) if root[i] == i)
    short = [i for i, t in enumerate(lines) if len(t) < line_dedup.SHORT and root[i] != i]
    assert all(out[i] for i in short)
    long = [i for i, t in enumerate(lines) if len(t) >= line_dedup.SHORT and root[i] != i]
    assert sum(out[i] for i in long) >= 0.98 * len(long)


def test_lines_of_a_key_of_many_are_all_compared(spark):
    """Similar pairs that share one key alone, which 300 lines have: every second word has a letter changed."""
    r = random.Random(12)
    rows = []
    for n in range(150):
        words = ["".join(r.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(20)]
        edited = [w[:2] + "z" + w[3:] if i % 2 == 0 else w for i, w in enumerate(words)]
        rows += [(n, " ".join(["internationalised", "extraordinarily", *words])), (1000 + n, " ".join(["internationalised", "extraordinarily", *edited]))]
    out = {x["doc"]["doc_id"]: x["n_removed"] for x in line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[1000 + n] == 1 and out[n] == 0 for n in range(150))


def test_lines_are_shuffled_as_text(spark):
    texts = spark.createDataFrame([(1, "a b c"), (2, "a b d"), (3, "e")], "id long, norm string")
    both = line_dedup._beside(spark.createDataFrame([(1, 2), (1, 3)], "a long, b long"), texts)
    assert sorted(map(tuple, both.collect())) == [(1, 2, ["a", "b", "c"], ["a", "b", "d"]), (1, 3, ["a", "b", "c"], ["e"])]
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" in plan and "split(" not in plan[plan.index("Join") :]  # words are cut above the joins only


def test_lines_are_read_again_as_text(spark):
    docs = spark.createDataFrame([(1, 5, "A b\n-\nc, d!"), (1, 5, "A b\n-\nc, d!"), (2, 6, "e")], "_row long, _doc long, _text string")
    places = spark.createDataFrame([(10, 5, 1, 0), (11, 5, 1, 2), (12, 6, 2, 0)], "id long, _doc long, _row long, at int")
    got = line_dedup._read_again(docs, places.hint("merge"))
    assert sorted(map(tuple, got.collect())) == [(10, "a b"), (11, "c d"), (12, "e")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "array_join(" in plan[plan.index("Join") :]  # words are joined below the join


def test_long_lines_changed_all_over_are_found(spark):
    """Every word of six letters has one changed, so that the longest words, and the SimHashes, have hardly anything in common."""
    r = random.Random(13)
    rows = []
    for n in range(20):
        words = ["".join(r.choice("abcdefghijklmnop") for _ in range(6 if i % 2 == 0 else 4)) for i in range(420)]
        edited = [w[:2] + "z" + w[3:] if i % 2 == 0 else w for i, w in enumerate(words)]
        rows += [(n, " ".join([f"internationalised{n}", "extraordinarily", *words])), (1000 + n, " ".join([f"internationalised{n}", "extraordinarily", *edited]))]
    out = {x["doc"]["doc_id"]: x["n_removed"] for x in line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[1000 + n] == 1 and out[n] == 0 for n in range(20))


def test_fingerprints(spark, docs, empty):
    rows = spotsigs.compared(docs).collect()
    assert len(rows) == len(_docs())
    order = sorted(_docs(), key=lambda d: -d[0])
    by_id = {r["doc_id"]: r for r in rows}
    for d, after in zip(order, order[1:] + order[:1], strict=True):
        text, other = d[1] or "", after[1] or ""
        changed = text[: len(text) - len(text) // 2] + other[: len(text) // 2]
        if d[0] != 7:
            r = by_id[d[0]]
            assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert 0 <= by_id[d[0]]["near_edited"] <= 1
    assert len({by_id[i]["fingerprint"] for i in (3, 200, 205)}) == 1
    assert by_id[300]["fingerprint"] == "" and by_id[303]["near_next"] < 0.1
    assert spotsigs.compared(empty).count() == 0
    prints = spotsigs.fingerprints(docs)
    pairs = {(r["a"], r["b"]) for r in spotsigs.near_duplicates(prints).collect()}
    sets = {}
    for r in prints.collect():
        sets[r["fingerprint"]] = min(r["doc_id"], sets.get(r["fingerprint"], 1 << 60))
    reps = [(i, spotsigs.set_of(f)) for f, i in sets.items() if f]
    assert pairs == {(min(i, j), max(i, j)) for i, a in reps for j, b in reps if i < j and spotsigs.likeness(a, b) >= 0.75}


def _labelled(n=400):
    r = random.Random(2)
    bad = ["vile", "rotten", "filthy"]
    return [(i, _text(r, 60) + (" " + r.choice(bad) + " " + r.choice(bad) if i % 8 == 0 else ""), int(i % 8 == 0)) for i in range(n)]


def test_language(spark, empty):
    r = random.Random(0)
    own = {lang: ["".join(r.choices(letters, k=r.randint(2, 7))) for _ in range(200)] for lang, letters in {"xx": "abcde", "yy": "efghi", "zz": "ijkla"}.items()}
    rows = [(i, " ".join(r.choice(own[lang]) for _ in range(30)), lang) for i in range(150) for lang in [["xx", "yy", "zz"][i % 3]]]
    model = language_id.train(spark.createDataFrame([*rows, (999, "abc", None), (998, None, "xx")], "doc_id long, text string, lang string"))
    fresh = [(i, " ".join("".join(r.choices("abcde", k=6)) for _ in range(20)), "xx") for i in range(10)]
    extra = [(500, None, ""), (501, "", ""), (502, "123 !!", "")]
    got = {x["doc_id"]: x for x in language_id.predict(spark.createDataFrame([*fresh, *extra], "doc_id long, text string, lang string"), model).collect()}
    assert all(got[i]["lang_pred"] == "xx" for i in range(10))
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (500, 501, 502))
    assert all(0 <= x["score"] <= 1 for x in got.values())
    assert language_id.predict(empty, model).count() == 0
    assert language_id.train(empty.withColumn("lang", F.lit("q")))["langs"] == ["und"]


def test_toxicity(spark, empty):
    rows = _labelled()
    df = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3], "doc_id long, label int")
    model = toxicity.train(df, labels)
    got = {x["doc_id"]: x["score"] for x in toxicity.score(df, model).collect()}
    held = [(got[i] >= 0.3, y) for i, _, y in rows if not i % 3]
    assert np.mean([a == bool(y) for a, y in held]) > 0.97
    assert got[900] < 0.3 and got[901] < 0.3
    kept = toxicity.clean(df.withColumn("doc", F.lit(1)).withColumn("score", F.lit("q")), model)
    assert kept.columns == ["doc_id", "text", "doc", "score"] and kept.count() == sum(s < 0.3 for s in got.values())
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.train(df, labels.where("label > 1"))["voters"] == []


def test_quality(spark, empty):
    r = random.Random(5)
    rows = [(i, _text(r, 80) if i % 4 else " ".join(w.upper() + "!!" for w in _text(r, 80).split()), int(i % 4 > 0)) for i in range(400)]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, "")], "doc_id long, text string")
    good = spark.createDataFrame([(i,) for i, _, y in rows if y and i % 2], "doc_id long")
    model = quality.train(df, good)
    assert 0.5 < model["prior"] < 0.95
    got = {x["doc_id"]: x["score"] for x in quality.score(df, model).collect()}
    assert np.mean([(got[i] >= 0.3) == bool(y) for i, _, y in rows if not i % 2 or not y]) > 0.95
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == 402
    assert quality.score(empty, model).count() == 0


def _tokenizer():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    return path, Tokenizer.from_file(path)


def test_packing_round_trip(spark, docs, empty):
    path, tokenizer = _tokenizer()
    rows = packing.packed(docs, path, with_ids=True).collect()
    want = Counter(tuple(tokenizer.encode(d[1] or "", add_special_tokens=False).ids) + (0,) for d in _docs())
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for d in _docs():
        parts = sorted(by_doc[d[0]], key=lambda r: r["start"])
        if d[0] != 7:
            ids = np.frombuffer(b"".join(bytes(p["ids"]) for p in parts), "<u4")
            assert want[tuple(ids.tolist())] and parts[0]["doc_tokens"] == len(ids)
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r["length"] for r in rows)
    assert len(by_seq) <= total / 1024 * 1.05 + 1
    assert packing.packed(empty, path).count() == 0


def test_chunked_ids_equal_the_tokenizer():
    _, tokenizer = _tokenizer()
    known, r = packing.Ids(tokenizer), random.Random(3)
    texts = ["".join(r.choices("ab  \n\t\x1c\x85é'sA1!.,日🙂\r", k=r.randint(0, 40))) for _ in range(3000)] + ["<|endoftext|> a", "don't  we'll ", ""]
    texts += [" " * 5000 + "a b", "a" * 5000, "\n" * 3000]
    assert known.merge is not None
    for t in texts:
        assert known.of(t) == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_patterns_place_every_length():
    r = random.Random(0)
    hist = {n: r.randint(1, 50) for n in r.sample(range(1, 1025), 300)}
    placed = Counter()
    for pattern, n in packing.patterns(hist):
        assert sum(pattern) <= 1024
        for size in pattern:
            placed[size] += n
    assert placed == hist


def test_warc_round_trip(spark):
    big = "é<p>" * 60_000
    rows = [(1, "http://a\r\nx", "x" * 1500), (5, "http://b", "x" * 1500), (3, "http://c", "x" * 1500), (2, None, None), (4, "u", ""), (6, "u", "small"), (7, "u", "small"), (8, "big", big), (9, "crlf", "a\r\n\r\nb" * 300)]
    got = {r["record_id"]: r for r in warc.resolved(warc.read(warc.write(spark.createDataFrame(rows, "page_id long, url string, html string")))).collect()}
    for i, _, html in rows:
        data = (html or "").encode()
        assert (got[i]["payload_bytes"], got[i]["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest())
        assert (got[i]["record_type"], got[i]["refers_to"]) == (("revisit", 5) if i in (1, 3) else ("response", None))
    assert warc.read(warc.write(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0


def test_warc_nulls_repeats_and_damage(spark):
    rows = [(None, "u", "page without an id", "x"), (None, "v", "y" * 2000, "x"), (7, "w", "y" * 2000, "x"), (7, "w", "y" * 2000, "x"), (8, "z", "w" * 200_000, "x")]
    table = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string, payload string"))
    found = warc.read(table)
    assert sorted((r["record_id"] or -1, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.resolved(found).collect()) == [(-1, "response", None, 18), (-1, "revisit", 7, 2000), (7, "response", None, 2000), (7, "response", None, 2000), (8, "response", None, 200_000)]
    assert found.where("not whole").isEmpty()
    torn = warc.read(table.where("not (record_id = 8 and chunk_no = 2)"))
    assert [r["record_id"] for r in torn.where("not whole").collect()] == [8]


def test_language_vocabulary_with_ties(spark, monkeypatch):
    """Where more words than fit share a count, the model takes a part of them, not none."""
    monkeypatch.setattr(language_id, "WORDS", 200)
    words = ["".join(chr(97 + (i // 26**k) % 26) for k in range(3)) for i in range(2000)]
    model = language_id.train(spark.createDataFrame([("aa", " ".join(words)), ("bb", "zzzzz zzzzz yyyyy")], "lang string, text string"))
    assert 150 < len([w for w in model["tables"]["w"] if w in set(words)]) <= 200
    assert {"zzzzz", "yyyyy"} <= set(model["tables"]["w"])
    rows = language_id.predict(spark.createDataFrame([(1, "zzzzz"), (2, None), (3, "1 2"), (1, "zzzzz"), (4, "zz " * 100_000)], "doc_id long, text string"), model).collect()
    assert sorted((r["doc_id"], r["lang_pred"]) for r in rows) == [(1, "bb"), (1, "bb"), (2, "und"), (3, "und"), (4, "bb")]


def test_language_scores_equal_a_plain_version(spark):
    """Scores of words and of n-grams, longest first, against loops over a small corpus."""
    r = random.Random(5)
    rows = [(lang, " ".join(r.choice(letters_of) * r.randint(1, 3) + r.choice(letters_of) for _ in range(30))) for lang, letters_of in (("aa", "abcd"), ("bb", "cdef")) for _ in range(5)]
    model = language_id.train(spark.createDataFrame(rows, "lang string, text string"))
    counts = defaultdict(Counter)
    for lang, text in rows:
        for w in text.split():
            counts[lang, "w"][w] += 1
            for n in range(1, 5):
                counts[lang, n].update(language_id.grams(w, n))
    langs = ["aa", "bb"]

    def log_odds(kind, item, lang):
        c = counts[lang, kind]
        return np.log(((c[item] + 0.5) if item in c else 0.5) / (c.total() + len(c) + 1))

    def plain(word):
        for kind in ("w", 4, 3, 2, 1):
            items = [word] if kind == "w" else language_id.grams(word, kind)
            hits = [i for i in items if any(i in counts[lang, kind] for lang in langs)]
            if hits:
                return np.array([np.mean([log_odds(kind, i, lang) for i in hits]) for lang in langs])
        return np.zeros(2)

    scores = language_id.Scores(model)
    for text in ("aab cef zzz", "abab cde", "ffa q", "ab " * 50 + "xyza"):
        assert np.allclose(scores.of(text), sum(plain(w) for w in text.split()))


def test_embeddings_nulls_repeats_and_empty(spark):
    v, w = [1.0, 0.0, 2.0], [1.0, 0.05, 2.0]
    schema = "vec_id long, label string, embedding array<double>, links long, node string"
    rows = [(1, "a", v, 0, ""), (1, "a", v, 0, ""), (2, "a", w, 0, ""), (None, "a", v, 0, ""), (3, None, v, 0, ""), (4, "b", v, 0, ""), (5, "a", None, 0, ""), (6, "a", [0.0, 0.0, 0.0], 0, ""), (7, "a", [1.0, None, 2.0], 0, ""), (8, "a", [1.0, float("nan"), 2.0], 0, "")]
    got = sorted(((r["vec_id"] or -1, r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, schema)).collect()))
    assert got == [(-1, 0, None, None), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), *((i, 0, i, True) for i in (3, 4, 5, 6, 7, 8))]
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_embeddings_equal_brute_force(spark):
    r = np.random.default_rng(1)
    centres = r.standard_normal((12, 16))
    x = [(int(i), [float(v) for v in centres[i % 12] + 0.12 * r.standard_normal(16)], int(i % 12) // 4) for i in range(300)]
    x += [(1000 + i, x[0][1], 0) for i in range(30)] + [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] * 16, 0), (2003, [None] * 16, 0), (2004, x[0][1], None), (2005, [float("inf")] * 16, 1)]
    got = {q["vec_id"]: q for q in embedding_dedup.near_duplicates(spark.createDataFrame(x, "vec_id long, embedding array<float>, label int")).collect()}
    good = [(i, np.array(v, np.float32).astype(float), lab) for i, v, lab in x if lab is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = [(i, j) for i, a, p in good for j, b, q in good if i < j and p == q and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.93]
    n, root = Counter(z for p in links for z in p), _roots([i for i, _, _ in x], links)
    assert len(got) == len(x)
    assert all((got[i]["n_links"], got[i]["component_id"]) == (n[i], root[i]) for i, _, _ in x)


def test_few_links_across_shards_are_found(monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SCAN", 32)  # two beams before a scan
    r = np.random.default_rng(6)

    def unit(v):
        return v / np.linalg.norm(v, axis=-1, keepdims=True)

    x = unit(r.standard_normal((2048, 64)))
    layers = embedding_dedup.hnsw.build(x.astype(np.float32))
    cut = [(members, np.where(np.arange(len(members))[:, None] % 4, -1, links).astype(np.int32)) for members, links in layers]  # a graph that leads nowhere from most nodes
    q = unit(r.standard_normal((2048, 64)))
    audit = np.linspace(0, len(q) - 1, embedding_dedup.AUDIT).astype(int)
    at = np.setdiff1d(np.arange(len(q)), audit)[::100]
    members = r.choice(len(x), len(at), replace=False)
    q[at] = unit(x[members] + 0.3 * unit(r.standard_normal((len(at), 64))))
    true = q @ x.T >= embedding_dedup.LEAST
    assert not true[audit].any() and true.sum() == len(at)
    lost = true & ~embedding_dedup.hnsw.within(x.astype(np.float32), cut, q.astype(np.float32), embedding_dedup.LEAST, embedding_dedup.hnsw.BEAM)
    assert lost.sum() > 0.1 * true.sum()  # an audit of these queries alone sees none of this
    for graph in (layers, cut):
        hits = np.unpackbits(embedding_dedup._hits(q, x, graph, embedding_dedup.LEAST), axis=1, count=len(x)).astype(bool)
        assert (hits & true).sum() >= 0.9 * true.sum()
        assert not (hits & ~true).any()


def test_mixing(spark, docs, empty):
    rows = [r.asDict() | {"doc_id": r["doc"]["doc_id"], "source": r["doc"]["source"]} for r in mixing.allocate(docs).collect()]
    assert len(rows) == len(_docs())
    total = sum(r["size"] for r in rows)
    target, taken, largest = {}, Counter(), Counter()
    for r in rows:
        target[r["source"]] = r["target"]
        taken[r["source"]] += r["size"] * r["copies"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert r["copies"] <= 3 and r["target"] <= 3 * r["source_size"] + 1e-6
    assert abs(sum(target.values()) - total) < 1e-6 * total
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in target)
    again = mixing.allocate(docs).collect()
    assert Counter((r["doc"]["doc_id"], r["copies"]) for r in again) == Counter((r["doc_id"], r["copies"]) for r in rows)
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.mixed(docs).count() == sum(r["copies"] for r in rows)
    assert mixing.allocate(empty).count() == 0


def test_fold(spark):
    rows = spark.range(200).select("id", folds.fold(F.col("id"), 4).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 4 for r in rows)


def test_quality_statistics_are_of_all_documents(spark):
    """Moments and class prior over all rows against plain loops, and no positives."""
    r = random.Random(8)
    texts = [_text(r, r.randint(1, 60)) for _ in range(80)] + [None, "", "x" * 200_000, texts_of_one_kind(r)]
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, score string").repartition(5)
    x = np.stack([quality.features(t) for t in texts]).astype(np.float64)
    n, mean, scale = quality.moments(docs)
    assert n == len(texts) and np.allclose(mean, x.mean(axis=0)) and np.allclose(scale, np.where(x.std(axis=0) > 1e-6, x.std(axis=0), 1.0), atol=1e-6)
    positive = np.linspace(0, 1, 50)
    everything = np.concatenate([positive, -np.ones(50)])
    prior = quality.class_prior(positive, (everything[:, None] >= quality.cuts_of(positive)).sum(axis=0), 100)
    assert abs(prior - 0.5) < 0.03
    model = quality.train(docs, docs.select("doc_id").limit(0))
    assert {r["score"] for r in quality.score(docs, model).collect()} == {0.5}


def texts_of_one_kind(r):
    return "\n".join([_text(r, 5)] * 20)


def test_mixing_from_counted_words(spark, docs):
    """Words counted first give the same copies, very long texts included."""
    whole = Counter((r["doc"]["doc_id"], r["size"], r["copies"]) for r in mixing.allocate(docs).collect())
    first = Counter((r["doc"]["doc_id"], r["size"], r["copies"]) for r in mixing.allocate(mixing.counted(docs), size_col="_words").collect())
    assert whole == first and max(n for _, n, _ in whole) == 30_000


def _plain_signatures(text):
    """A text's signatures as tuples of words: loops instead of arrays."""
    words = [spotsigs.letters(w) or w.decode() for w in (text or "").encode().split()]
    out = set()
    for at, w in enumerate(words):
        common = w in spotsigs._COMMON
        if at and not (w in spotsigs._ANCHORS or not common and (spotsigs.xxhash.xxh3_64_intdigest(w) >> 2) % spotsigs.SPARE == 0):
            continue
        out.add((w, tuple([x for x in words[at + 1 :] if x not in spotsigs._COMMON][: spotsigs.CHAIN])))
    return out


def test_fingerprints_equal_a_plain_version(spark, docs):
    """Likeness of fingerprints to those of the edited text and the next document, by sets of words; one changed word keeps texts alike, anchors or not."""
    rows = {r["doc_id"]: r for r in spotsigs.compared(docs).collect() if r["doc_id"] != 7}
    order = sorted(_docs(), key=lambda d: -d[0])

    def likeness(a, b):
        return 1.0 if not a and not b else len(a & b) / len(a | b)

    for d, after in zip(order, order[1:] + order[:1], strict=True):
        if d[0] == 7 or not (d[1] or "").split() or not (after[1] or "").split():
            continue
        one, text = _plain_signatures(d[1]), spotsigs.edited(d[1], after[1])
        assert len(rows[d[0]]["fingerprint"]) == 8 * len(one) and len(rows[d[0]]["edited_fingerprint"]) == 8 * len(_plain_signatures(text))
        assert abs(rows[d[0]]["near_edited"] - likeness(one, _plain_signatures(text))) < 1e-9
        assert abs(rows[d[0]]["near_next"] - likeness(one, _plain_signatures(after[1]))) < 1e-9
    r = random.Random(3)
    for anchors in (0, 3, 4, 20):
        words = _text(r, 200).split()
        for i in range(anchors):
            words[10 * i] = "the"
        changed = [*words[:30], "zzzz", *words[31:]]
        known = spotsigs.Spots()
        assert spotsigs.likeness(*(spotsigs.signatures(" ".join(w), known) for w in (words, changed))) > 0.75


def test_classifiers_score_repeats_and_odd_texts_alike(spark):
    """Equal texts have equal scores, whatever their id and other columns; null, blank and very long texts are scored."""
    schema = "doc_id long, text string, score double, label int, x string, lang string, source string"
    texts = ["vile rotten filthy words", "vile rotten filthy words", None, "", " \n", "word " * 200_000, "x" * 300_000, "vile " * 50_000]
    odd = spark.createDataFrame([(i // 2, t, 0.1, 1, "x", None, None) for i, t in enumerate(texts)], schema)
    rows, labels = [], []
    r = random.Random(6)
    for i in range(200):
        bad = i % 4 == 0
        rows.append((i, _text(r, 20) + (" vile rotten filthy" if bad else ""), 0.0, 0, "x", "xx", "s"))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, schema)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, label int"))
    good = quality.train(docs, docs.where("doc_id % 4 <> 0").select("doc_id"))
    for out in (toxicity.score(odd, model).collect(), quality.score(odd, good).collect()):
        assert len(out) == len(texts) and all(0 <= x["score"] <= 1 for x in out)
        by_id = defaultdict(list)
        for x in out:
            by_id[x["doc_id"]].append(x["score"])
        assert len(set(by_id[0])) == 1  # the two equal texts
    assert [x for x in toxicity.score(odd, model).collect() if x["doc_id"] == 0][0]["score"] >= 0.3
    empty = odd.limit(0)
    assert toxicity.score(empty, model).count() == 0 and quality.score(empty, good).count() == 0
