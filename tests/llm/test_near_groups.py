"""Large groups of near copies: few pairs are compared, and no link is lost."""

import random

from terrawave.llm import near_dedup


def _group(r: random.Random, n: int) -> list[tuple[int, str]]:
    """Copies of one text with words changed here and there; few pairs are similar enough, most are not far from it."""
    base = [f"w{i}" for i in range(400)]
    out = []
    for i in range(n):
        words = list(out[-1][1].split() if i % 10 == 9 else base)
        for at in r.sample(range(400), 2 if i % 10 == 9 else r.choice([6, 8, 9])):
            words[at] = f"x{i}_{at}"
        out.append((i, " ".join(words)))
    return out


def test_a_group_of_near_copies_takes_few_pairs_and_loses_no_link(spark, monkeypatch):
    docs = _group(random.Random(3), 150)
    words = {i: t.split() for i, t in docs}
    sets = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, w in words.items()}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    left, rest = [], near_dedup._rest
    monkeypatch.setattr(near_dedup, "_rest", lambda *x: left.append(rest(*x)) or left[-1])
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: find(i) for i in sets} and len(set(got.values())) > 20
    pairs = {(r["a"], r["b"]) for r in left[0].collect()}
    assert pairs <= set(links)  # what is left for the last comparison is linked


def test_lists_of_a_text_are_written_once_not_for_each_item(spark, monkeypatch):
    written, stash = [], near_dedup.stash
    monkeypatch.setattr(near_dedup, "release", lambda *frames: None)
    monkeypatch.setattr(near_dedup, "stash", lambda df, name="t": written.append((name, stash(df, name))) or written[-1][1])
    near_dedup.near_duplicates(spark.createDataFrame(_group(random.Random(3), 60), "doc_id long, text string")).count()
    texts = dict(written)["held"].count()
    listed = {name: t.count() for name, t in written if any(kind.startswith("array") for _, kind in t.dtypes)}
    assert texts and all(n <= max(texts, 60) for n in listed.values()), listed
