"""Language identification, word first.

A known word scores its log frequency in each language. An unseen word falls back to its character n-grams of length
4 that are known, and where none is, to those of length 3, 2 and 1. Counts are taken over all training rows; the model
keeps the WORDS most frequent words and the GRAMS most frequent n-grams of each length for each language, so that its
size is bounded by the number of languages.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrawave.session import small, stash

WORDS, GRAMS, LONGEST = 20_000, 5_000, 4
TIES = 1024
FLUSH = 200_000  # counts that a task holds before it passes them on
KNOWN = 100_000  # words whose scores a task remembers


def letters(word: bytes) -> str:
    """The word in lower case without what is no letter at its ends; "" if it has no letter."""
    w = word.decode("utf-8", "replace").lower()
    if not w.isalpha():
        i, j = 0, len(w)
        while i < j and not w[i].isalpha():
            i += 1
        while j > i and not w[j - 1].isalpha():
            j -= 1
        w = w[i:j]
    return w


def grams(word: str, n: int) -> list[str]:
    w = f" {word} " if n > 1 else word
    return [w[i : i + n] for i in range(len(w) - n + 1)]


def _counts(kind: str):
    """Partial counts of a task by language: of raw words, made words only when passed on, or of the n-grams of counted words."""

    def run(batches):
        counts: dict[str, Counter] = {}

        def flush():
            for lang, c in counts.items():
                if kind == "word":
                    made: Counter = Counter()
                    for raw, n in c.items():
                        if w := letters(raw):
                            made[w] += n
                    c = made
                items = list(c)
                for s in range(0, len(items), 50_000):
                    part = items[s : s + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array([kind] * len(part)), pa.array(part), pa.array([c[x] for x in part], pa.int64())], ["lang", "kind", "item", "n"])
            counts.clear()

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            if kind == "word":
                for lang, text in zip(*columns, strict=True):
                    counts.setdefault(lang, Counter()).update((text or "").encode("utf-8", "replace").split())
            else:
                for lang, word, n in zip(*columns, strict=True):
                    c = counts.setdefault(lang, Counter())
                    had = c.get
                    for g in grams(word, 1):
                        c[g] = had(g, 0) + n
                    w = f" {word} "
                    for k in range(2, LONGEST + 1):
                        for i in range(len(w) - k + 1):
                            g = w[i : i + k]
                            c[g] = had(g, 0) + n
            if sum(map(len, counts.values())) > FLUSH:
                yield from flush()
        yield from flush()

    return run


def _top(counts: DataFrame) -> DataFrame:
    """The most frequent items of each language and kind, as many as the model has room for. Where items of one count do not all fit, those stay whose hash falls into the first of TIES parts that do. Cuts come from the number of items by count and part, so no language is in one task."""
    counts = counts.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(TIES)))
    by_count = counts.groupBy("lang", "kind", "n", "part").agg(F.count("*").alias("items"))
    above = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "part")
    room = F.when(F.col("kind") == "w", WORDS).otherwise(GRAMS)
    fits = by_count.withColumn("upto", F.sum("items").over(above)).where(F.col("upto") <= room)
    cuts = fits.groupBy("lang", "kind").agg(F.min(F.struct("n", -F.col("part"))).alias("last")).select("lang", "kind", F.col("last.n").alias("cut"), (-F.col("last.col2")).alias("upto"))
    return counts.join(small(stash(cuts, "cuts")), ["lang", "kind"]).where((F.col("n") > F.col("cut")) | ((F.col("n") == F.col("cut")) & (F.col("part") <= F.col("upto")))).select("lang", "kind", "item", "n")


def train(docs: DataFrame) -> dict:
    """A model from docs(text, lang), rows without lang left out. Its tables are of bounded size; counting is done by Spark."""
    schema = "lang string, kind string, item string, n long"
    rows = docs.where("lang is not null").select("lang", "text")
    found = stash(rows.mapInArrow(_counts("word"), schema).groupBy("lang", "item").agg(F.sum("n").alias("n")), "words")
    pieces = stash(found.mapInArrow(_counts("gram"), schema).groupBy("lang", "item").agg(F.sum("n").alias("n")), "grams")
    pieces = pieces.select("lang", F.char_length("item").cast("string").alias("kind"), "item", "n")
    everything = found.select("lang", F.lit("w").alias("kind"), "item", "n").unionByName(pieces)
    totals = everything.groupBy("lang", "kind").agg(F.sum("n").alias("n"), F.count("*").alias("items")).collect()  # a few rows for each language
    top = _top(everything)
    langs = sorted({t["lang"] for t in totals})
    if not langs:
        return {"langs": ["und"], "tables": {}, "floor": {}}
    at = {lang: i for i, lang in enumerate(langs)}
    size = {(t["lang"], t["kind"]): (t["n"], t["items"]) for t in totals}
    tables: dict[str, dict[str, np.ndarray]] = {}
    floor: dict[str, np.ndarray] = {}
    for kind in ["w", *map(str, range(1, LONGEST + 1))]:
        floor[kind] = np.array([np.log(0.5 / (sum(size.get((lang, kind), (1, 1))) + 1)) for lang in langs])
    for r in top.toLocalIterator():  # bounded by the parameters
        v = tables.setdefault(r["kind"], {})
        if r["item"] not in v:
            v[r["item"]] = floor[r["kind"]].copy()
        n, items = size[r["lang"], r["kind"]]
        v[r["item"]][at[r["lang"]]] = np.log((r["n"] + 0.5) / (n + items + 1))
    return {"langs": langs, "tables": tables, "floor": floor}


class Scores(dict):
    """Rows of `matrix`, which has the score of each language, by words as they stand in the text; forgets all when it holds KNOWN."""

    def __init__(self, model: dict):
        self.words = model["tables"].get("w", {})
        self.none = np.zeros(len(model["langs"]))
        self.matrix = np.zeros((KNOWN, len(model["langs"])))
        # All known n-grams in one table: lengths tell them apart.
        tables = [model["tables"].get(str(n), {}) for n in range(1, LONGEST + 1)]
        self.row = {g: i for i, g in enumerate(g for t in tables for g in t)}
        self.grams = np.array([v for t in tables for v in t.values()]).reshape(len(self.row), len(model["langs"]))

    def of(self, text: str) -> np.ndarray:
        """The sum of the scores of a text's words."""
        count = Counter(text.encode("utf-8", "replace").split())
        if len(self) + len(count) > len(self.matrix):
            self.clear()
            self.matrix = np.zeros((max(KNOWN, len(count)), self.matrix.shape[1]))
        new = [raw for raw in count if raw not in self]
        if new:
            self.learn(new)
        at = np.fromiter(map(self.__getitem__, count), np.int64, len(count))
        return np.fromiter(count.values(), np.float64, len(count)) @ self.matrix[at]

    def learn(self, new: list[bytes]) -> None:
        """Scores of words not met before; those of unseen words are means over the longest known n-grams, taken for all of them at once."""
        hits, sizes, backed = [], [], []
        find = self.row.get
        for raw in new:
            self[raw] = at = len(self)
            word, score = letters(raw), self.none
            if word:
                score = self.words.get(word)
                if score is None:
                    w = f" {word} "
                    for n in range(LONGEST, 0, -1):
                        if n == 1:
                            w = word
                        found = [j for i in range(len(w) - n + 1) if (j := find(w[i : i + n])) is not None]
                        if found:
                            hits += found
                            sizes.append(len(found))
                            backed.append(at)
                            break
                    continue
            self.matrix[at] = score
        if backed:
            starts = np.cumsum([0, *sizes[:-1]])
            self.matrix[backed] = np.add.reduceat(self.grams[hits], starts, axis=0) / np.array(sizes)[:, None]


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for each row: `und` with score 0 for a null text or one without a letter. Of languages with one score, the first by code point is taken."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, lang_pred string, score double"

    def run(batches):
        known, langs = Scores(shared.value), shared.value["langs"]
        for batch in batches:
            pred, score = [], []
            for text in batch.column(1).to_pylist():
                if not text or not any(map(str.isalpha, text)):
                    pred.append("und")
                    score.append(0.0)
                    continue
                total = known.of(text)
                p = np.exp(total - total.max())
                pred.append(langs[int(total.argmax())])
                score.append(float(1 / p.sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(run, schema)
