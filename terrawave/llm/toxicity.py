"""Toxicity by weak supervision.

Voters are lexicon words and word beginnings (patterns), picked from a bounded sample of labelled training rows by a
test that corrects for the number of candidates. A generative label model of two latent classes estimates, by
expectation maximisation on the votes alone, how often each voter speaks in each class, and from the posterior how
strongly voters are correlated within a class; a voter's evidence is divided by the number of voters it repeats. A
logistic classifier on the voters' counts is then trained on the posterior labels and scores whole texts.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrawave.llm.folds import sample
from terrawave.llm.language_id import letters
from terrawave.session import small, stash

SAMPLE = 20_000  # labelled rows that voters and classifier are fitted on
VOTERS = 400
PREFIXES = (4, 5, 6)
KNOWN = 100_000
THRESHOLD = 0.3
PRECISION = 0.97  # least share of label 1 among the sampled rows that a voter speaks on


def _items(text: str | None) -> set[str]:
    """A text's words, and its words' beginnings with a star."""
    found = set()
    for raw in set((text or "").encode("utf-8", "replace").split()):
        if w := letters(raw):
            found.add(w)
            found.update(w[:k] + "*" for k in PREFIXES if len(w) > k)
    return found


def _document_counts(batches):
    for batch in batches:
        yes, no = Counter(), Counter()
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            (yes if label else no).update(_items(text))
        keys = list(yes | no)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([yes[k] for k in keys], pa.int64()), pa.array([no[k] for k in keys], pa.int64())], ["item", "yes", "no"])


class Votes(dict):
    """Numbers of the voters that a raw word sets off; forgets all when it holds KNOWN."""

    def __init__(self, voters: list[str]):
        self.at = {v: i for i, v in enumerate(voters)}

    def __missing__(self, raw: bytes) -> tuple[int, ...]:
        if len(self) >= KNOWN:
            self.clear()
        w = letters(raw)
        hits = tuple(self.at[x] for x in (w, *(w[:k] + "*" for k in PREFIXES if len(w) > k)) if x in self.at) if w else ()
        self[raw] = hits
        return hits

    def of(self, text: str | None) -> Counter:
        return Counter(i for hits in map(self.__getitem__, (text or "").encode("utf-8", "replace").split()) if hits for i in hits)


def label_model(votes: np.ndarray, prior: float, rounds: int = 50, accuracy: float = 0.9, strength: float = 4.0) -> np.ndarray:
    """Posterior of class 1 for votes [document, voter] of 0 and 1, from a generative model of correlated voters.

    A voter speaks for class 1 or is silent; what it says is divided by the number of voters on the document that it repeats. Its accuracy, the share of class 1 where it speaks, is estimated from the posterior, with a prior of `strength` votes. What the class balance leaves for documents without any vote is their posterior.
    """
    n, m = votes.shape
    some = votes.any(axis=1)
    if not m or not some.any():
        return np.full(n, prior)
    spoken = votes[some].astype(np.float64)
    base = np.log(prior / (1 - prior))
    p, times = np.full(len(spoken), accuracy), spoken.sum(axis=0)
    for _ in range(rounds):
        right = np.clip((p @ spoken + strength * accuracy) / (times + strength), 0.01, 0.995)
        # Voters that speak together within class 1 more than chance allows repeat each other.
        rate = (p @ spoken) / max(p.sum(), 1)
        seen = spoken * np.sqrt(p)[:, None]
        both = seen.T @ seen / max(p.sum(), 1)
        spread = np.sqrt(np.maximum(rate * (1 - rate), 1e-9))
        corr = np.clip((both - np.outer(rate, rate)) / np.outer(spread, spread), 0, 1)
        np.fill_diagonal(corr, 1)
        repeats = np.maximum(spoken @ (corr * (corr > 0.3)), 1)  # of each voter, among those that speak on the document
        new = 1 / (1 + np.exp(-np.clip(base + (spoken / repeats) @ (np.log(right / (1 - right)) - base), -30, 30)))
        done = np.abs(new - p).max() < 1e-4
        p = new
        if done:
            break
    out = np.full(n, min(prior, max(0.002, (prior * n - p.sum()) / max(n - len(p), 1))))
    out[some] = p
    return out


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-4, rounds: int = 400, times: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias for targets in [0, 1] of rows that count `times` each, from zero, by gradient steps with momentum; each weight's step is the inverse of a bound of the risk's curvature, so rare features keep up."""
    size = np.abs(x)
    reach = size.sum(axis=1) + 1
    share = np.full(len(y), 1 / len(y)) if times is None else times / times.sum()
    step = 1 / (0.25 * (size.T @ (reach * share)) + l2)
    step_b = 1 / (0.25 * (reach @ share))
    w, b, vw, vb = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0
    for _ in range(rounds):
        g = share * (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y)
        vw = 0.9 * vw - step * (x.T @ g + l2 * w)
        vb = 0.9 * vb - step_b * g.sum()
        w, b = w + vw, b + vb
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """A model from docs(doc_id, text) and labels(doc_id, label 0 or 1, not null), on about SAMPLE rows of them at most. Rows of either that share an id are joined in all ways. Without a label 1 the model has no voters and scores 0."""
    chosen = stash(sample(labels, SAMPLE), "chosen")
    rows = stash(docs.select("doc_id", "text").join(small(chosen), "doc_id").select("doc_id", "text", "label"), "labelled")
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not ones:
        return {"voters": [], "w": np.zeros(0), "b": -30.0}
    rate = ones / n
    counts = stash(rows.select("text", "label").mapInArrow(_document_counts, "item string, yes long, no long").groupBy("item").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).where("yes >= 3"), "items")
    # The chance of so many labels 1 at the base rate, by the Chernoff bound, times the number of candidates.
    q = F.col("yes") / (F.col("yes") + F.col("no"))
    gain = (F.col("yes") + F.col("no")) * (q * F.log(q / rate) + F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - rate))).otherwise(0.0))
    candidates = max(1, counts.count())
    picked = counts.where(q >= PRECISION).withColumn("gain", gain).where(F.col("gain") >= float(np.log(candidates / 0.05))).orderBy(F.desc("gain"), "item").limit(VOTERS).collect()
    voters = [r["item"] for r in picked]

    def run(batches):
        votes = Votes(voters)
        for batch in batches:
            hits = [votes.of(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([list(h) for h in hits], pa.list_(pa.int32())), pa.array([list(h.values()) for h in hits], pa.list_(pa.int32()))], ["voters", "times"])

    seen = rows.select("text").mapInArrow(run, "voters array<int>, times array<int>").toPandas()  # SAMPLE rows of votes
    x = np.zeros((len(seen), len(voters)), np.float32)
    for i, (v, t) in enumerate(zip(seen["voters"], seen["times"], strict=True)):
        x[i, v] = 1 + np.log(t)
    y = label_model(x > 0, rate)
    some = (x > 0).any(axis=1)
    silent = int((~some).sum())  # documents without a vote are alike: one row
    rows_x, rows_y, times = x[some].astype(np.float64), y[some], np.ones(int(some.sum()))
    if silent:
        rows_x, rows_y, times = np.vstack([rows_x, np.zeros(len(voters))]), np.append(rows_y, y[~some][0]), np.append(times, silent)
    w, b = logistic(rows_x, rows_y, l2=1e-5, rounds=3000, times=times)
    return {"voters": voters, "w": w, "b": b}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score in [0, 1] for each row; a null text is an empty one and has the score of no votes."""
    return _scored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), model, keep=1, schema="doc_id long, score double")


def _scored(rows: DataFrame, model: dict, keep: int, schema: str) -> DataFrame:
    """The first `keep` columns of rows and the score of the last."""
    voters, w, b = model["voters"], model["w"], model["b"]

    def run(batches):
        votes = Votes(voters)
        for batch in batches:
            out = [b + sum(w[i] * (1 + np.log(n)) for i, n in votes.of(t).items()) for t in batch.column(batch.num_columns - 1).to_pylist()]
            p = 1 / (1 + np.exp(-np.clip(np.array(out, np.float64), -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:keep], pa.array(p, pa.float64())], [*batch.schema.names[:keep], "score"])

    return rows.mapInArrow(run, schema)


def clean(docs: DataFrame, model: dict, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score below the threshold, with their columns."""
    wrapped = docs.select(F.struct("*").alias("doc")).select("doc", F.col(f"doc.{text_col}").cast("string").alias("text"))
    kind = wrapped.schema["doc"].dataType.simpleString()
    return _scored(wrapped, model, keep=1, schema=f"doc {kind}, score double").where(F.col("score") < threshold).select("doc.*")
