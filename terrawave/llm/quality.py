"""Document quality by positive-unlabelled learning.

Trusted positives and unlabelled documents, bounded samples of each, train a linear classifier on shape features of the
text (shares of characters, repetition, lengths). The class prior is estimated from the two score distributions of a
first positive-against-unlabelled classifier: the least ratio of the unlabelled to the positive share above a score.
The final classifier minimises the non-negative unbiased risk: when the estimated risk of the negatives falls below
zero, the step goes against it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrawave.llm.folds import sample
from terrawave.llm.text import slices
from terrawave.llm.toxicity import logistic

POSITIVES, UNLABELLED = 8_000, 16_000  # rows that the classifier is fitted on, at most
FEATURES = 128 + 10


def features(text: str | None) -> np.ndarray:
    b = (text or "").encode("utf-8", "replace")
    out = np.zeros(FEATURES, np.float32)
    out[128] = np.log1p(len(b))
    if not b:
        return out
    hist = np.bincount(np.frombuffer(b, np.uint8), minlength=256) / len(b)
    out[:128] = np.sqrt(hist[:128])
    words, lines = b.split(), b.split(b"\n")
    upper, lower, digit = hist[65:91].sum(), hist[97:123].sum(), hist[48:58].sum()
    wide = hist[128:].sum()
    out[129] = wide
    out[130] = upper / max(upper + lower + wide, 1e-6)
    out[131] = 1 - upper - lower - digit - wide - hist[9:14].sum() - hist[32]
    out[132] = digit
    out[133] = len(set(words)) / max(len(words), 1)
    out[134] = np.log1p(len(words))
    out[135] = len(b) / max(len(words), 1) / 10
    out[136] = len(set(lines)) / len(lines)
    out[137] = np.log1p(len(b) / len(lines))
    return out


def _vectors(batches):
    for batch in batches:
        out = [features(t).tobytes() for t in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["x"])


def _collected(rows: DataFrame) -> np.ndarray:
    """Features of a bounded sample of rows(text)."""
    got = [r["x"] for r in rows.select("text").mapInArrow(_vectors, "x binary").collect()]
    return np.frombuffer(b"".join(got), np.float32).reshape(-1, FEATURES).astype(np.float64)


def _added(rows: DataFrame, of, size: int) -> np.ndarray:
    """The sum over all rows(text) of of(features [rows, FEATURES]), an array of `size` numbers: a task passes on one partial sum."""

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for s in slices(texts):
                total += of(np.stack([features(t) for t in texts[s]]).astype(np.float64))
        yield pa.RecordBatch.from_arrays([pa.array([i for i in range(size)], pa.int32()), pa.array(total)], ["i", "v"])

    sums = rows.select(F.col("text").cast("string")).mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()  # `size` rows
    out = np.zeros(size)
    for r in sums:
        out[r["i"]] = r["v"]
    return out


def moments(docs: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of documents, and the mean and scale of each feature over all of them."""
    got = _added(docs, lambda x: np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)]), 1 + 2 * FEATURES)
    n, first, second = max(got[0], 1.0), got[1 : 1 + FEATURES], got[1 + FEATURES :]
    mean = first / n
    scale = np.sqrt(np.maximum(second / n - mean**2, 0))
    return int(got[0]), mean, np.where(scale > 1e-6, scale, 1.0)


def cuts_of(positive: np.ndarray) -> np.ndarray:
    return np.quantile(positive, np.linspace(0.02, 0.9, 45))


def class_prior(positive: np.ndarray, above: np.ndarray, n: int) -> float:
    """Share of positives among n unlabelled documents, from positives' scores and the number of documents at or above each of their cuts: the least ratio of the shares, with room for sampling error."""
    p = (positive[:, None] >= cuts_of(positive)).mean(axis=0)
    u = above / max(n, 1)
    slack = np.sqrt(np.log(20) / (2 * len(positive))) + np.sqrt(np.log(20) / (2 * max(n, 1)))
    best = int(np.argmin((u + slack) / p))
    return float(np.clip(u[best] / p[best], 0.05, 0.98))


def non_negative_risk(p: np.ndarray, u: np.ndarray, prior: float, rounds: int = 1500, rate: float = 0.2) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) with the logistic loss."""
    w, b, vw, vb = np.zeros(p.shape[1]), 0.0, np.zeros(p.shape[1]), 0.0
    l2 = 1e-4 + 4 / len(p)  # few positives allow only small weights
    for _ in range(rounds):
        sp, su = (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) for x in (p, u))
        negative = -np.log1p(-np.minimum(su, 1 - 1e-9)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-9)).mean()
        gp, gu = (sp - 1) * prior / len(sp), su / len(su)
        gn = -prior * sp / len(sp)
        if negative >= 0:
            gw, gb = p.T @ (gp + gn) + u.T @ gu, (gp + gn).sum() + gu.sum()
        else:
            gw, gb = -(p.T @ gn + u.T @ gu), -(gn.sum() + gu.sum())
        vw, vb = 0.9 * vw - rate * (gw + l2 * w), 0.9 * vb - rate * gb
        w, b = w + vw, b + vb
    return w, float(b)


def train(docs: DataFrame, positives: DataFrame) -> dict:
    """A model from docs(doc_id, text), all of them unlabelled, and positives(doc_id). Means, scales and the class prior are of all documents; only the risk's steps are taken on bounded samples. Without positives or documents every score is 0.5."""
    chosen = sample(positives.select("doc_id").dropDuplicates(), POSITIVES)
    p = _collected(docs.join(F.broadcast(chosen), "doc_id", "left_semi"))
    u = _collected(sample(docs.select("doc_id", "text"), UNLABELLED, seed=11))
    if not len(p) or not len(u):
        return {"mean": np.zeros(FEATURES), "scale": np.ones(FEATURES), "w": np.zeros(FEATURES), "b": 0.0, "prior": 0.5}
    n, mean, scale = moments(docs)
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (p, u))
    w, b = logistic(np.concatenate([p, u]), np.concatenate([np.ones(len(p)), np.zeros(len(u))]), l2=1e-3, rounds=300)
    at = cuts_of(p @ w + b)
    above = _added(docs, lambda x: (np.clip((x - mean) / scale, -8, 8) @ w + b >= at[:, None]).sum(axis=1).astype(np.float64), len(at))
    prior = class_prior(p @ w + b, above, n)
    w, b = non_negative_risk(p, u, prior)
    return {"mean": mean, "scale": scale, "w": w, "b": b, "prior": prior}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score in [0, 1], higher for better text, of each row; a null text is an empty one."""
    mean, scale, w, b = model["mean"], model["scale"], model["w"], model["b"]

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            out = np.zeros(len(texts))
            for s in slices(texts):
                x = np.clip((np.stack([features(t) for t in texts[s]]) - mean) / scale, -8, 8)
                out[s] = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, score double")
