"""Recursive filters over series of any length, forward and back without a shift of phase.

A filter is a cascade of second-order sections, and as such a small linear system: what a block of samples leaves behind is
a power of one matrix times the state it began with, plus what it leaves when it begins at rest. So every block is run at
rest first; a pass over the blocks of a key, a few numbers each, composes these into the state that each begins with; and
every block is run once more from there. Back in time the same is done on the result. A key is one run without gaps.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from terrawave.operators.blocks import BLOCK, by_slices, packed, unpacked
from terrawave.session import small, stash

STEP = 64  # samples of a block that one matrix product takes


def butterworth(order: int, cutoff, rate: float, kind: str) -> np.ndarray:
    """Sections b0 b1 b2 a1 a2 of a low, high or band filter by the bilinear transform; cutoff in Hz, two of them for a band."""
    edges = np.atleast_1d(np.asarray(cutoff, float))
    if not ((edges > 0) & (edges < rate / 2)).all() or len(edges) != (2 if kind == "band" else 1) or kind not in ("low", "high", "band"):
        raise ValueError(f"no {kind} filter at {cutoff} Hz of {rate} Hz")
    if order < 2 or order % 2:
        raise ValueError("the order must be even")
    poles = np.exp(1j * np.pi * (2 * np.arange(order) + order + 1) / (2 * order))
    warped = 2 * np.tan(np.pi * edges / rate)
    if kind == "low":
        poles, zeros, at = poles * warped[0], (-1.0, -1.0), 0.0
    elif kind == "high":
        poles, zeros, at = warped[0] / poles, (1.0, 1.0), np.pi
    else:
        half, centre = poles * (warped[1] - warped[0]) / 2, np.sqrt(warped[0] * warped[1])
        root = np.sqrt(half**2 - centre**2)
        poles, zeros, at = np.concatenate((half + root, half - root)), (1.0, -1.0), 2 * np.arctan(centre / 2)
    poles = (2 + poles) / (2 - poles)
    poles = poles[poles.imag > 0]
    poles = poles[np.argsort(-np.abs(poles.imag), kind="stable")]
    z = np.exp(-1j * at)
    sections = []
    for p in poles:
        b = np.array([1.0, -zeros[0] - zeros[1], zeros[0] * zeros[1]])
        a = np.array([1.0, -2 * p.real, abs(p) ** 2])
        gain = abs((a @ [1, z, z * z]) / (b @ [1, z, z * z]))
        sections.append([*(b * gain), a[1], a[2]])
    return np.array(sections)


def notch_comb(f0: float, rate: float, harmonics: int = 9, q: float = 30.0, passes: int = 2, extra: tuple[float, ...] = ()) -> np.ndarray:
    """Sections of notches at f0 and its harmonics below the Nyquist frequency and at the extra lines there, each so many times."""
    lines = [f for f in [f0 * i for i in range(1, harmonics + 1)] + list(extra) if 0 < f < rate / 2]
    out = []
    for f in lines:
        w = 2 * np.pi * f / rate
        gain = 1 / (1 + np.tan(w / q / 2))
        out.append([gain, -2 * gain * np.cos(w), gain, -2 * gain * np.cos(w), 2 * gain - 1])
    return np.array(out * passes).reshape(-1, 5)


class System:
    """Sections as one linear system: s' = A s + B x, y = C s + D x."""

    def __init__(self, sections: np.ndarray):
        n = 2 * len(sections)
        self.a, self.b, self.c, self.d = np.zeros((n, n)), np.zeros(n), np.zeros(n), 1.0
        for i, (b0, b1, b2, a1, a2) in enumerate(sections):
            # The section's input is what those before it put out.
            at, (row, gain) = 2 * i, (self.c.copy(), self.d)
            for j, (b, a) in enumerate(((b1, a1), (b2, a2))):
                self.a[at + j] += (b - a * b0) * row
                self.b[at + j] = (b - a * b0) * gain
                self.a[at + j, at] -= a
            self.a[at, at + 1] += 1
            self.c, self.d = b0 * row, b0 * gain
            self.c[at] += 1
        self.rest = np.linalg.solve(np.eye(n) - self.a, self.b)  # state under a constant input of one
        power, self.out, self.into = np.eye(n), np.zeros((STEP, n)), np.zeros((n, STEP))
        response = np.zeros(STEP)
        for i in range(STEP):
            self.out[i] = self.c @ power
            self.into[:, STEP - 1 - i] = power @ self.b
            response[i] = self.d if i == 0 else self.out[i - 1] @ self.b
            power = self.a @ power
        self.leap = power
        i = np.arange(STEP)
        self.toeplitz = np.where(i[:, None] >= i, response[np.abs(i[:, None] - i)], 0.0)

    def run(self, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Output, and the state at the end."""
        whole = len(x) // STEP
        parts = x[: whole * STEP].reshape(whole, STEP)
        push = parts @ self.into.T
        states = np.empty((whole, len(state)))
        for i in range(whole):
            states[i] = state
            state = self.leap @ state + push[i]
        y = (parts @ self.toeplitz.T + states @ self.out.T).ravel()
        tail = []
        for v in x[whole * STEP :]:
            tail.append(self.c @ state + self.d * v)
            state = self.a @ state + self.b * v
        return np.concatenate((y, tail)), state


def padding(sections: np.ndarray) -> int:
    """Samples by which a run is continued, turned about its ends, before it is filtered."""
    return 3 * (2 * len(sections) + 1 - int(min((sections[:, 2] == 0).sum(), (sections[:, 4] == 0).sum())))


def continued(rows: DataFrame, keys: list[str], x: str, pad: int, k: str = "k") -> DataFrame:
    """keys, k, x with so many samples more at both ends, the run turned about its first and last one; lo and hi are the old ends."""
    slim = rows.select(*keys, F.col(k).cast("long").alias("k"), F.col(x).cast("double").alias("x"))
    known = slim.groupBy(*keys).agg(F.min("k").alias("lo"), (F.max("k") + 1).alias("hi"), F.min_by("x", "k").alias("_first"), F.max_by("x", "k").alias("_last"))
    slim = slim.join(small(known), keys)
    one = F.when((F.col("k") > F.col("lo")) & (F.col("k") <= F.col("lo") + pad), F.struct((2 * F.col("lo") - F.col("k")).alias("k"), (2 * F.col("_first") - F.col("x")).alias("x")))
    other = F.when((F.col("k") < F.col("hi") - 1) & (F.col("k") >= F.col("hi") - 1 - pad), F.struct((2 * F.col("hi") - 2 - F.col("k")).alias("k"), (2 * F.col("_last") - F.col("x")).alias("x")))
    all_ = F.filter(F.array(F.struct("k", "x"), one, other), lambda v: v.isNotNull())
    return slim.select(*keys, "lo", "hi", F.explode(all_).alias("_r")).select(*keys, "lo", "hi", "_r.k", "_r.x")


def _carried(left: DataFrame, keys: list[str], system: System, back: bool) -> DataFrame:
    """keys, _block, state that each block begins with; left(keys, _block, n, edge, left), edge the first sample it meets."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_block", ascending=not back)
        states, state = [], system.rest * part["edge"].iloc[0]
        powers: dict[int, np.ndarray] = {}
        for n, end in zip(part["n"].tolist(), part["left"], strict=True):
            states.append(state)
            if n not in powers:
                powers[n] = np.linalg.matrix_power(system.a, n)
            state = powers[n] @ state + np.asarray(end)
        return part[[*keys, "_block"]].assign(state=states)

    schema = left.select(*keys, "_block").schema.add("state", ArrayType(DoubleType()))
    return left.groupBy(*keys).applyInPandas(run, schema)


def _at_rest(held: DataFrame, keys: list[str], system: System, back: bool) -> DataFrame:
    schema = held.select(*keys, "_block").schema.add("n", "long").add("edge", "double").add("left", ArrayType(DoubleType()))

    def run(batch):
        xs = [np.asarray(v, float)[:: -1 if back else 1] for v in batch["x"]]
        zero = np.zeros(len(system.b))
        return batch[[*keys, "_block"]].assign(n=[len(v) for v in xs], edge=[v[0] for v in xs], left=[system.run(v, zero)[1] for v in xs])

    return by_slices(held.select(*keys, "_block", "x"), run, schema)


def _passed(held: DataFrame, keys: list[str], system: System, back: bool) -> DataFrame:
    """held with x filtered in one direction."""
    states = _carried(_at_rest(held, keys, system, back), keys, system, back)
    schema = held.schema

    def run(batch):
        ys = []
        for x, state in zip(batch["x"], batch["state"], strict=True):
            y, _ = system.run(np.asarray(x, float)[:: -1 if back else 1], np.asarray(state, float))
            ys.append(y[:: -1 if back else 1])
        return batch.drop(columns="state").assign(x=ys)[schema.names]

    return by_slices(held.hint("merge").join(states.hint("merge"), [*keys, "_block"]), run, schema)


def zero_phase(rows: DataFrame, keys: list[str], x: str, sections: np.ndarray, block: int = BLOCK, k: str = "k") -> DataFrame:
    """keys, k, x filtered forward and back, each run continued at its ends; a run needs more samples than `padding`, a shorter one is continued as far as it goes. Null samples are none: fill them first."""
    if not len(sections):
        return rows.select(*keys, F.col(k).cast("long").alias("k"), F.col(x).cast("double").alias(x))
    system = System(sections)
    long = continued(rows.where(F.col(x).isNotNull()), keys, x, padding(sections), k)
    span = long.select(*keys, "k", "x", "lo", "hi")
    own = [*keys, "lo", "hi"]
    # A pass reads its blocks twice, so they are written before each.
    held = stash(packed(span, own, ["x"], block), "blocks")
    out = _passed(stash(_passed(held, keys, system, False), "passed"), keys, system, True)
    return unpacked(out, own, ["x"]).where("k >= lo and k < hi").select(*keys, "k", F.col("x").alias(x))


def filtered(rows: DataFrame, keys: list[str], x: str, rate: float, cutoff, kind: str, order: int = 4, block: int = BLOCK, k: str = "k") -> DataFrame:
    """keys, k, x through a Butterworth filter (low, high or band) without a shift of phase."""
    return zero_phase(rows, keys, x, butterworth(order, cutoff, rate, kind), block, k)


def notched(rows: DataFrame, keys: list[str], x: str, rate: float, f0: float = 50.0, block: int = BLOCK, k: str = "k", **options) -> DataFrame:
    """keys, k, x less f0 and its harmonics; all notches are one cascade, so that a run is passed twice in all."""
    return zero_phase(rows, keys, x, notch_comb(f0, rate, **options), block, k)
