"""Huber-weighted remote-reference estimates: reweighting is a fixed number of rounds of aggregates over all keys at once, each one job over a table that is written once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrawave.functions import cx
from terrawave.session import release, small, stash

THRESHOLD, SCALE, ROUNDS, TOLERANCE = 1.5, 1.4826, 12, 1e-5
_B = ("b1_re", "b1_im", "b2_re", "b2_im")


def _c(name: str) -> cx.Complex:
    return F.col(f"{name}_re"), F.col(f"{name}_im")


def normal_sums(y: str, x: tuple[str, str], r: tuple[str, str], weight: Column) -> dict[str, Column]:
    """Sums of w r_i* x_j, as m1_i and m2_i, and of w r_i* y, as c_i, in parts."""
    out = {}
    for i in range(2):
        for name, other in (("m1", x[0]), ("m2", x[1]), ("c", y)):
            re, im = cx.mul(cx.conj(_c(r[i])), _c(other))
            out |= {f"{name}_{i}_re": F.sum(weight * re), f"{name}_{i}_im": F.sum(weight * im)}
    return out


def solution(of=F.col) -> tuple[cx.Complex, cx.Complex]:
    """b1, b2 of the equations whose sums `of` gives by name; null where they are singular."""
    m = [[(of(f"m{j + 1}_{i}_re"), of(f"m{j + 1}_{i}_im")) for j in range(2)] for i in range(2)]
    c = [(of(f"c_{i}_re"), of(f"c_{i}_im")) for i in range(2)]
    det = cx.sub(cx.mul(m[0][0], m[1][1]), cx.mul(m[0][1], m[1][0]))
    return cx.div(cx.sub(cx.mul(m[1][1], c[0]), cx.mul(m[0][1], c[1])), det), cx.div(cx.sub(cx.mul(m[0][0], c[1]), cx.mul(m[1][0], c[0])), det)


def with_solution(sums: DataFrame, names: tuple[str, str, str, str], keep: list[str]) -> DataFrame:
    """keep and the parts of the solution under these names; in steps, so that no part is worked out twice."""
    m = [[_c(f"m{j + 1}_{i}") for j in range(2)] for i in range(2)]
    det = cx.sub(cx.mul(m[0][0], m[1][1]), cx.mul(m[0][1], m[1][0]))
    c = [_c(f"c_{i}") for i in range(2)]
    tops = cx.sub(cx.mul(m[1][1], c[0]), cx.mul(m[0][1], c[1])), cx.sub(cx.mul(m[0][0], c[1]), cx.mul(m[1][0], c[0]))
    step = sums.select(*keep, det[0].alias("_d_re"), det[1].alias("_d_im"), *(t[q].alias(f"_t{i}_{p}") for i, t in enumerate(tops) for q, p in enumerate(("re", "im"))))
    step = step.withColumn("_n", F.nullif(cx.power(_c("_d")), F.lit(0.0)))
    out = [v / F.col("_n") for i in range(2) for v in cx.mul(_c(f"_t{i}"), cx.conj(_c("_d")))]
    return step.select(*keep, *(v.alias(n) for n, v in zip(names, out, strict=True)))


def residual(y: str, x: tuple[str, str], b: str = "") -> Column:
    """Modulus of y - x b, of the columns b1, b2 with this prefix."""
    return F.sqrt(cx.power(cx.sub(_c(y), cx.add(cx.mul(_c(x[0]), _c(f"{b}b1")), cx.mul(_c(x[1]), _c(f"{b}b2"))))))


def weight_of(left: Column, scale: Column, threshold: float = THRESHOLD) -> Column:
    return F.least(F.lit(1.0), threshold * scale / F.greatest(left, F.lit(1e-30)))


def solved(rows: DataFrame, keys: list[str], y: str, x: tuple[str, str], r: tuple[str, str], threshold: float = THRESHOLD, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """keys, n, b1, b2 (re, im), and what the last weights came from: an earlier solution w_b1, w_b2 and a scale (null before any round).

    A key whose solution moves by no more than `tolerance` of itself stays as it is in later rounds. The table returned is stashed.
    """
    own = dict(zip(("_y", "_x0", "_x1", "_q0", "_q1"), (y, *x, *r), strict=True))
    slim = stash(rows.select(*keys, *(F.col(f"{c}_{p}").alias(f"{n}_{p}") for n, c in own.items() for p in ("re", "im"))), "spectra")
    y, x, r = "_y", ("_x0", "_x1"), ("_q0", "_q1")
    sums = slim.groupBy(*keys).agg(*(v.alias(k) for k, v in normal_sums(y, x, r, F.lit(1.0)).items()), F.count("*").alias("n"))
    now = stash(with_solution(sums, _B, [*keys, "n"]).select("*", *(F.col(c).alias(f"w_{c}") for c in _B), F.lit(None).cast("double").alias("scale"), F.lit(False).alias("done")), "b")
    held = [c for c in now.columns if c not in (*keys, "n")]
    for _ in range(rounds):
        found = slim.join(small(now), keys).withColumn("_r", residual(y, x))
        scale = found.groupBy(*keys).agg((SCALE * F.percentile("_r", F.lit(0.5)) + 1e-30).alias("_s"))
        weighed = found.join(scale, keys)
        sums = weighed.groupBy(*keys).agg(*(v.alias(k) for k, v in normal_sums(y, x, r, weight_of(F.col("_r"), F.col("_s"), threshold)).items()), F.count("*").alias("n"), F.first("_s").alias("_s"), *(F.first(c).alias(c) for c in held))
        new = with_solution(sums, tuple(f"_{c}" for c in _B), [*keys, "n", "_s", *held])
        close = F.lit(True)
        for b in ("b1", "b2"):
            close &= F.sqrt(cx.power(cx.sub(_c(f"_{b}"), _c(b)))) <= tolerance * F.sqrt(cx.power(_c(b)))
        out = [F.when(F.col("done"), F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in _B]
        out += [F.when(F.col("done"), F.col(f"w_{c}")).otherwise(F.col(c)).alias(f"w_{c}") for c in _B]
        after = stash(new.select(*keys, "n", *out, F.when(F.col("done"), F.col("scale")).otherwise(F.col("_s")).alias("scale"), (F.col("done") | F.coalesce(close, F.lit(False))).alias("done")), "b")
        release(now)
        now = after
    release(slim)
    return now


def huber(rows: DataFrame, keys: list[str], y: str, x: tuple[str, str], r: tuple[str, str], threshold: float = THRESHOLD, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """keys, n, b1, b2 (re, im): y = b1 x1 + b2 x2 by remote reference r, residuals beyond `threshold` robust scales weighted down, after so many rounds at most. Put outputs in keys to solve several at once."""
    return solved(rows, keys, y, x, r, threshold, rounds, tolerance).select(*keys, "n", *_B)


def outputs_long(rows: DataFrame, outputs: dict[str, str], name: str = "output", y: str = "y") -> DataFrame:
    """rows once for each output, its channel as y and its name beside it."""
    each = F.array(*(F.struct(F.lit(k).alias(name), F.col(f"{c}_re").alias(f"{y}_re"), F.col(f"{c}_im").alias(f"{y}_im")) for k, c in outputs.items()))
    return rows.select("*", F.explode(each).alias("_o")).select(*rows.columns, "_o.*")
