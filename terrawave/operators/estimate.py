"""Transfer functions from band sums: remote reference, coherence and grouped jackknife errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrawave.functions import cx

ELEMENTS = ("xx", "xy", "yx", "yy")
MIN_GROUPS = 5  # of a jackknife
#: Cross-powers needed for e = Z h with remote r: electric and magnetic channels against the remote.
PAIRS = [(a, r) for a in ("ex", "ey", "hx", "hy") for r in ("rx", "ry")]


def _c(a: str, b: str, of=F.col) -> cx.Complex:
    return of(f"{a}_{b}_re"), of(f"{a}_{b}_im")


def impedance(sums: DataFrame, keys: list[str], of=F.col) -> list[tuple[str, Column]]:
    """zxx_re ... zyy_im: Z = <E R*> <H R*>^-1, null where the magnetic matrix is singular."""
    e = [[_c(a, r, of) for r in ("rx", "ry")] for a in ("ex", "ey")]
    h = [[_c(a, r, of) for r in ("rx", "ry")] for a in ("hx", "hy")]
    z = cx.right_divide(e, h)
    return [(f"z{ELEMENTS[2 * i + j]}_{p}", z[i][j][q]) for i in range(2) for j in range(2) for q, p in enumerate(("re", "im"))]


def remote_reference(sums: DataFrame, keys: list[str]) -> DataFrame:
    """keys and the eight parts of Z."""
    return sums.select(*keys, *(c.alias(n) for n, c in impedance(sums, keys)))


def jackknife(groups: DataFrame, keys: list[str]) -> DataFrame:
    """keys, Z, and z.._err from band sums by group (keys, group, n, sums): the weighted delete-a-group jackknife.

    With weights n_g / n, the pseudo-values h Z - (h - 1) Z_without_g, h = n / n_g, give the estimate's variance as the mean of their squared distances from their weighted mean over h - 1. Fewer than MIN_GROUPS groups give no errors.
    """
    names = [f"{a}_{r}_{p}" for a, r in PAIRS for p in ("re", "im")]
    total = groups.groupBy(*keys).agg(F.sum("n").alias("_n"), F.count("*").alias("_g"), *(F.sum(c).alias(f"t_{c}") for c in names))
    rows = groups.join(total, keys)
    whole = impedance(rows, keys, of=lambda c: F.col(f"t_{c}"))
    without = impedance(rows, keys, of=lambda c: F.col(f"t_{c}") - F.col(c))
    h = F.col("_n") / F.col("n")
    rows = rows.select(*keys, "_g", h.alias("_h"), *(c.alias(n) for n, c in whole), *((h * w[1] - (h - 1) * o[1]).alias(f"p_{w[0]}") for w, o in zip(whole, without, strict=True)))
    zs = [n for n, _ in whole]
    # The weighted mean of pseudo-values: weights 1 / h.
    means = rows.groupBy(*keys).agg(*((F.sum(F.col(f"p_{n}") / F.col("_h"))).alias(f"m_{n}") for n in zs))
    rows = rows.join(means, keys)
    var = {z: F.sum((F.pow(F.col(f"p_z{z}_re") - F.col(f"m_z{z}_re"), 2) + F.pow(F.col(f"p_z{z}_im") - F.col(f"m_z{z}_im"), 2)) / F.nullif(F.col("_h") - 1, F.lit(0.0))) for z in ELEMENTS}
    out = rows.groupBy(*keys).agg(F.max("_g").alias("groups"), *(F.max(n).alias(n) for n in zs), *((F.when(F.max("_g") >= MIN_GROUPS, F.sqrt(v / F.max("_g")))).alias(f"z{z}_err") for z, v in var.items()))
    return out


def coherence(sums: DataFrame, a: str, b: str) -> Column:
    """Squared coherence of a and b in [0, 1]."""
    re, im = _c(a, b)
    return F.least(F.lit(1.0), (re * re + im * im) / F.nullif(F.col(f"{a}_{a}_re") * F.col(f"{b}_{b}_re"), F.lit(0.0)))
