"""Two-by-two tensors between channel pairs by remote reference: estimates with errors from slices of the record, coherences, flags, and the delay in their phases.

All of a band's figures come from sums by output and slice; leaving a slice out is a difference of sums.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from terrawave.functions import cx
from terrawave.operators.robust import THRESHOLD, normal_sums, outputs_long, residual, solution, solved, weight_of
from terrawave.session import small, stash

MIN_SAMPLES, MIN_LEFT, MIN_SLICES, FEW_SLICES, LOW_COHERENCE = 20, 8, 3, 5, 0.1
ELEMENTS = ("xx", "xy", "yx", "yy")


def slice_of(at: Column, record: Column, slices: int = 20) -> Column:
    """Which of so many equal slices of a record a time from its start lies in."""
    return F.least(F.floor(at / record * slices), F.lit(slices - 1)).cast("int")


def _c(name: str) -> cx.Complex:
    return F.col(f"{name}_re"), F.col(f"{name}_im")


def _powers(columns: dict[str, str], r: tuple[str, str], weight: Column, tag: str) -> dict[str, Column]:
    """Sums of w r_1 r_2* and of w |c|^2 of the channels of columns and of the references."""
    re, im = cx.mul(_c(r[0]), cx.conj(_c(r[1])))
    out = {f"{tag}s_re": F.sum(weight * re), f"{tag}s_im": F.sum(weight * im)}
    for name, c in ({"r0": r[0], "r1": r[1]} | columns).items():
        out[f"{tag}{name}"] = F.sum(weight * cx.power(_c(c)))
    return out


def multiple_coherence(c0: cx.Complex, c1: cx.Complex, s: cx.Complex, p0: Column, p1: Column, power: Column) -> Column:
    """Squared multiple coherence of a channel on two others, of sums of their powers p0, p1, of r0 r1* (s), and of r_i* y (c0, c1)."""
    mixed = cx.mul(cx.mul(c0, s), cx.conj(c1))[0]
    return (p1 * cx.power(c0) + p0 * cx.power(c1) - 2 * mixed) / F.nullif(p0 * p1 - cx.power(s), F.lit(0.0)) / F.nullif(power, F.lit(0.0))


def tensor(rows: DataFrame, keys: list[str], outputs: tuple[str, str], inputs: tuple[str, str], reference: tuple[str, str], method: str = "huber", rounds: int = 12) -> DataFrame:
    """keys, n, n_groups, t_xx .. t_yy (re, im, err), det, abs_det_err, half_arg, half_arg_err (degrees), coh_out, coh_in, coh_weighted, down (of x and y), f_weighted.

    rows(keys, h, f, slice, spectra): h numbers a band's harmonics of frequency f, slice is the part of the record. Outputs are mapped from inputs; method is huber or ls. Errors are those of leaving out a slice, with the weights of the whole; with fewer than MIN_SLICES there are none. A band of fewer than MIN_SAMPLES samples has nulls, as has a singular one.
    """
    if method not in ("huber", "ls"):
        raise ValueError(f"no method {method}")
    for a, b, what in ((reference, inputs, "inputs"), (reference, outputs, "outputs"), (outputs, inputs, "inputs as outputs")):
        if set(a) & set(b):
            raise ValueError(f"the reference shares channels with the {what}" if a is reference else "outputs are inputs")
    own = dict(zip(("_x0", "_x1", "_q0", "_q1"), (*inputs, *reference), strict=True))
    channels = [F.col(f"{c}_{p}").alias(f"{n}_{p}") for n, c in own.items() for p in ("re", "im")]
    slim = rows.select(*keys, "h", "f", "slice", *channels, *(F.col(f"{c}_{p}").alias(f"_o{i}_{p}") for i, c in enumerate(outputs) for p in ("re", "im")))
    inputs, reference = ("_x0", "_x1"), ("_q0", "_q1")
    long = stash(outputs_long(slim, {"x": "_o0", "y": "_o1"}).drop("_o0_re", "_o0_im", "_o1_re", "_o1_im"), "long")
    by = [*keys, "output"]
    b = solved(long, by, "y", inputs, reference, rounds=rounds if method == "huber" else 0)
    w = long.join(small(b).select(*by, *(c for c in b.columns if c.startswith("w_")), "scale"), by)
    weight = F.coalesce(weight_of(residual("y", inputs, "w_"), F.col("scale"), THRESHOLD), F.lit(1.0))
    w = w.withColumn("_w", weight)
    one = F.lit(1.0)
    x0, x1 = inputs
    parts = normal_sums("y", inputs, reference, F.col("_w")) | _powers({"y": "y"}, reference, F.col("_w"), "w_")
    parts |= {f"p_{k}": v for k, v in normal_sums("y", inputs, reference, one).items()} | _powers({"y": "y", "x0": x0, "x1": x1}, reference, one, "p_")
    parts |= {"n": F.count("*"), "down": F.sum((F.col("_w") < 1).cast("double"))}
    sums = stash(w.groupBy(*by, "slice").agg(*(v.alias(k) for k, v in parts.items())), "sums")
    whole = sums.groupBy(*by).agg(*(F.sum(k).alias(k) for k in parts))

    # The whole, an output a row, then both beside each other.
    z = solution()
    plain = lambda tag, c, power: multiple_coherence(_c(f"{tag}{c}_0"), _c(f"{tag}{c}_1"), _c(("w_" if not tag else tag) + "s"), F.col(("w_" if not tag else tag) + "r0"), F.col(("w_" if not tag else tag) + "r1"), F.col(power))
    facts = {"b1_re": z[0][0], "b1_im": z[0][1], "b2_re": z[1][0], "b2_im": z[1][1], "coh_out": plain("p_", "c", "p_y"), "coh_in_x": plain("p_", "m1", "p_x0"), "coh_in_y": plain("p_", "m2", "p_x1"), "coh_weighted": plain("", "c", "w_y"), "down": F.col("down") / F.col("n")}
    each = whole.select(*by, "n", *(v.alias(k) for k, v in facts.items()))

    def of(output: str, name: str) -> Column:
        return F.max(F.when(F.col("output") == output, F.col(name)))

    named = {f"t_{e}_{p}": (o, f"b{j}_{p}") for o in "xy" for j, e in ((1, f"{o}x"), (2, f"{o}y")) for p in ("re", "im")}
    wide = each.groupBy(*keys).agg(F.max("n").alias("n"), *(of(*v).alias(k) for k, v in named.items()), *(of(o, c).alias(f"{c}_{o}") for c in ("coh_out", "coh_weighted", "down") for o in "xy"), of("x", "coh_in_x").alias("coh_in_x"), of("x", "coh_in_y").alias("coh_in_y"))
    det = cx.sub(cx.mul(_c("t_xx"), _c("t_yy")), cx.mul(_c("t_xy"), _c("t_yx")))
    wide = wide.withColumn("det_re", det[0]).withColumn("det_im", det[1])

    # Each slice left out.
    names = [k for k in parts if k.startswith(("m1_", "m2_", "c_"))]
    less = sums.join(whole.select(*by, *(F.col(k).alias(f"t_{k}") for k in [*names, "n"])), by).where(F.col("t_n") - F.col("n") >= MIN_LEFT)
    d = solution(lambda k: F.col(f"t_{k}") - F.col(k))
    less = less.select(*by, "slice", d[0][0].alias("b1_re"), d[0][1].alias("b1_im"), d[1][0].alias("b2_re"), d[1][1].alias("b2_im"))
    less = less.groupBy(*keys, "slice").agg(*(of(*v).alias(k) for k, v in named.items())).dropna(subset=list(named))
    less = less.withColumn("_re", det[0]).withColumn("_im", det[1]).join(wide.select(*keys, "det_re", "det_im"), keys)
    turn = cx.div(_c(""), _c("det"))
    less = less.withColumn("abs", F.sqrt(cx.power(_c("")))).withColumn("turn", F.degrees(F.atan2(turn[1], turn[0])) / 2)
    mine = Window.partitionBy(*keys)  # a row for each slice
    values = [*named, "abs", "turn"]
    less = less.select(*keys, *((F.col(c) - F.avg(c).over(mine)).alias(c) for c in values))
    g = F.count("*")
    spread = {f"{e}_err": F.sum(cx.power(_c(f"t_{e}"))) for e in ELEMENTS} | {"abs_det_err": F.sum(F.col("abs") ** 2), "half_arg_err": F.sum(F.col("turn") ** 2)}
    errors = less.groupBy(*keys).agg(g.alias("n_groups"), *(F.when(g >= MIN_SLICES, F.sqrt((g - 1) / g * v)).alias(k if k.endswith(("det_err", "arg_err")) else f"t_{k}") for k, v in spread.items()))

    # Each harmonic's weight in the solution.
    m = cx.sub(cx.mul(_c("m1_0"), _c("m2_1")), cx.mul(_c("m2_0"), _c("m1_1")))
    heavy = {k: v for k, v in normal_sums("y", inputs, reference, F.col("_w")).items() if k.startswith("m")}
    c = w.groupBy(*by, "h").agg(F.first("f").alias("f"), *(v.alias(k) for k, v in heavy.items())).withColumn("_c", F.sqrt(F.sqrt(cx.power(m))))
    f = c.groupBy(*by).agg(F.when(F.sum("_c") > 0, F.sum(F.col("f") * F.col("_c")) / F.sum("_c")).otherwise(F.avg("f")).alias("f")).groupBy(*keys).agg(F.avg("f").alias("f_weighted"))

    out = wide.join(errors, keys, "left").join(f, keys)
    enough = F.col("n") >= MIN_SAMPLES
    half = F.degrees(F.atan2("det_im", "det_re")) / 2
    kept = [c for c in out.columns if c not in (*keys, "n", "n_groups")]
    out = out.withColumn("half_arg", half)
    return out.select(*keys, "n", F.when(enough, F.coalesce("n_groups", F.lit(0))).otherwise(0).alias("n_groups"), *(F.when(enough, F.col(c)).alias(c) for c in [*kept, "half_arg"]))


def flags(tensors: DataFrame) -> DataFrame:
    """tensors with not_estimated, few_groups, low_coherence, off_diagonal, re_det_negative; the last four only where there is an estimate."""
    estimated = F.lit(True)
    for e in ELEMENTS:
        for p in ("re", "im"):
            v = F.col(f"t_{e}_{p}")
            estimated &= v.isNotNull() & ~F.isnan(v)
    off = cx.power(cx.mul(_c("t_xy"), _c("t_yx"))) > cx.power(cx.mul(_c("t_xx"), _c("t_yy")))
    marks = {"few_groups": F.col("n_groups") < FEW_SLICES, "low_coherence": (F.col("coh_weighted_x") < LOW_COHERENCE) | (F.col("coh_weighted_y") < LOW_COHERENCE), "off_diagonal": off, "re_det_negative": F.col("det_re") < 0}
    return tensors.select("*", (~estimated).alias("not_estimated"), *((estimated & F.coalesce(v, F.lit(False))).alias(k) for k, v in marks.items()))


def from_identity(tensors: DataFrame) -> Column:
    """Largest modulus among the elements less the identity."""
    return F.greatest(*(F.sqrt((F.col(f"t_{e}_re") - (1 if e in ("xx", "yy") else 0)) ** 2 + F.col(f"t_{e}_im") ** 2) for e in ELEMENTS))


TIE, LEAST, CLOCK = 0.02, 0.97, 1.0


def delay_scan(bands: DataFrame, keys: list[str], f: str = "f", phase: str = "phase", sd: str = "sd", cycle: float = 180.0, tolerance: float = CLOCK, tie: float = TIE, least: float = LEAST) -> DataFrame:
    """keys, n, tau, resultant, expected, alias, half_width, reason, delay, delay_err, intercept, intercept_err, chi2, rms: the delay that puts phases (degrees, known modulo cycle, with errors sd) on a line over frequency, phase = intercept - 360 f delay.

    Delays are tried in steps that turn the highest frequency by a degree, to `tolerance` or half the delay at which the bands' own pattern returns. A delay's score is the weighted resultant of the phases turned back by it; of peaks within `tie` of the highest the nearest to zero is taken, each phase is put on its branch about that line, and the line is fitted with errors scaled by the root of chi2, 1 at least. reason says why there is none: few bands, bound, no line, errors. A key's bands are few and lie in an array; all its delays are tried at once in the batch (`_scanned`), no row for each.
    """
    good = bands.where(F.col(f).isNotNull() & F.col(phase).isNotNull() & ~F.isnan(phase) & (F.col(sd) > 0) & (F.col(sd) < float("inf")))
    band = F.struct(F.col(f).cast("double").alias("f"), F.col(phase).cast("double").alias("p"), F.col(sd).cast("double").alias("s"))
    held = good.groupBy(*keys).agg(F.sort_array(F.collect_list(band)).alias("_b"), F.max(f).alias("_top"), F.sum(1 / F.col(sd) ** 2).alias("_w"), F.count("*").alias("n"))
    k = 2 * math.pi / cycle
    held = stash(held.withColumn("_step", 1 / (360 * F.col("_top"))).withColumn("expected", _over(lambda b: F.exp(-0.5 * (k * b["s"]) ** 2) / b["s"] ** 2) / F.col("_w")), "bands")

    best = _scanned(held.where("n >= 3"), keys, k, tolerance, tie)
    out = held.drop("_step").join(best, keys, "left").withColumn("tau", F.col("_i") * F.col("_step"))
    reason = F.when(F.col("n") < 3, "few bands").when(F.abs("_i") == F.col("_m"), "bound").when(F.col("_r") < least, "no line").when(F.col("expected") < least, "errors")
    model = lambda b: F.atan2("_im", "_re") / k - 360 * b["f"] * F.col("tau")
    placed = F.transform("_b", lambda b: F.struct(b["f"].alias("f"), (b["p"] + cycle * F.rint((model(b) - b["p"]) / cycle)).alias("p"), b["s"].alias("s")))
    out = out.withColumn("reason", reason).withColumn("_b", F.when(F.col("reason").isNull(), placed))
    w = lambda b: 1 / b["s"] ** 2
    out = out.withColumn("_mf", _over(lambda b: w(b) * b["f"]) / F.col("_w")).withColumn("_mp", _over(lambda b: w(b) * b["p"]) / F.col("_w"))
    out = out.withColumn("_xx", _over(lambda b: w(b) * (b["f"] - F.col("_mf")) ** 2)).withColumn("_slope", _over(lambda b: w(b) * (b["f"] - F.col("_mf")) * (b["p"] - F.col("_mp"))) / F.col("_xx"))
    out = out.withColumn("_a", F.col("_mp") - F.col("_slope") * F.col("_mf")).withColumn("_chi", _over(lambda b: w(b) * (b["p"] - F.col("_a") - F.col("_slope") * b["f"]) ** 2))
    chi2 = F.when(F.col("n") > 2, F.col("_chi") / (F.col("n") - 2))
    scale = F.sqrt(F.greatest(F.lit(1.0), F.coalesce(chi2, F.lit(1.0))))
    return out.select(*keys, "n", "tau", F.col("_r").alias("resultant"), "expected", "alias", (F.col("_m") * F.col("_step")).alias("half_width"), "reason", (-F.col("_slope") / 360).alias("delay"), (scale / F.sqrt("_xx") / 360).alias("delay_err"), (F.col("_a") - cycle * F.ceil(F.col("_a") / cycle - 0.5)).alias("intercept"), (scale * F.sqrt(1 / F.col("_w") + F.col("_mf") ** 2 / F.col("_xx"))).alias("intercept_err"), chi2.alias("chi2"), F.sqrt(F.col("_chi") / F.col("_w")).alias("rms"))


def _scanned(held: DataFrame, keys: list[str], k: float, tolerance: float, tie: float) -> DataFrame:
    """keys, alias, _m, _i, _step, _r, _re, _im: the step nearest to zero among the peaks within `tie` of the highest, of held(keys, _b, _w, _step)."""
    names = ["alias", "_m", "_i", "_step", "_r", "_re", "_im"]
    types = StructType([*held.select(*keys).schema.fields, *(StructField(c, LongType() if c in ("_m", "_i") else DoubleType()) for c in names)])

    def resultant(i: np.ndarray, step: float, w: float, f, p, s) -> tuple[np.ndarray, np.ndarray]:
        re, im = np.zeros(len(i)), np.zeros(len(i))
        for a in range(0, len(i), 1 << 14):
            tau = i[a : a + (1 << 14)] * step
            for fj, pj, sj in zip(f, p, s, strict=True):
                angle = k * (pj + 360 * fj * tau)
                re[a : a + len(tau)] += np.cos(angle) / sj**2
                im[a : a + len(tau)] += np.sin(angle) / sj**2
        return re / w, im / w

    def steps(width: float, step: float) -> int:
        x = width / step
        return int(np.ceil(x)) if x == x else 0

    def whole(n: int, low: int = 0) -> np.ndarray:
        return np.arange(min(low, n), max(low, n) + 1)

    def tried(w: float, step: float, f, p, s) -> tuple:
        i = whole(steps(tolerance, step))
        re, im = resultant(i, step, w, f, np.zeros(len(f)), s)
        r = _largest(np.sqrt(re * re + im * im))
        left = np.maximum.accumulate(r < 1 - tie)
        back = np.maximum.accumulate(left & (r >= 1 - tie))
        at = i[back & ~np.append(r[1:] > r[:-1], False)] * step
        alias = float(at.min()) if len(at) else None
        m = steps(min(tolerance, alias / 2) if alias is not None else tolerance, step)
        i = whole(m, -m)
        re, im = resultant(i, step, w, f, p, s)
        r = np.sqrt(re**2 + im**2)
        v = _largest(r)
        peak = np.append(True, v[1:] >= v[:-1]) & np.append(v[:-1] >= v[1:], True)
        near = np.flatnonzero(peak & (v >= (1 - tie) * v[peak].max()))
        j = near[np.lexsort((i[near], np.abs(i[near])))[0]]
        return alias, m, int(i[j]), step, float(r[j]), float(re[j]), float(im[j])

    def run(batches):
        with np.errstate(invalid="ignore"):
            for batch in batches:
                f, p, s = (batch.column(c).to_pylist() for c in "fps")
                out = [tried(w, step, *map(np.array, x)) for w, step, *x in zip(batch.column("_w").to_pylist(), batch.column("_step").to_pylist(), f, p, s, strict=True)]
                columns = zip(*out, strict=True) if out else [[]] * len(names)
                made = [pa.array(c, pa.int64() if n in ("_m", "_i") else pa.float64()) for n, c in zip(names, columns, strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keys), *made], [*keys, *names])

    flat = held.select(*keys, "_w", "_step", *(F.col("_b").getField(c).alias(c) for c in "fps"))
    parts = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # the rows are few and dear: left to size, one task would take them
    return flat.repartition(parts, *keys).mapInArrow(run, types)


def _largest(r: np.ndarray) -> np.ndarray:
    """r with what is not a number as the largest, as Spark orders it."""
    return np.where(np.isnan(r), np.inf, r)


def _over(term) -> Column:
    """Sum of a term over the bands of the array _b."""
    return F.aggregate("_b", F.lit(0.0), lambda a, b: a + term(b))
