"""Whether both electric lines of a site share the voltage of their centre electrode: what is left of the lines after the fields, by day, and the site's verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrawave.functions.cx import Complex, add, conj, mul, power

CHANNELS = ["hx", "hy", "ex", "ey"]
PAIRS = [("hx", "hy"), ("hx", "ex"), ("hx", "ey"), ("hy", "ex"), ("hy", "ey"), ("ex", "ey")]
MODEL_COHERENCE, MODEL_GAIN, CONTROL = 0.9, (0.85, 1.18), 0.35
VALUES = ("src", "coh_r", "gain", "re_g", "im_g", "mcoh_diff", "mcoh_sum")


def _csd(a: str, b: str) -> Complex:
    if a == b:
        return F.col(f"psd_{a}"), F.lit(0.0)
    if (a, b) in PAIRS:
        return F.col(f"csd_{a}_{b}_re"), F.col(f"csd_{a}_{b}_im")
    return conj(_csd(b, a))


def _explained(a: str, b: str) -> Complex:
    """What the two fields give of the cross spectrum of two lines; null where the fields are one."""
    det = F.col("psd_hx") * F.col("psd_hy") - power(_csd("hx", "hy"))
    det = F.when(det > 1e-12 * F.col("psd_hx") * F.col("psd_hy"), det)
    cross = {(i, j): mul(conj(_csd(i, a)), _csd(j, b)) for i in ("hx", "hy") for j in ("hx", "hy")}
    own = tuple(F.col("psd_hy") * x + F.col("psd_hx") * y for x, y in zip(cross["hx", "hx"], cross["hy", "hy"], strict=True))
    mixed = add(mul(_csd("hx", "hy"), cross["hx", "hy"]), mul(_csd("hy", "hx"), cross["hy", "hx"]))
    return (own[0] - mixed[0]) / det, (own[1] - mixed[1]) / det


def residuals(spectra: DataFrame, keys: list[str], shortest: float, longest: float) -> DataFrame:
    """keys, period, src, coh_r, g_re, g_im, mcoh_diff, mcoh_sum by harmonic, of densities psd_<channel> and csd_<a>_<b>_re, _im (of conj(a) b) by frequency f: coherence of the lines, of what the fields leave of them, its gain from ex to ey, and multiple coherences of ex - ey and ex + ey with the fields."""
    rows = spectra.where((F.col("f") > 0) & (1 / F.col("f") >= shortest) & (1 / F.col("f") <= longest))
    none = F.lit(0.0)
    parts = {}
    for a, b in (("ex", "ex"), ("ey", "ey"), ("ex", "ey")):
        parts[f"e_{a}{b}_re"], parts[f"e_{a}{b}_im"] = _explained(a, b)
    at = rows.select(*keys, (1 / F.col("f")).alias("period"), *(F.col(f"psd_{c}") for c in ("ex", "ey")), *(F.col(f"csd_ex_ey_{p}") for p in ("re", "im")), *(v.alias(n) for n, v in parts.items()))
    rxx, ryy = F.col("psd_ex") - F.col("e_exex_re"), F.col("psd_ey") - F.col("e_eyey_re")
    rxy = F.col("csd_ex_ey_re") - F.col("e_exey_re"), F.col("csd_ex_ey_im") - F.col("e_exey_im")

    def multiple(sign: int) -> Column:
        whole = F.col("psd_ex") + F.col("psd_ey") + 2 * sign * F.col("csd_ex_ey_re")
        return (F.col("e_exex_re") + F.col("e_eyey_re") + 2 * sign * F.col("e_exey_re")) / F.nullif(whole, none)

    lines = power((F.col("csd_ex_ey_re"), F.col("csd_ex_ey_im"))) / F.nullif(F.col("psd_ex") * F.col("psd_ey"), none)
    return at.select(*keys, "period", lines.alias("src"), (power(rxy) / F.nullif(rxx * ryy, none)).alias("coh_r"), (rxy[0] / F.nullif(rxx, none)).alias("g_re"), (-rxy[1] / F.nullif(rxx, none)).alias("g_im"), multiple(-1).alias("mcoh_diff"), multiple(1).alias("mcoh_sum"))


def octaves(shortest: float, longest: float) -> list[float]:
    """Edges of the octaves from the shortest period on; the last is what is left up to the longest."""
    edges = [shortest]
    while edges[-1] * 2 < longest * (1 - 1e-9):
        edges.append(edges[-1] * 2)
    return [*edges, longest]


def _median(c: str | Column) -> Column:
    return F.percentile(c, F.lit(0.5))


def octave_medians(stats: DataFrame, keys: list[str], shortest: float, longest: float) -> DataFrame:
    """keys, octave, n_bins and the medians of the observables over an octave's harmonics; gain is that of the gain's size."""
    octave = sum((F.col("period") >= e).cast("int") for e in octaves(shortest, longest)[1:-1]) if len(octaves(shortest, longest)) > 2 else F.lit(0)
    rows = stats.withColumn("octave", octave).withColumn("gain", F.sqrt(power((F.col("g_re"), F.col("g_im")))))
    of = {"re_g": "g_re", "im_g": "g_im"}
    return rows.groupBy(*keys, "octave").agg(F.count("*").alias("n_bins"), *(_median(of.get(v, v)).alias(v) for v in VALUES))


def _model() -> Column:
    return F.coalesce((F.col("coh_r") >= MODEL_COHERENCE) & F.col("gain").between(*MODEL_GAIN), F.lit(False))


def day_values(bands: DataFrame, keys: list[str]) -> DataFrame:
    """keys, the medians over the octaves, arg_g, s (the gain's sign) and model. Days on which the fields are one have no values and are left out."""
    days = bands.groupBy(*keys).agg(*(_median(v).alias(v) for v in VALUES)).dropna(subset=["coh_r", "re_g"])
    return days.select(*keys, *VALUES, F.degrees(F.atan2("im_g", "re_g")).alias("arg_g"), F.when(F.col("re_g") >= 0, 1).otherwise(-1).alias("s"), _model().alias("model"))


def site_verdict(days: DataFrame, keys: list[str], day: str, most: int = 5) -> DataFrame:
    """A site's values over its `most` days of highest coherence of the lines (ties: the earlier day), how many days there are and hold the model, and the verdict: holds, control (the lines agree on no such day) or fails.

    clean_obs is the combination that the gain's sign leaves clean, clean_by_h the one that follows the fields better; the remedy applies where the model holds and both are one.
    """
    w = Window.partitionBy(*keys).orderBy(F.desc("src"), day)  # a row for each day
    ranked = days.withColumn("_n", F.row_number().over(w))
    chosen = F.col("_n") <= most
    picked = ranked.groupBy(*keys).agg(F.count("*").alias("days_usable"), F.sum(chosen.cast("int")).alias("days_used"), F.sum(F.col("model").cast("int")).alias("days_model"), *(_median(F.when(chosen, F.col(v))).alias(v) for v in VALUES), F.max(F.when(chosen, F.col("src"))).alias("src_max"), F.sum(F.when(chosen, F.col("s"))).alias("_s"))
    at = picked.withColumn("model_holds", _model()).withColumn("control", F.col("src_max") < CONTROL).withColumn("s_obs", F.when(F.col("_s") < 0, -1).otherwise(1))
    at = at.withColumn("clean_obs", F.when(F.col("s_obs") > 0, "diff").otherwise("sum")).withColumn("clean_by_h", F.when(F.col("mcoh_diff") > F.col("mcoh_sum"), "diff").otherwise("sum"))
    verdict = F.when(F.col("model_holds"), "holds").when(F.col("control"), "control").otherwise("fails")
    return at.withColumn("arg_g", F.degrees(F.atan2("im_g", "re_g"))).withColumn("remedy", F.col("model_holds") & (F.col("clean_obs") == F.col("clean_by_h"))).withColumn("verdict", verdict).drop("_s")
