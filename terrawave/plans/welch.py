"""Queries of Welch spectra: coherence in sliding windows, levels stitched on one grid, and the ladder over whole records."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from terrawave.operators import welch
from terrawave.plans.base import q6, r6, sql
from terrawave.plans.catalog import query
from terrawave.plans.cleaning import DENSE, dense

_WIN, _STEP, _SEG = 160, 64, 32
_GAPPY = "gappy AS (SELECT * FROM dense WHERE NOT (k % 200 >= 100 AND k % 200 < 130))"


def _gappy(spark, sf_dir):
    return dense(spark, sf_dir).where("not (k % 200 >= 100 and k % 200 < 130)")


def _spectra_sql(source: str, win: int, step: int, seg: int, channels=("hx", "ex"), tag: str = "") -> tuple[str, ...]:
    """Densities and cross densities by window and harmonic, of segments without a gap."""
    hop, n = seg // 2, len(welch.segment_starts(win, seg))
    taper = f"(0.5 - 0.5 * cos(2 * pi() * j / {seg}))"
    scale = f"(2.0 / (0.375 * {seg}))"
    half = f"CASE WHEN h = {seg // 2} THEN 0.5 ELSE 1 END"
    a, b = channels
    return (
        f"lo{tag} AS (SELECT site, min(k) AS lo, max(k) + 1 AS hi FROM {source} GROUP BY site)",
        f"wi{tag} AS (SELECT site, lo, unnest(range(0, (hi - lo - {win}) // {step} + 1)) AS w FROM lo{tag} WHERE hi - lo >= {win})",
        f"se{tag} AS (SELECT site, lo, w, unnest(range(0, {n})) AS s FROM wi{tag})",
        f"pl{tag} AS (SELECT e.site, e.w, e.s, g.k - e.lo - e.w * {step} - e.s * {hop} AS j, {a}, {b} FROM (SELECT *, unnest(range(0, {seg})) AS jj FROM se{tag}) e JOIN {source} g ON g.site = e.site AND g.k = e.lo + e.w * {step} + e.s * {hop} + e.jj)",
        f"ok{tag} AS (SELECT site, w, s, avg({a}) AS ma, avg({b}) AS mb FROM pl{tag} GROUP BY 1, 2, 3 HAVING count(*) = {seg})",
        f"ta{tag} AS (SELECT p.site, p.w, p.s, j, ({a} - ma) * {taper} AS a, ({b} - mb) * {taper} AS b FROM pl{tag} p JOIN ok{tag} o ON p.site = o.site AND p.w = o.w AND p.s = o.s)",
        f"ft{tag} AS (SELECT site, w, s, h, " + ", ".join(f"sum({c} * cos(2 * pi() * h * j / {seg})) AS {c}r, -sum({c} * sin(2 * pi() * h * j / {seg})) AS {c}i" for c in "ab") + f" FROM ta{tag}, (SELECT unnest(range(1, {seg // 2 + 1})) AS h) GROUP BY 1, 2, 3, 4)",
        f"sp{tag} AS (SELECT site, w, h, count(*) AS segments, {half} * {scale} * avg(ar * ar + ai * ai) AS paa, {half} * {scale} * avg(br * br + bi * bi) AS pbb, {half} * {scale} * avg(ar * br + ai * bi) AS cr, {half} * {scale} * avg(ar * bi - ai * br) AS ci FROM ft{tag} GROUP BY 1, 2, 3 HAVING count(*) >= {max(4, -(-n // 2))})",
    )


@query("welch_coherence", sql(DENSE, _GAPPY, *_spectra_sql("gappy", _WIN, _STEP, _SEG), f"SELECT site, CAST(w AS BIGINT) AS w, CAST(h AS INTEGER) AS h, CAST(segments AS INTEGER) AS segments, {q6(f'(w * {_STEP} + {_WIN / 2}::DOUBLE)', 't')}, {q6('log10(paa)', 'power')}, {q6('(cr * cr + ci * ci) / nullif(paa * pbb, 0)', 'coherence')} FROM sp"))
def welch_coherence(spark, sf_dir):
    """Coherence of a magnetic and an electric channel in sliding windows of a series with gaps."""
    s = welch.window_spectra(_gappy(spark, sf_dir), ["site"], ["hx", "ex"], [("hx", "ex")], 1.0, _WIN, _STEP, _SEG)
    f = welch.by_frequency(s, ["site"], ["psd_hx", "psd_ex", "csd_hx_ex_re", "csd_hx_ex_im"], 1.0, _SEG)
    return f.select("site", "w", "h", "segments", r6("t", "t"), r6(F.log10("psd_hx"), "power"), r6(welch.coherence("hx", "ex"), "coherence"))


_DOWN = (
    "tm AS (SELECT unnest(range(-40, 41)) AS m)",
    "tp AS (SELECT m, CASE WHEN m = 0 THEN 1 ELSE sin(pi() * m / 4.0) / (pi() * m / 4.0) END * (0.54 + 0.46 * cos(pi() * m / 40.0)) AS h FROM tm)",
    "taps AS (SELECT m, h / (SELECT sum(h) FROM tp) AS h FROM tp)",
    "down AS (SELECT o.site, o.k // 4 AS k, sum(p.hx * h) AS hx, sum(p.ex * h) AS ex FROM dense o CROSS JOIN taps JOIN dense p ON p.site = o.site AND p.k = o.k + m WHERE o.k % 4 = 0 GROUP BY 1, 2)",
)
_BINS = (4.0, 128.0, 6)


def _bin_sql(rate: float, seg: int, tag: str) -> str:
    lo, hi, per = _BINS
    n = max(1, round(math.log10(hi / lo) * per))
    return f"bi{tag} AS (SELECT site, w, i, avg(log10(paa)) AS v FROM (SELECT *, CASE WHEN {seg} / ({rate} * h) >= {lo} AND {seg} / ({rate} * h) < {hi} THEN CAST(floor(ln({seg} / ({rate} * h) / {lo}) / ln({hi} / {lo}) * {n}) AS INTEGER) END AS i FROM sp{tag}) WHERE i IS NOT NULL GROUP BY 1, 2, 3)"


@query("levels_stitched", sql(DENSE, *_DOWN, *_spectra_sql("dense", _WIN, _STEP, _SEG), *_spectra_sql("down", 96, 32, _SEG, tag="2"), _bin_sql(1.0, _SEG, ""), _bin_sql(0.25, _SEG, "2"), "ba AS (SELECT site, k - lo + 0.0::DOUBLE AS t FROM dense JOIN lo USING (site) WHERE (k - lo) % 50 = 0)", f"l1 AS (SELECT b.site, t, least(greatest(CAST(ceil(round((t - {_WIN / 2}) / {_STEP}, 9)) AS BIGINT), 0), m) AS w FROM ba b JOIN (SELECT site, max(w) AS m FROM bi GROUP BY 1) x ON b.site = x.site)", "l2 AS (SELECT b.site, t, least(greatest(CAST(ceil(round((t * 0.25 - 48) / 32, 9)) AS BIGINT), 0), m) AS w FROM ba b JOIN (SELECT site, max(w) AS m FROM bi2 GROUP BY 1) x ON b.site = x.site)", f"SELECT site, {q6('t', 't')}, level, i AS bin, {q6('v', 'power')} FROM (SELECT l1.site, t, 0 AS level, i, v FROM l1 JOIN bi ON l1.site = bi.site AND l1.w = bi.w UNION ALL SELECT l2.site, t, 1, i, v FROM l2 JOIN bi2 ON l2.site = bi2.site AND l2.w = bi2.w)"))
def levels_stitched(spark, sf_dir):
    """Power by bins of period of two levels, on one grid of times."""
    rows = dense(spark, sf_dir)
    levels = []
    for level, (x, win, step) in enumerate(zip(welch.levels_of(rows, ["site"], ["hx"], 4, 2), (_WIN, 96), (_STEP, 32), strict=True)):
        rate = 0.25**level
        f = welch.by_frequency(welch.window_spectra(x, ["site"], ["hx"], [], rate, win, step, _SEG), ["site"], ["psd_hx"], rate, _SEG)
        # Densities of the coarser level are for its own rate.
        f = f.withColumn("bin", welch.log_bin(F.col("f"), *_BINS)).where("bin is not null").groupBy("site", "w", "bin").agg(F.avg(F.log10(F.col("psd_hx") * rate)).alias("power"))
        levels.append((f.withColumn("period", F.struct(F.lit(level).alias("level"), "bin")), rate, win, step))
    base = rows.join(rows.groupBy("site").agg(F.min("k").alias("lo")), "site").where("(k - lo) % 50 = 0").select("site", (F.col("k") - F.col("lo")).cast("double").alias("t"))
    out = welch.stitched(levels, ["site"], "power", base)
    return out.select("site", r6("t", "t"), "period.level", "period.bin", r6("power", "power"))


def _record_sql(source: str, tag: str, seg: int, stage: int) -> tuple[str, ...]:
    hop = seg // 2
    taper = f"(0.5 - 0.5 * cos(2 * pi() * j / {seg}))"
    return (
        f"rl{tag} AS (SELECT site, min(k) AS lo, max(k) + 1 AS hi FROM {source} GROUP BY site HAVING max(k) + 1 - min(k) >= 4 * {seg})",
        f"rs{tag} AS (SELECT site, lo, unnest(range(0, (hi - lo - {seg}) // {hop} + 1)) AS s FROM rl{tag})",
        f"rp{tag} AS (SELECT e.site, e.s, e.j, coalesce(g.hx, 0) AS x FROM (SELECT *, unnest(range(0, {seg})) AS j FROM rs{tag}) e LEFT JOIN {source} g ON g.site = e.site AND g.k = e.lo + e.s * {hop} + e.j)",
        f"rm{tag} AS (SELECT site, s, avg(x) AS m FROM rp{tag} GROUP BY 1, 2)",
        f"rf{tag} AS (SELECT p.site, p.s, h, sum((x - m) * {taper} * cos(2 * pi() * h * j / {seg})) AS r, sum((x - m) * {taper} * sin(2 * pi() * h * j / {seg})) AS i FROM rp{tag} p JOIN rm{tag} m ON p.site = m.site AND p.s = m.s, (SELECT unnest(range(1, {seg // 2 + 1})) AS h) GROUP BY 1, 2, 3)",
        f"ro{tag} AS (SELECT site, {stage} AS stage, h, count(*) AS segments, CASE WHEN h = {seg // 2} THEN 0.5 ELSE 1 END * 2 / (0.375 * {seg} * {0.25**stage}) * avg(r * r + i * i) AS p FROM rf{tag} GROUP BY 1, 2, 3)",
    )


@query("psd_ladder", sql(DENSE, *_DOWN, *_record_sql("dense", "1", 64, 0), *_record_sql("down", "2", 64, 1), f"SELECT site, stage, CAST(h AS INTEGER) AS h, segments, {q6('log10(p)', 'power')} FROM (SELECT * FROM ro1 UNION ALL SELECT * FROM ro2)"))
def psd_ladder(spark, sf_dir):
    """Whole-record spectra at the native rate and at a quarter of it."""
    out = welch.psd_ladder(dense(spark, sf_dir), ["site"], ["hx"], 1.0, segment=64, factor=4, stages=2)
    return out.where("h > 0").select("site", "stage", "h", "segments", r6(F.log10("psd_hx"), "power"))
