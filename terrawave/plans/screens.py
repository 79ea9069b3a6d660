"""Queries of bursts, hours of coherence and their masks, polarity, membership, equations, cycles and exact quantiles."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from terrawave.operators import order, screens
from terrawave.operators.blocks import ends
from terrawave.plans.arrays import _SPECTRA, _member_spectra
from terrawave.plans.base import PRODUCTS, SPANS, products, q6, r6, spans, sql
from terrawave.plans.catalog import query
from terrawave.plans.cleaning import DENSE, LONG_DENSE, dense, long_dense
from terrawave.plans.field import VECTORS
from terrawave.plans.welch import _GAPPY, _gappy

_WIDTH, _FACTOR, _AROUND = 8, 1.4, 6
_HALF = _WIDTH // 2
_BURSTS = (
    DENSE,
    _GAPPY,
    "gl AS (SELECT site, min(k) AS lo, max(k) + 1 AS hi FROM gappy GROUP BY 1)",
    "gg AS (SELECT site, lo, hi, unnest(range(lo, hi)) AS k FROM gl)",
    "st AS (SELECT g.site, g.k, g.k - lo AS i, hi - lo AS n, coalesce(abs(a.ex - b.ex), 0) AS ex, coalesce(abs(a.ey - b.ey), 0) AS ey FROM gg g LEFT JOIN gappy a ON a.site = g.site AND a.k = g.k LEFT JOIN gappy b ON b.site = g.site AND b.k = g.k - 1)",
    "md AS (SELECT site, median(ex) FILTER (WHERE ex > 0) AS mx, median(ey) FILTER (WHERE ey > 0) AS my FROM st GROUP BY 1)",
    "dd AS (SELECT st.site, k, i, n, greatest(ex / coalesce(mx, 1), ey / coalesce(my, 1)) AS d FROM st JOIN md ON st.site = md.site)",
    f"lv AS (SELECT a.site, a.k, avg(b.d) AS level FROM (SELECT site, k, n AS m, i + unnest(range(-{_HALF}, {_WIDTH - _HALF})) AS j FROM dd) a JOIN dd b ON b.site = a.site AND b.i = CASE WHEN j < 0 THEN -1 - j WHEN j >= m THEN 2 * m - 1 - j ELSE j END GROUP BY 1, 2)",
)
_ISLANDS = "(SELECT site, min(k) AS a, max(k) + 1 AS b FROM (SELECT site, k, k - row_number() OVER (PARTITION BY site ORDER BY k) AS g FROM {}) GROUP BY site, g)"


@query("burst_levels", sql(*_BURSTS, f"SELECT site, CAST(k AS BIGINT) AS k, {q6('level', 'level')} FROM lv"))
def burst_levels(spark, sf_dir):
    """Steps of both electric lines over their medians, the larger one, as a moving mean."""
    return screens.burst_levels(_gappy(spark, sf_dir), ["site"], ["ex", "ey"], _WIDTH).select("site", "k", r6("level", "level"))


@query("burst_masks", sql(*_BURSTS, f"ov AS (SELECT site, k FROM (SELECT *, median(level) OVER (PARTITION BY site) AS m FROM lv) WHERE level > {_FACTOR} * m)", f"wd AS (SELECT DISTINCT o.site, x.k FROM (SELECT site, unnest(range(k - {_AROUND}, k + {_AROUND} + 1)) AS k FROM ov) x JOIN gl o ON o.site = x.site AND x.k >= lo AND x.k < hi)", f"SELECT site, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b, 'local' AS scope, 'gate' AS found_by FROM {_ISLANDS.format('wd')}"))
def burst_masks(spark, sf_dir):
    """Masks over the bursts of the electric lines, widened and merged."""
    levels = screens.burst_levels(_gappy(spark, sf_dir), ["site"], ["ex", "ey"], _WIDTH)
    found = screens.burst_spans(levels, ["site"], _FACTOR, _AROUND)
    return screens.all_band_masks(found, "bursts", "gate").select("site", "a", "b", "scope", "found_by")


_WIN, _STEP, _SEG = 128, 64, 32
_LO, _HI, _PER = 2.0, 32.0, 6
_N = max(1, round(math.log10(_HI / _LO) * _PER))
_TAPER = f"(0.5 - 0.5 * cos(2 * pi() * j / {_SEG}))"
_C = ("hx", "hy", "ex", "ey")


def _g(a: str, b: str) -> str:
    cross = f"(pow(avg({a}r * {b}r + {a}i * {b}i), 2) + pow(avg({a}r * {b}i - {a}i * {b}r), 2))"
    return f"{cross} / nullif(avg({a}r * {a}r + {a}i * {a}i) * avg({b}r * {b}r + {b}i * {b}i), 0) AS {a}_{b}"


_SERIES = (
    DENSE,
    _GAPPY,
    "gl AS (SELECT site, min(k) AS lo, max(k) + 1 AS hi FROM gappy GROUP BY 1)",
    f"wi AS (SELECT site, lo, unnest(range(0, (hi - lo - {_WIN}) // {_STEP} + 1)) AS w FROM gl WHERE hi - lo >= {_WIN})",
    f"wk AS MATERIALIZED (SELECT i.site, i.w, g.k - lo - w * {_STEP} AS p, hx, hy, ex, ey, count(*) OVER (PARTITION BY i.site, i.w) AS n FROM wi i JOIN gappy g ON g.site = i.site AND g.k >= lo + w * {_STEP} AND g.k < lo + w * {_STEP} + {_WIN})",
    f"sg AS (SELECT site, w, s, p - s * {_SEG // 2} AS j, hx, hy, ex, ey FROM wk, (SELECT unnest(range(0, {(_WIN - _SEG) // (_SEG // 2) + 1})) AS s) WHERE n = {_WIN} AND p >= s * {_SEG // 2} AND p < s * {_SEG // 2} + {_SEG})",
    f"tp AS MATERIALIZED (SELECT site, w, s, j, {', '.join(f'({c} - avg({c}) OVER (PARTITION BY site, w, s)) * {_TAPER} AS {c}' for c in _C)} FROM sg)",
    "ft AS (SELECT site, w, s, h, " + ", ".join(f"sum({c} * cos(2 * pi() * h * j / {_SEG})) AS {c}r, -sum({c} * sin(2 * pi() * h * j / {_SEG})) AS {c}i" for c in _C) + f" FROM tp, (SELECT unnest(range(1, {_SEG // 2 + 1})) AS h) GROUP BY 1, 2, 3, 4)",
    "ch AS (SELECT site, w, h, " + ", ".join(_g(a, b) for a, b in screens.LINES) + " FROM ft GROUP BY 1, 2, 3)",
    f"cb AS (SELECT site, w, CAST(floor(ln({_SEG}.0 / h / {_LO}) / ln({_HI} / {_LO}) * {_N}) AS INTEGER) AS i, " + ", ".join(f"avg({a}_{b}) AS {a}_{b}" for a, b in screens.LINES) + f" FROM ch WHERE {_SEG}.0 / h >= {_LO} AND {_SEG}.0 / h < {_HI} GROUP BY 1, 2, 3)",
    "cm AS MATERIALIZED (SELECT site, w, " + ", ".join(f"avg({a}_{b}) AS {a}_{b}" for a, b in screens.LINES) + " FROM cb GROUP BY 1, 2)",
    "sw AS (SELECT site, avg(CAST(hx_ex > 0.5 AS INTEGER)) > avg(CAST(hx_ey > 0.5 AS INTEGER)) + 0.15 AND avg(CAST(hy_ey > 0.5 AS INTEGER)) > avg(CAST(hy_ex > 0.5 AS INTEGER)) + 0.15 AS swapped FROM cm GROUP BY 1)",
    "ls AS (SELECT cm.site, w, CASE WHEN swapped THEN hx_ex ELSE hy_ex END AS xy, CASE WHEN swapped THEN hy_ey ELSE hx_ey END AS yx, swapped FROM cm JOIN sw ON cm.site = sw.site)",
)


def _series(spark, sf_dir):
    return screens.line_series(_gappy(spark, sf_dir), ["site"], 1.0, _WIN, _STEP, _SEG, _LO, _HI, _PER)


@query("line_coherence", sql(*_SERIES, f"SELECT site, CAST(w AS BIGINT) AS w, {q6('xy', 'xy')}, {q6('yx', 'yx')}, swapped FROM ls"))
def line_coherence(spark, sf_dir):
    """Coherence of both lines with their partners in windows that lack no sample."""
    return _series(spark, sf_dir).select("site", "w", r6("xy", "xy"), r6("yx", "yx"), "swapped")


_MODES = (("xy", "ex", 0.5, 64), ("yx", "ey", 0.4, 128))


def _stretch_sql(mode: str, channel: str, threshold: float, grain: int) -> tuple[str, str]:
    slots = f"k{mode} AS (SELECT site, slot FROM (SELECT site, {mode} > {threshold} AS good, w * {_STEP} // {grain} + unnest(range(0, {_WIN // grain})) AS slot FROM ls WHERE w * {_STEP} % {grain} = 0) GROUP BY 1, 2 HAVING bool_or(good))"
    rest = f"r{mode} AS (SELECT g.site, g.k FROM (SELECT site, lo, unnest(range(lo, hi)) AS k FROM gl) g LEFT JOIN k{mode} s ON s.site = g.site AND s.slot = (g.k - lo) // {grain} WHERE s.slot IS NULL)"
    return f"{slots},\n{rest}", f"SELECT site, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b, '{channel}' AS channel, 1000.0::DOUBLE AS pmax FROM {_ISLANDS.format('r' + mode)}"


@query("stretch_masks", sql(*_SERIES, *(_stretch_sql(*m)[0] for m in _MODES), " UNION ALL ".join(_stretch_sql(*m)[1] for m in _MODES)))
def stretch_masks(spark, sf_dir):
    """Masks of each line on what its coherent slots leave of the record."""
    rows = _gappy(spark, sf_dir)
    series = _series(spark, sf_dir)
    records = ends(rows, ["site"])
    parts = [screens.stretch_masks(screens.kept_slots(series, ["site"], mode, t, _WIN, _STEP, grain), ["site"], records, grain, channel, 1000.0) for mode, channel, t, grain in _MODES]
    return parts[0].unionByName(parts[1]).select("site", "a", "b", "channel", "pmax")


_POLAR = (
    VECTORS,
    _SPECTRA,
    "fx AS (SELECT band, member, w, h, CASE WHEN member % 3 = 0 THEN -re ELSE re END AS re, CASE WHEN member % 3 = 0 THEN -im ELSE im END AS im FROM sx)",
    "pw AS (SELECT band, member, w, avg(re * re + im * im) AS p FROM fx GROUP BY 1, 2, 3)",
    "md AS (SELECT band, member, median(p) AS m FROM pw GROUP BY 1, 2 HAVING median(p) > 0)",
    "nw AS (SELECT p.band, p.member, p.w, sqrt(m) AS scale, p / m AS power FROM pw p JOIN md ON p.band = md.band AND p.member = md.member)",
    "kp AS (SELECT * FROM (SELECT *, median(power) OVER (PARTITION BY band, w) AS level FROM nw) WHERE power <= 25 * level)",
    "sc AS (SELECT s.band, s.member, s.w, s.h, re / scale AS re, im / scale AS im FROM fx s JOIN kp ON s.band = kp.band AND s.member = kp.member AND s.w = kp.w)",
    "ot AS (SELECT *, count(*) OVER q AS n, sum(re) OVER q - re AS ro, sum(im) OVER q - im AS io FROM sc WINDOW q AS (PARTITION BY band, w, h))",
    "po AS (SELECT band, member, sum((re * ro + im * io) / (n - 1)) / sqrt(sum(re * re + im * im) * sum((ro * ro + io * io) / ((n - 1) * (n - 1)))) AS correlation FROM ot WHERE n > 1 GROUP BY 1, 2)",
)


def _polar(spark, sf_dir):
    sign = F.when(F.col("member") % 3 == 0, -1.0).otherwise(1.0)
    return screens.polarity(_member_spectra(spark, sf_dir).withColumn("re", sign * F.col("re")).withColumn("im", sign * F.col("im")), ["band"])


@query("polarity_bands", sql(*_POLAR, f"SELECT CAST(band AS BIGINT) AS band, CAST(member AS BIGINT) AS member, {q6('correlation', 'correlation')} FROM po"))
def polarity_bands(spark, sf_dir):
    """Correlation of each member with the mean of the others, by band."""
    return _polar(spark, sf_dir).select(F.col("band").cast("long").alias("band"), F.col("member").cast("long").alias("member"), r6("correlation", "correlation"))


@query("polarity_flags", sql(*_POLAR, "me AS (SELECT DISTINCT member FROM fx)", "su AS (SELECT member, median(correlation) AS c, count(*) AS n FROM po WHERE band + 1 BETWEEN 1 AND 2 GROUP BY 1)", f"SELECT CAST(me.member AS BIGINT) AS member, {q6('c', 'correlation')}, coalesce(n, 0) AS bands, coalesce(c < 0, FALSE) AS flagged FROM me LEFT JOIN su ON me.member = su.member"))
def polarity_flags(spark, sf_dir):
    """Members whose median correlation over the bands is negative."""
    out = screens.polarity_summary(_polar(spark, sf_dir).withColumn("period", F.col("band") + 1.0), _member_spectra(spark, sf_dir), ["member"], 1.0, 2.0)
    return out.select(F.col("member").cast("long").alias("member"), r6("correlation", "correlation"), "bands", "flagged")


@query("membership_changes", sql(SPANS, "u AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY site ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 5 THEN 0 ELSE 1 END AS new FROM spans)", "v AS (SELECT *, sum(new) OVER (PARTITION BY site ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM u)", "m AS (SELECT site, min(a) AS a, max(b) AS b FROM v GROUP BY site, g)", "c AS (SELECT site, 'starts' AS change, a AS k FROM m UNION ALL SELECT site, 'ends', b FROM m)", "SELECT site, change, CAST(k AS BIGINT) AS k FROM c WHERE k > 8900 + 5 AND k < 9900 - 5"))
def membership_changes(spark, sf_dir):
    """Where members' records start or end inside a window."""
    s = spans(spark, sf_dir)
    windows = s.select("site").distinct().select("site", F.lit(8900).cast("long").alias("lo"), F.lit(9900).cast("long").alias("hi"))
    return screens.membership_changes(s, ["site"], windows, 5).withColumnRenamed("at", "k")


_CELL = f"{-math.log1p(-0.1)!r}"
_LAID = (
    PRODUCTS,
    "pp AS (SELECT product, CAST(substr(product, 2) AS BIGINT) AS p, period AS q, pow(1.25::DOUBLE, CAST(period AS BIGINT) % 12) * (1 + CAST(substr(product, 2) AS BIGINT) * 1e-11::DOUBLE) * CASE WHEN product = 'P7' AND period > 25 THEN 1.03::DOUBLE ELSE 1 END AS period, degrees(atan2(zxy_im, zxy_re)) AS psi, zxy_err AS err FROM products)",
    f"ce AS (SELECT CAST(floor(ln(period) / {_CELL}) AS BIGINT) AS cell, min(period) AS first, max(period) AS last FROM pp GROUP BY 1)",
    "la AS (SELECT *, lag(first) OVER (ORDER BY cell) AS pre FROM ce)",
    "ly AS (SELECT cell, first, last, CASE WHEN (first - pre) / first <= 1e-9 THEN pre ELSE first END AS point, pre FROM la)",
)


def _laid(spark, sf_dir):
    p = F.expr("cast(substr(product, 2) as bigint)")
    moved = F.when((F.col("product") == "P7") & (F.col("period") > 25), 1.03).otherwise(1.0)
    at = F.pow(F.lit(1.25), F.col("period").cast("long") % 12) * (1 + p * 1e-11) * moved
    return products(spark, sf_dir).select("product", p.alias("p"), F.col("period").alias("q"), at.alias("period"), F.degrees(F.atan2("zxy_im", "zxy_re")).alias("psi"), F.col("zxy_err").alias("err"))


@query("lattice_layout", sql(*_LAID, f"SELECT cell, {q6('point', 'point')}, (last - point) / last > 1e-9 OR coalesce((first - pre) / first > 1e-9 AND (first - pre) / first < 0.1 * (1 - 1e-12), FALSE) AS clash FROM ly"))
def lattice_layout(spark, sf_dir):
    """The lattice of all products' periods, and where two layouts clash."""
    return screens.layout(_laid(spark, sf_dir)).select("cell", r6("point", "point"), "clash")


@query("equations_entered", sql(*_LAID, "eq AS (SELECT product, q, CASE WHEN q % 9 = 0 THEN 'not_estimated' WHEN NOT err > 0.005 THEN 'no_error' WHEN p = 5 THEN 'use=false' WHEN psi > 40 THEN 'flag:steep' WHEN q > 45 THEN 'flag:long' ELSE '' END AS reason, point FROM pp LEFT JOIN ly ON ly.cell = CAST(floor(ln(pp.period) / " + _CELL + ") AS BIGINT))", f"SELECT product, q AS quantity, {q6('point', 'lattice_period')}, reason = '' AS entered, reason FROM eq"))
def equations_entered(spark, sf_dir):
    """Rows of all products as equations, with the first reason against each."""
    rows = _laid(spark, sf_dir)
    flagged = rows.withColumn("err", F.when(F.col("err") > 0.005, F.col("err"))).withColumn("missing", F.col("q") % 9 == 0).withColumn("used", F.col("p") != 5).withColumn("steep", F.col("psi") > 40).withColumn("long", F.col("q") > 45)
    out = screens.equations(flagged, screens.layout(rows), "psi", "err", "used", "missing", ["steep", "long"])
    return out.select("product", F.col("q").alias("quantity"), r6("lattice_period", "lattice_period"), "entered", "reason")


@query("cycle_periods", sql(DENSE, "ac AS (SELECT a.site, lag, sum(a.hx * b.hx) AS ac FROM (SELECT site, k, hx, unnest(range(68, 73)) AS lag FROM dense) a JOIN dense b ON b.site = a.site AND b.k = a.k + lag GROUP BY 1, 2)", "nb AS (SELECT *, lag(ac) OVER (PARTITION BY site ORDER BY lag) AS y0, lead(ac) OVER (PARTITION BY site ORDER BY lag) AS y2, row_number() OVER (PARTITION BY site ORDER BY ac DESC, lag) AS rn FROM ac)", f"SELECT site, {q6('(lag + coalesce(0.5 * (y0 - y2) / nullif(y0 - 2 * ac + y2, 0), 0)) / 10', 'period')} FROM nb WHERE rn = 1"))
def cycle_periods(spark, sf_dir):
    """The weekly cycle's period from the autocorrelation ten weeks out."""
    return screens.cycle_period(dense(spark, sf_dir), ["site"], "hx", 1.0, 7.0, 10).select("site", r6("period", "period"))


@query("exact_quantiles", sql(LONG_DENSE, f"SELECT site, channel, {q6('quantile_cont(x, 0.9)', 'upper')}, {q6('median(x)', 'middle')} FROM long_dense GROUP BY 1, 2"))
def exact_quantiles(spark, sf_dir):
    """Exact quantiles of each channel, without its values in one task."""
    rows = long_dense(spark, sf_dir)
    keys = ["site", "channel"]
    upper = order.percentile(rows, keys, "x", 0.9, "upper")
    return upper.join(order.percentile(rows, keys, "x", 0.5, "middle"), keys).select(*keys, r6("upper", "upper"), r6("middle", "middle"))
