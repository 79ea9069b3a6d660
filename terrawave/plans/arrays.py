"""Queries of stacks of members, line groups, clusters, calibration, alignment, time bases and resampling."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from terrawave.operators import grouping, lattice, mains, resample, stacks
from terrawave.plans.base import q6, r6, sql, table
from terrawave.plans.catalog import query
from terrawave.plans.cleaning import DENSE, dense, long_dense
from terrawave.plans.field import VECTORS, vectors
from terrawave.plans.welch import _spectra_sql

_SPECTRA = "sx AS (SELECT k % 30 // 10 AS band, site AS member, k // 30 AS w, k % 30 AS h, hx * (CASE WHEN site % 4 = 0 AND k // 30 % 5 = 0 THEN 9 ELSE 1 END) AS re, hy * (CASE WHEN site % 4 = 0 AND k // 30 % 5 = 0 THEN 9 ELSE 1 END) AS im FROM vectors)"


def _member_spectra(spark, sf_dir):
    loud = F.when((F.col("site") % 4 == 0) & (F.expr("k div 30 % 5") == 0), 9.0).otherwise(1.0)
    return vectors(spark, sf_dir).select(F.expr("k % 30 div 10").alias("band"), F.col("site").alias("member"), F.expr("k div 30").alias("w"), (F.col("k") % 30).alias("h"), (F.col("hx") * loud).alias("re"), (F.col("hy") * loud).alias("im"))


@query("band_stack", sql(VECTORS, _SPECTRA, "pw AS (SELECT band, member, w, avg(re * re + im * im) AS p FROM sx GROUP BY 1, 2, 3)", "md AS (SELECT band, member, median(p) AS m FROM pw GROUP BY 1, 2 HAVING median(p) > 0)", "nw AS (SELECT p.band, p.member, p.w, sqrt(m) AS scale, p / m AS power FROM pw p JOIN md ON p.band = md.band AND p.member = md.member)", "kp AS (SELECT * FROM (SELECT *, median(power) OVER (PARTITION BY band, w) AS level FROM nw) WHERE power <= 4 * level)", f"SELECT CAST(s.band AS BIGINT) AS band, CAST(s.w AS BIGINT) AS w, CAST(s.h AS BIGINT) AS h, count(*) AS members, {q6('avg(re / scale)', 're')}, {q6('avg(im / scale)', 'im')} FROM sx s JOIN kp ON s.band = kp.band AND s.member = kp.member AND s.w = kp.w GROUP BY 1, 2, 3 HAVING count(*) >= 2"))
def band_stack(spark, sf_dir):
    """Spectra of all suppliers stacked by band, without those far above the others in a window."""
    out = stacks.band_stack(_member_spectra(spark, sf_dir), ["band"], reject=4.0)
    return out.select(F.col("band").cast("long").alias("band"), F.col("w").cast("long").alias("w"), F.col("h").cast("long").alias("h"), "members", r6("re", "re"), r6("im", "im"))


_CHUNK, _SEG = 160, 32
_BINS = max(1, round(math.log10(16) * 6))
_MEMBERS = ("hx", "hy", "ex", "ey")
_COHERENT = (
    DENSE,
    "mm AS (" + " UNION ALL ".join(f"SELECT site AS s, '{n}' AS member, k, {n} AS x FROM dense" for n in _MEMBERS) + ")",
    "ml AS (SELECT s, member, quantile_disc(x, 0.5) AS m FROM mm GROUP BY 1, 2)",
    "mz AS (SELECT mm.s, mm.member, k, x - m AS x FROM mm JOIN ml ON mm.s = ml.s AND mm.member = ml.member)",
    "mo AS (SELECT s || '/' || member AS site, k, x AS hx, (sum(x) OVER (PARTITION BY s, k) - x) / (count(*) OVER (PARTITION BY s, k) - 1) AS ex FROM mz)",
    *_spectra_sql("mo", _CHUNK, _CHUNK, _SEG),
    f"cb AS (SELECT site, w, CAST(floor(ln({_SEG}.0 / h / 2) / ln(16.0::DOUBLE) * {_BINS}) AS INTEGER) AS i, avg((cr * cr + ci * ci) / nullif(paa * pbb, 0)) AS c FROM sp WHERE {_SEG}.0 / h >= 2 AND {_SEG}.0 / h < 32 GROUP BY 1, 2, 3)",
    "co AS (SELECT CAST(split_part(site, '/', 1) AS BIGINT) AS site, split_part(site, '/', 2) AS member, w AS chunk, avg(c) AS coherence FROM cb GROUP BY site, w)",
)


def _coherences(spark, sf_dir):
    rows = long_dense(spark, sf_dir, _MEMBERS).withColumnRenamed("channel", "member")
    return stacks.member_coherence(rows, ["site"], 1.0, _CHUNK, _SEG, 2.0, 32.0)


@query("member_coherence", sql(*_COHERENT, f"SELECT site, member, CAST(chunk AS BIGINT) AS chunk, {q6('coherence', 'coherence')} FROM co"))
def member_coherence(spark, sf_dir):
    """Coherence of each channel with the mean of the site's others, chunk by chunk."""
    return _coherences(spark, sf_dir).select("site", "member", "chunk", r6("coherence", "coherence"))


@query("coherence_weights", sql(*_COHERENT, "wa AS (SELECT *, coherence / sum(coherence) OVER (PARTITION BY site, chunk) AS w0 FROM co)", "wb AS (SELECT *, CASE WHEN w0 < 0.2 THEN 0 ELSE w0 END AS w1 FROM wa)", "wc AS (SELECT *, sum(w1) OVER (PARTITION BY site, chunk) AS t FROM wb)", f"SELECT site, member, CAST(chunk AS BIGINT) AS chunk, {q6('CASE WHEN t > 0 THEN w1 / t ELSE w0 END', 'weight')} FROM wc"))
def coherence_weights(spark, sf_dir):
    """Weights of a site's channels in a stack, chunk by chunk."""
    return stacks.weights(_coherences(spark, sf_dir), ["site", "chunk"], floor=0.2).select("site", "member", "chunk", r6("weight", "weight"))


@query("line_groups", sql("li AS (SELECT CAST(user_id % 20 AS BIGINT) AS site, value AS f, event_type AS channel, epoch_us(ts) // 3600000000 AS hour, CAST(event_id % 37 AS DOUBLE) AS excess FROM events)", "g AS (SELECT *, CASE WHEN f - lag(f) OVER (PARTITION BY site ORDER BY f) <= 0.5 THEN 0 ELSE 1 END AS n FROM li)", "r AS (SELECT *, sum(n) OVER (PARTITION BY site ORDER BY f ROWS UNBOUNDED PRECEDING) AS r FROM g)", f"SELECT site, {q6('avg(f)', 'f')}, string_agg(DISTINCT channel, ',' ORDER BY channel) AS channels, count(DISTINCT hour) AS hours, max(excess) AS excess FROM r GROUP BY site, r HAVING count(DISTINCT hour) >= 2"))
def line_groups(spark, sf_dir):
    """Lines chained in frequency over hours and channels."""
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 20).cast("long").alias("site"), F.col("value").alias("f"), F.col("event_type").alias("channel"), F.expr("unix_micros(cast(ts as timestamp)) div 3600000000").alias("hour"), (F.col("event_id") % 37).cast("double").alias("excess"), F.lit(False).alias("mains"))
    return grouping.line_groups(e, ["site"], 0.5, width=20.0).select("site", r6("f", "f"), "channels", "hours", "excess")


_POINTS = "pt AS (SELECT CAST(l_suppkey AS BIGINT) AS site, l_orderkey * 8 + l_linenumber AS id, l_extendedprice / 20000 + (CASE WHEN l_quantity > 30 THEN 3 ELSE 0 END) AS x, l_discount * 200 + (CASE WHEN l_quantity > 30 THEN 0.0 ELSE 60.0 END) - 10 + l_tax AS y FROM lineitem)"


def _cluster_round(i: int) -> str:
    d = [f"(pow(u - m.x{j}, 2) + pow(v - m.y{j}, 2))" for j in (0, 1)]
    return f"""a{i} AS MATERIALIZED (SELECT n.site, id, x, y, u, v, CASE WHEN {d[1]} < {d[0]} THEN 1 ELSE 0 END AS lab FROM ns n JOIN m{i - 1} m ON n.site = m.site),
m{i} AS MATERIALIZED (SELECT a.site, {", ".join(f"coalesce(avg(CASE WHEN lab = {j} THEN {c} END), any_value(m.{o}{j})) AS {o}{j}" for j in (0, 1) for c, o in (("u", "x"), ("v", "y")))} FROM a{i} a JOIN m{i - 1} m ON a.site = m.site GROUP BY a.site)"""


_CLUSTERS = (
    _POINTS,
    "nn AS (SELECT *, count(*) OVER (PARTITION BY site) AS n, median(x) OVER (PARTITION BY site) AS mx, median(y) OVER (PARTITION BY site) AS my FROM pt)",
    "sd AS (SELECT site, 1.4826 * median(abs(x - mx)) AS sx, 1.4826 * median(abs(y - my)) AS sy FROM nn GROUP BY 1)",
    "ns AS MATERIALIZED (SELECT nn.site, id, x, y, n, (x - mx) / CASE WHEN sx > 0 THEN sx ELSE 1 END AS u, (y - my) / CASE WHEN sy > 0 THEN sy ELSE 1 END AS v, row_number() OVER (PARTITION BY nn.site ORDER BY y, id) AS r FROM nn JOIN sd ON nn.site = sd.site WHERE n >= 30)",
    "m0 AS MATERIALIZED (SELECT site, avg(CASE WHEN r <= k THEN u END) AS x0, avg(CASE WHEN r <= k THEN v END) AS y0, avg(CASE WHEN r > n - k THEN u END) AS x1, avg(CASE WHEN r > n - k THEN v END) AS y1 FROM (SELECT *, greatest(1, CAST(round_even(0.1 * n, 0) AS BIGINT)) AS k FROM ns) GROUP BY 1)",
    *(_cluster_round(i) for i in range(1, 13)),
    "lb AS (SELECT site, id, x, y, lab FROM a12)",
    "pm AS (SELECT site, median(CASE WHEN lab = 0 THEN y END) AS p0, median(CASE WHEN lab = 1 THEN y END) AS p1, count(*) AS n, avg(lab) AS one FROM lb GROUP BY 1)",
    "fc AS (SELECT *, CASE WHEN abs(p0) >= abs(p1) THEN p0 ELSE p1 END AS earth, CASE WHEN abs(p0) >= abs(p1) THEN p1 ELSE p0 END AS source, CASE WHEN abs(p0) >= abs(p1) THEN 1 - one ELSE one END AS share FROM pm WHERE p0 IS NOT NULL AND p1 IS NOT NULL)",
    "ma AS (SELECT lb.site, median(abs(y - CASE WHEN lab = 0 THEN p0 ELSE p1 END)) AS mad FROM lb JOIN pm ON lb.site = pm.site GROUP BY 1)",
)


@query("cluster_split", sql(*_CLUSTERS, f"SELECT fc.site, n, {q6('earth', 'earth_phase')}, {q6('source', 'source_phase')}, {q6('mad', 'mad')}, {q6('share', 'earth_fraction')}, earth BETWEEN 0 AND 90 AND abs(source) <= 30 AND abs(earth - source) >= 20 AND abs(earth - source) > 2 * mad AND share >= 0.2 AS accepted FROM fc JOIN ma ON fc.site = ma.site"))
def cluster_split(spark, sf_dir):
    """Two clusters of each site's estimates in size and phase, and whether one is a source's."""
    up = F.col("l_quantity") > 30
    p = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("long").alias("site"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), (F.col("l_extendedprice") / 20000 + F.when(up, 3).otherwise(0)).alias("log_z"), (F.col("l_discount") * 200 + F.when(up, 0.0).otherwise(60.0) - 10 + F.col("l_tax")).alias("phase"))
    _, facts = grouping.cluster_split(p, ["site"], rounds=12)
    return facts.select("site", "n", *(r6(c, c) for c in ("earth_phase", "source_phase", "mad", "earth_fraction")), "accepted")


_STAGES = "st AS (SELECT CAST(l_suppkey AS BIGINT) AS site, l_linenumber % 3 AS stage, 1 + l_quantity AS f, 1 + avg(l_discount) * 10 AS re, avg(l_tax) * 10 - 0.3 AS im FROM lineitem WHERE l_linenumber % 3 < 2 OR l_quantity = 20 GROUP BY 1, 2, 3)"


@query("calibrated_spectra", sql(VECTORS, _STAGES, "wa AS (SELECT site, 0.5 + k % 60 AS f, avg(hx) AS re, avg(hy) AS im FROM vectors GROUP BY 1, 2)", "ev AS (SELECT s.site, s.stage, w.f, max(CASE WHEN s.f <= w.f THEN s.f END) AS p, min(CASE WHEN s.f >= w.f THEN s.f END) AS q FROM st s JOIN wa w ON s.site = w.site GROUP BY 1, 2, 3)", "iv AS (SELECT e.site, e.stage, e.f, " + ", ".join(f"coalesce(a.{c} + coalesce((ln(e.f) - ln(p)) / nullif(ln(q) - ln(p), 0), 0) * (b.{c} - a.{c}), a.{c}, b.{c}) AS {c}" for c in ("re", "im")) + " FROM ev e LEFT JOIN st a ON a.site = e.site AND a.stage = e.stage AND a.f = p LEFT JOIN st b ON b.site = e.site AND b.stage = e.stage AND b.f = q)", "ch AS (SELECT site, f, exp(sum(ln(sqrt(re * re + im * im)))) AS s, sum(atan2(im, re)) AS a FROM iv GROUP BY 1, 2)", "cx AS (SELECT site, f, s * cos(a) AS re, s * sin(a) AS im FROM ch)", f"SELECT w.site, {q6('w.f', 'f')}, {q6('(w.re * c.re + w.im * c.im) / (c.re * c.re + c.im * c.im)', 're')}, {q6('(w.im * c.re - w.re * c.im) / (c.re * c.re + c.im * c.im)', 'im')} FROM wa w JOIN cx c ON w.site = c.site AND w.f = c.f"))
def calibrated_spectra(spark, sf_dir):
    """Spectra of each supplier over the response of its chain of stages, one of them the same at all frequencies."""
    st = table(spark, sf_dir, "lineitem").where("l_linenumber % 3 < 2 or l_quantity = 20").groupBy(F.col("l_suppkey").cast("long").alias("site"), (F.col("l_linenumber") % 3).alias("stage"), (1 + F.col("l_quantity")).alias("f")).agg((1 + F.avg("l_discount") * 10).alias("re"), (F.avg("l_tax") * 10 - 0.3).alias("im"))
    w = vectors(spark, sf_dir).groupBy(F.col("site").cast("long").alias("site"), (0.5 + F.col("k") % 60).alias("f")).agg(F.avg("hx").alias("re"), F.avg("hy").alias("im"))
    out = grouping.calibrated(w, grouping.responses(st, ["site"], w), ["site"])
    return out.select("site", r6("f", "f"), r6("re", "re"), r6("im", "im"))


_SHORT = "sh AS (SELECT CAST(l_suppkey AS BIGINT) AS site, l_quantity AS period, avg(l_discount) + 0.1 AS re, avg(l_tax) + 0.1 AS im, 0.1 AS err FROM lineitem WHERE l_quantity <= 30 GROUP BY 1, 2)"
_LONGP = "lg AS (SELECT CAST(l_suppkey AS BIGINT) AS site, l_quantity + 0.5 AS period, avg(l_tax) + 0.2 AS re, avg(l_discount) + 0.1 AS im, 0.2 AS err FROM lineitem WHERE l_quantity >= 15 GROUP BY 1, 2)"
_SPLICE = (
    _SHORT,
    _LONGP,
    "sp AS (SELECT site, log10(period) AS x0, log10(sqrt(re * re + im * im)) AS a, atan2(im, re) AS t FROM sh)",
    "pc AS (SELECT *, lead(x0) OVER w AS x1, lead(a) OVER w AS a1, lead(t) OVER w AS t1 FROM sp WINDOW w AS (PARTITION BY site ORDER BY x0))",
    "lp AS (SELECT site, log10(period) AS x, log10(sqrt(re * re + im * im)) AS la, atan2(im, re) AS lt FROM lg WHERE period BETWEEN 16 * (1 - 1e-9) AND 60 * (1 + 1e-9))",
    "pp AS (SELECT l.site, x, la - (a + (x - x0) / (x1 - x0) * (a1 - a)) AS da, lt - (t + (x - x0) / (x1 - x0) * (t1 - t)) AS dt FROM lp l JOIN pc p ON l.site = p.site AND x >= x0 AND x < x1)",
    "fa AS (SELECT s.site, s.period, count(*) AS n, sum(exp(-0.5 * pow((log10(s.period) - x) / 0.1, 2)) * da) / sum(exp(-0.5 * pow((log10(s.period) - x) / 0.1, 2))) AS l, sum(exp(-0.5 * pow((log10(s.period) - x) / 0.1, 2)) * dt) / sum(exp(-0.5 * pow((log10(s.period) - x) / 0.1, 2))) AS t FROM sh s JOIN pp ON s.site = pp.site GROUP BY 1, 2 HAVING count(*) >= 2)",
    "al AS (SELECT s.site, s.period, pow(10, l) * (re * cos(t) - im * sin(t)) AS re, pow(10, l) * (re * sin(t) + im * cos(t)) AS im, err * pow(10, l) AS err FROM sh s JOIN fa ON s.site = fa.site AND s.period = fa.period)",
    "fi AS (SELECT site, min(period) AS first FROM lg GROUP BY 1)",
    "al2 AS (SELECT al.* FROM al JOIN fi ON al.site = fi.site WHERE period < first * pow(10, -0.002))",
)


@query("windows_spliced", sql(*_SPLICE, f"SELECT site, {q6('period', 'period')}, {q6('re', 're')}, {q6('im', 'im')}, {q6('err', 'err')}, source FROM (SELECT *, 'short' AS source FROM al2 UNION ALL SELECT *, 'long' FROM lg)"))
def windows_spliced(spark, sf_dir):
    """Products of short periods aligned with those of long ones and set below them."""
    q = F.col("l_quantity")
    rows = table(spark, sf_dir, "lineitem").withColumn("site", F.col("l_suppkey").cast("long"))
    short = rows.where(q <= 30).groupBy("site", q.alias("period")).agg((F.avg("l_discount") + 0.1).alias("re"), (F.avg("l_tax") + 0.1).alias("im"), F.lit(0.1).alias("err"))
    long = rows.where(q >= 15).groupBy("site", (q + 0.5).alias("period")).agg((F.avg("l_tax") + 0.2).alias("re"), (F.avg("l_discount") + 0.1).alias("im"), F.lit(0.2).alias("err"))
    out = grouping.windows_spliced(short, long, ["site"], (16.0, 60.0))
    return out.select("site", *(r6(c, c) for c in ("period", "re", "im", "err")), "source")


_FILES = "fl AS (SELECT CAST(o_custkey AS BIGINT) AS site, CAST(epoch_us(o_orderdate) // 86400000000 // 800 AS BIGINT) AS run, CAST(epoch_us(o_orderdate) // 86400000000 + o_orderkey % 1000 / 1000.0 AS DOUBLE) AS stamp, CAST(epoch_us(o_orderdate) // 86400000000 + 1 + o_orderkey % 1000 / 1000.0 AS DOUBLE) AS finish, 50 + o_orderkey % 100 AS records FROM orders)"
_BASES = (
    _FILES,
    "oo AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY stamp, run) AS i, count(*) OVER (PARTITION BY site) AS n, min(stamp) OVER (PARTITION BY site) AS first, coalesce(sum(records) OVER (PARTITION BY site, run ORDER BY stamp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM fl)",
    "r1 AS (SELECT site, min(run) AS run1, min(stamp) AS first, max(finish) AS last FROM fl GROUP BY 1)",
    "ea AS (SELECT site, run, count(*) AS c, avg(k) AS mk, avg(stamp - first) AS mt, var_pop(k) AS v, covar_pop(k, stamp - first) AS cv FROM oo WHERE i > 1 AND i < n GROUP BY 1, 2)",
    "wh AS (SELECT e.site, sum(c) AS c, sum(c * cv) / nullif(sum(c * v), 0) AS s, max(CASE WHEN run = run1 THEN mk END) AS k0, max(CASE WHEN run = run1 THEN mt END) AS t0 FROM ea e JOIN r1 ON e.site = r1.site GROUP BY 1)",
    "ru AS (SELECT site, run, min(stamp) AS a, max(finish) AS b, sum(records) AS n FROM fl GROUP BY 1, 2)",
    "pl AS (SELECT site, sum(n) / sum(b - a) AS plain FROM ru GROUP BY 1)",
    "bs AS (SELECT ru.site, ru.run, ru.n, ru.a, r1.first, r1.last, r1.run1, plain, CASE WHEN c >= 3 AND s > 0 THEN 1 / s END AS fs, CASE WHEN c >= 3 AND s > 0 THEN coalesce(t0 - s * k0, 0) ELSE 0 END AS late FROM ru JOIN r1 ON ru.site = r1.site JOIN pl ON ru.site = pl.site LEFT JOIN wh ON ru.site = wh.site)",
)


@query("time_bases", sql(*_BASES, f"SELECT site, run, CAST(n AS BIGINT) AS n, {q6('coalesce(fs, plain) / (1 + 3.0 / (last - first))', 'fs_true')}, {q6('3.0 * (a - first) / (last - first)', 'rtc_error')}, {q6('CASE WHEN run = run1 THEN 0 ELSE late END', 'latency')}, {q6('a + 3.0 * (a - first) / (last - first) - CASE WHEN run = run1 THEN 0 ELSE late END', 'start')} FROM bs WHERE last > first"))
def time_bases(spark, sf_dir):
    """True rates and starts of the runs of each customer's files."""
    day, part = F.expr("unix_micros(cast(o_orderdate as timestamp)) div 86400000000"), F.col("o_orderkey") % 1000 / 1000
    f = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("long").alias("site"), F.expr("unix_micros(cast(o_orderdate as timestamp)) div 86400000000 div 800").alias("run"), (day + part).alias("stamp"), (day + 1 + part).alias("finish"), (50 + F.col("o_orderkey") % 100).alias("records"), F.lit(3.0).alias("drift"))
    return resample.time_bases(f, ["site"], "drift").select("site", "run", "n", *(r6(c, c) for c in ("fs_true", "rtc_error", "latency", "start")))


@query("resampled")
def resampled(spark, sf_dir):
    """Series of a sampler a little fast put on the grid of whole days; tests hold it against a dense solve."""
    rows = dense(spark, sf_dir)
    first = rows.groupBy("site").agg(F.min("k").alias("lo"))
    rows = rows.join(first, "site").select("site", (F.col("k") - F.col("lo")).alias("i"), "hx", "ex")
    bases = first.select("site", (F.col("lo") * 100_000_000 + 37_000_000).alias("start_ns"), F.lit(10.00064).alias("fs_true"))
    return resample.resampled(rows, ["site"], ["hx", "ex"], bases, 10).select("site", "k", r6("hx", "hx"), r6("ex", "ex"))


@query("mains_subtracted")
def mains_subtracted(spark, sf_dir):
    """Series without a week's cycle and its harmonics, by a fitted model; tests hold it against one series in numpy."""
    return mains.subtracted(dense(spark, sf_dir), ["site"], "hx", 28.0, f0=4.0, harmonics=3, block_s=4.0).select("site", "k", r6("hx", "hx"))


def _merge_sql(name: str, source: str) -> str:
    return f"{name} AS MATERIALIZED (SELECT site, period FROM (SELECT *, lag(period) OVER (PARTITION BY site ORDER BY period) AS b FROM (SELECT DISTINCT site, period FROM ({source}))) WHERE b IS NULL OR log10(period) - log10(b) > 1e-5)"


def _near_sql(rows: str, others: str, test: str = "<= 1e-5", columns: str = "site, period") -> str:
    """rows with `hit`, whether a period of others is near."""
    mine = ", ".join(f"r.{c}" for c in columns.split(", "))
    return f"SELECT {mine}, coalesce(bool_or(abs(log10(o.period) - log10(r.period)) {test}), FALSE) AS hit FROM {rows} r LEFT JOIN {others} o ON r.site = o.site GROUP BY {mine}"


_GRID = (
    "so AS MATERIALIZED (SELECT CAST(l_suppkey // 10 AS BIGINT) AS site, 'P' || (l_suppkey % 4) AS source, l_suppkey % 4 AS rank, CASE WHEN l_linenumber % 2 = 0 THEN 'xy' ELSE 'yx' END AS mode, (l_quantity + l_suppkey % 4 * 3) * (CASE WHEN l_suppkey % 4 > 1 THEN 1.037 ELSE 1.0 END) AS period, round(avg(l_discount), 9) > 0.045 AS usable, l_quantity BETWEEN 3 + l_suppkey % 4 AND 46 AS inside FROM lineitem GROUP BY l_suppkey // 10, l_suppkey % 4, l_linenumber % 2, l_quantity)",
    "fi AS (SELECT site, arg_min(source, rank) AS f FROM so WHERE mode = 'xy' GROUP BY 1)",
    "rf AS MATERIALIZED (SELECT so.site, period FROM so JOIN fi ON so.site = fi.site WHERE source = f AND mode = 'xy')",
    "sp AS (SELECT site, log10(min(period)) - 1e-5 AS lo, log10(max(period)) + 1e-5 AS hi FROM rf GROUP BY 1)",
    "fu AS (SELECT DISTINCT site, source, period FROM so)",
    f"ah AS ({_near_sql('fu', 'rf', columns='site, source, period')})",
    "ac AS MATERIALIZED (SELECT ah.*, log10(period) BETWEEN lo AND hi AS i, source = f AS first FROM ah JOIN sp ON ah.site = sp.site JOIN fi ON ah.site = fi.site)",
    "onl AS MATERIALIZED (SELECT site, source FROM ac GROUP BY 1, 2 HAVING bool_or(first) OR (count(*) FILTER (i) > 0 AND 2 * count(*) FILTER (i AND hit) >= count(*) FILTER (i)))",
    _merge_sql("lt", "SELECT site, period FROM rf UNION ALL SELECT ac.site, ac.period FROM ac JOIN onl ON ac.site = onl.site AND ac.source = onl.source WHERE NOT i AND NOT first"),
    _merge_sql("un", "SELECT site, period FROM so WHERE usable AND inside"),
    f"uo AS MATERIALIZED ({_near_sql('un', 'lt')})",
    "ofs AS MATERIALIZED (SELECT so.*, lead(period) OVER w AS nx, lead(usable) OVER w AS ok FROM so LEFT JOIN onl ON so.site = onl.site AND so.source = onl.source WHERE inside AND onl.source IS NULL WINDOW w AS (PARTITION BY so.site, so.source, mode ORDER BY period))",
    "ou AS (SELECT DISTINCT site, period FROM ofs WHERE usable)",
    f"le AS ({_near_sql('lt', 'ou')})",
    _merge_sql("kp", "SELECT site, period FROM uo WHERE hit UNION ALL SELECT site, period FROM le WHERE hit UNION ALL SELECT lt.site, lt.period FROM lt JOIN ofs o ON lt.site = o.site AND o.usable AND o.ok AND lt.period > o.period AND lt.period < o.nx"),
    "uf AS (SELECT site, period FROM uo WHERE NOT hit)",
    f"ur AS ({_near_sql('uf', 'kp', '< 0.02')})",
    _merge_sql("gr", "SELECT site, period FROM kp UNION ALL SELECT site, period FROM ur WHERE NOT hit"),
    f"ga AS ({_near_sql('gr', 'un')})",
)


@query("first_lattice", sql(*_GRID, f"SELECT site, {q6('period', 'period')}, NOT hit AS added FROM ga"))
def first_lattice(spark, sf_dir):
    """The grid of each site's merge on the lattice of its first source."""
    rank, q = F.col("l_suppkey") % 4, F.col("l_quantity")
    s = table(spark, sf_dir, "lineitem").groupBy(F.expr("cast(l_suppkey div 10 as bigint)").alias("site"), rank.alias("rank"), (F.col("l_linenumber") % 2).alias("m"), q.alias("q")).agg((F.round(F.avg("l_discount"), 9) > 0.045).alias("usable"))
    s = s.select("site", F.concat(F.lit("P"), F.col("rank").cast("string")).alias("source"), "rank", F.when(F.col("m") == 0, "xy").otherwise("yx").alias("mode"), ((F.col("q") + F.col("rank") * 3) * F.when(F.col("rank") > 1, 1.037).otherwise(1.0)).alias("period"), "usable", ((F.col("q") >= 3 + F.col("rank")) & (F.col("q") <= 46)).alias("inside"))
    grid, _, _ = lattice.first_lattice(s, ["site"])
    return grid.select("site", r6("period", "period"), "added")
