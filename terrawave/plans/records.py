"""Queries of shared centres, recorders, times in names, an index that is read again in part, donors and differences between estimates."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrawave.functions.names import LEAP_DAYS
from terrawave.operators import centre, donors, welch
from terrawave.plans.base import PRODUCTS, products, q6, r6, sql, table
from terrawave.plans.catalog import query
from terrawave.plans.cleaning import LONG_DENSE, dense, long_dense
from terrawave.plans.screens import _SEG, _SERIES, _STEP, _WIN
from terrawave.plans.tensors import _mul, _power
from terrawave.sources import listing

_LOW, _HIGH = 2.0, 20.0
_X, _Y, _O = ("hx", "hx"), ("hy", "hy"), ("hx", "hy")


def _z(a: str, b: str) -> tuple[str, str]:
    """Parts of the mean of conj(a) b."""
    return f"z_{a}{b}_re", f"z_{a}{b}_im"


def _bar(a: tuple[str, str]) -> tuple[str, str]:
    return a[0], f"(-{a[1]})"


def _fit(a: str, b: str) -> tuple[str, str]:
    xx, yy, xy = "z_hxhx_re", "z_hyhy_re", _z("hx", "hy")
    one, two = _mul(_bar(_z("hx", a)), _z("hx", b)), _mul(_bar(_z("hy", a)), _z("hy", b))
    three, four = _mul(xy, _mul(_bar(_z("hx", a)), _z("hy", b))), _mul(_bar(xy), _mul(_bar(_z("hy", a)), _z("hx", b)))
    det = f"({xx} * {yy} - {_power(xy)})"
    return tuple(f"(({yy} * {one[p]} + {xx} * {two[p]} - {three[p]} - {four[p]}) / {det})" for p in (0, 1))


_ALL = [(a, b) for i, a in enumerate(centre.CHANNELS) for b in centre.CHANNELS[i:]]
_EDGES = centre.octaves(_LOW, _HIGH)
_MED = ", ".join(f"median({v}) AS {v}" for v in centre.VALUES)
_GOOD = f"coh_r >= {centre.MODEL_COHERENCE} AND gain BETWEEN {centre.MODEL_GAIN[0]} AND {centre.MODEL_GAIN[1]}"
_CENTRE = (
    *(p if not p.startswith("gappy") else "gappy AS (SELECT * FROM dense)" for p in _SERIES[:8]),
    "zz AS MATERIALIZED (SELECT site, w, h, " + ", ".join(f"avg({a}r * {b}r + {a}i * {b}i) AS z_{a}{b}_re, avg({a}r * {b}i - {a}i * {b}r) AS z_{a}{b}_im" for a, b in _ALL) + f" FROM ft WHERE {_SEG}.0 / h BETWEEN {_LOW} AND {_HIGH} GROUP BY 1, 2, 3)",
    "qq AS MATERIALIZED (SELECT *, " + ", ".join(f"{_fit(a, b)[p]} AS e_{a}{b}_{n}" for a, b in (("ex", "ex"), ("ey", "ey"), ("ex", "ey")) for p, n in enumerate(("re", "im"))) + " FROM zz)",
    "rr AS (SELECT *, z_exex_re - e_exex_re AS rxx, z_eyey_re - e_eyey_re AS ryy, z_exey_re - e_exey_re AS r_re, z_exey_im - e_exey_im AS r_im FROM qq)",
    f"ob AS (SELECT site, w, {' + '.join(f'CAST({_SEG}.0 / h >= {e} AS INTEGER)' for e in _EDGES[1:-1])} AS octave, (z_exey_re * z_exey_re + z_exey_im * z_exey_im) / (z_exex_re * z_eyey_re) AS src, (r_re * r_re + r_im * r_im) / (rxx * ryy) AS coh_r, sqrt(r_re * r_re + r_im * r_im) / rxx AS gain, r_re / rxx AS re_g, -r_im / rxx AS im_g, (e_exex_re + e_eyey_re - 2 * e_exey_re) / (z_exex_re + z_eyey_re - 2 * z_exey_re) AS mcoh_diff, (e_exex_re + e_eyey_re + 2 * e_exey_re) / (z_exex_re + z_eyey_re + 2 * z_exey_re) AS mcoh_sum FROM rr)",
    f"oc AS (SELECT site, w, octave, {_MED} FROM ob GROUP BY 1, 2, 3)",
    f"dy AS MATERIALIZED (SELECT *, CASE WHEN re_g >= 0 THEN 1 ELSE -1 END AS s, {_GOOD} AS model FROM (SELECT site, w, {_MED} FROM oc GROUP BY 1, 2))",
)


def _days(spark, sf_dir):
    spec = welch.window_spectra(dense(spark, sf_dir), ["site"], centre.CHANNELS, centre.PAIRS, 1.0, _WIN, _STEP, _SEG)
    names = [*(f"psd_{c}" for c in centre.CHANNELS), *(f"csd_{a}_{b}_{p}" for a, b in centre.PAIRS for p in ("re", "im"))]
    stats = centre.residuals(welch.by_frequency(spec, ["site"], names, 1.0, _SEG), ["site", "w"], _LOW, _HIGH)
    return centre.day_values(centre.octave_medians(stats, ["site", "w"], _LOW, _HIGH), ["site", "w"])


@query("shared_centre_days", sql(*_CENTRE, f"SELECT site, CAST(w AS BIGINT) AS w, {', '.join(q6(v, v) for v in centre.VALUES)}, s, model FROM dy"))
def shared_centre_days(spark, sf_dir):
    """What the fields leave of both electric lines, window by window."""
    return _days(spark, sf_dir).select("site", "w", *(r6(v, v) for v in centre.VALUES), "s", "model")


@query("shared_centre_verdicts", sql(*_CENTRE, "rk AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY src DESC, w) <= 5 AS chosen FROM dy)", f"ve AS (SELECT site, count(*) AS days_usable, sum(CAST(model AS INTEGER)) AS days_model, {', '.join(f'median({v}) FILTER (WHERE chosen) AS {v}' for v in centre.VALUES)}, max(src) AS src_max, sum(CASE WHEN chosen THEN s END) AS s FROM rk GROUP BY 1)", f"SELECT site, days_usable, CAST(days_model AS BIGINT) AS days_model, {', '.join(q6(v, v) for v in (*centre.VALUES, 'src_max'))}, CASE WHEN s < 0 THEN -1 ELSE 1 END AS s_obs, CASE WHEN s < 0 THEN 'sum' ELSE 'diff' END AS clean_obs, CASE WHEN mcoh_diff > mcoh_sum THEN 'diff' ELSE 'sum' END AS clean_by_h, CASE WHEN {_GOOD} THEN 'holds' WHEN src_max < {centre.CONTROL} THEN 'control' ELSE 'fails' END AS verdict FROM ve"))
def shared_centre_verdicts(spark, sf_dir):
    """Verdict of each site over its windows of highest coherence."""
    out = centre.site_verdict(_days(spark, sf_dir), ["site"], "w")
    return out.select("site", "days_usable", "days_model", *(r6(v, v) for v in (*centre.VALUES, "src_max")), "s_obs", "clean_obs", "clean_by_h", "verdict")


_NAMES = """names AS (SELECT CAST(o_custkey AS BIGINT) AS site, o_orderkey AS id, CASE (o_orderkey + o_custkey) % 8
  WHEN 0 THEN CAST(epoch(CAST(o_orderdate AS TIMESTAMP)) AS BIGINT) || '.B423' WHEN 1 THEN strftime(CAST(o_orderdate AS TIMESTAMP), '%y%m%d') || '0' || o_orderkey % 10 || '0500.txt'
  WHEN 2 THEN 'S' || strftime(CAST(o_orderdate AS TIMESTAMP), '%y%m%d') || lpad(CAST(o_orderkey % 30 AS VARCHAR), 2, '0') || '0000.EX' WHEN 3 THEN '7_' || lpad(to_hex(900000000 + o_orderkey * 997), 8, '0') || '_0_0000000A.td_150'
  WHEN 4 THEN 'HFM' || o_orderkey || '-001.BIN' WHEN 5 THEN '._12.B423' WHEN 6 THEN 'recorder.ini' ELSE 'notes.txt' END AS name FROM orders)"""


def _names(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    at = F.col("o_orderdate").cast("timestamp")
    day = F.date_format(F.col("o_orderdate").cast("date"), "yyMMdd")
    case = (key + F.col("o_custkey")) % 8
    name = F.when(case == 0, F.concat(F.unix_seconds(at).cast("string"), F.lit(".B423"))).when(case == 1, F.concat(day, F.lit("0"), (key % 10).cast("string"), F.lit("0500.txt"))).when(case == 2, F.concat(F.lit("S"), day, F.lpad((key % 30).cast("string"), 2, "0"), F.lit("0000.EX")))
    name = name.when(case == 3, F.concat(F.lit("7_"), F.lpad(F.hex(900000000 + key * 997), 8, "0"), F.lit("_0_0000000A.td_150"))).when(case == 4, F.concat(F.lit("HFM"), key.cast("string"), F.lit("-001.BIN"))).when(case == 5, "._12.B423").when(case == 6, "recorder.ini").otherwise("notes.txt")
    return o.select(F.col("o_custkey").cast("long").alias("site"), key.alias("id"), name.alias("name"))


_KIND = "CASE WHEN name LIKE '\\_\\_%' ESCAPE '\\' OR name LIKE '.\\_%' ESCAPE '\\' THEN NULL WHEN name LIKE '%.B423' THEN 'lemi423' WHEN regexp_matches(name, '^[0-9]{12}[.]txt$') THEN 'lemi424' WHEN name LIKE '%.EX' THEN 'edl' WHEN name LIKE '%.td_150' THEN 'phoenix' WHEN name LIKE 'HFM%' THEN 'orangebox' END"


@query("recorders_detected", sql(_NAMES, f"e AS (SELECT site, CASE WHEN name = 'recorder.ini' THEN 'edl' ELSE {_KIND} END AS kind FROM names)", "SELECT site, arg_min(kind, CASE kind WHEN 'phoenix' THEN 0 WHEN 'lemi423' THEN 1 WHEN 'lemi424' THEN 2 WHEN 'edl' THEN 3 ELSE 4 END) AS recorder FROM e WHERE kind IS NOT NULL GROUP BY 1"))
def recorders_detected(spark, sf_dir):
    """The recorder each site's folder is read by."""
    return listing.recorder(_names(spark, sf_dir), ["site"], "phoenix")


_LEAPS = " - ".join(f"CAST(gps - {i} >= epoch(DATE '{day}') AS INTEGER)" for i, day in enumerate(LEAP_DAYS))


@query("file_times_named", sql(_NAMES, f"k AS (SELECT id, name, {_KIND} AS kind FROM names)", "t AS (SELECT *, right(split_part(name, '.', 1), 12) AS st, CASE WHEN kind = 'phoenix' THEN CAST('0x' || split_part(name, '_', 2) AS BIGINT) END + 315964800 AS gps FROM k)", f"SELECT id, kind, CAST(CASE WHEN kind = 'lemi423' THEN CAST(split_part(name, '.', 1) AS BIGINT) WHEN kind IN ('lemi424', 'edl') THEN epoch(strptime('20' || left(st, 6), '%Y%m%d')) + CASE WHEN CAST(substr(st, 7, 2) AS INTEGER) < 24 THEN CAST(substr(st, 7, 2) AS INTEGER) * 3600 + CAST(substr(st, 9, 2) AS INTEGER) * 60 + CAST(substr(st, 11, 2) AS INTEGER) END WHEN kind = 'phoenix' THEN gps - {_LEAPS} END AS BIGINT) AS at_s FROM t"))
def file_times_named(spark, sf_dir):
    """Times that the names of data files tell."""
    n = F.col("name")
    return _names(spark, sf_dir).select("id", listing.kind(n).alias("kind"), listing.named_time(n).alias("at_s"))


@query("index_refreshed", sql(PRODUCTS, "f AS (SELECT product || '-' || CAST(period AS BIGINT) AS name, CAST(period AS BIGINT) * 100 AS mtime, CAST(period AS BIGINT) % 7 AS size, zxy_re AS x FROM products)", "SELECT name, CAST(mtime AS BIGINT) AS mtime, CAST(size AS BIGINT) AS size, " + q6("CASE WHEN mtime % 300 = 0 AND mtime % 400 <> 0 THEN x + 1000 WHEN mtime % 500 = 0 THEN NULL ELSE x END", "x") + ", mtime % 300 = 0 AND mtime % 400 <> 0 OR mtime % 500 <> 0 AS read FROM f"))
def index_refreshed(spark, sf_dir):
    """Facts of all products: kept where their file is as indexed, else read again; one in five can't be read."""
    k = F.col("period").cast("long")
    now = products(spark, sf_dir).select(F.concat("product", F.lit("-"), k.cast("string")).alias("name"), (k * 100).alias("mtime"), (k % 7).alias("size"), F.col("zxy_re").alias("x"))
    # A third of the files were indexed, with facts of their own; of these some have changed since.
    old = now.where("mtime % 300 = 0").withColumn("mtime", F.when(F.col("mtime") % 400 == 0, F.col("mtime") - 1).otherwise(F.col("mtime"))).withColumn("x", F.col("x") + 1000)
    out = listing.refreshed(now.drop("x"), old, lambda files: now.join(files.select("name"), "name").where("mtime % 500 <> 0").select("name", "x"))
    return out.select("name", "mtime", "size", r6("x", "x"), "read")


_REPLACED = "sp AS (SELECT DISTINCT site, 'hx' AS channel, site - site % 3 AS donor FROM long_dense WHERE site % 3 <> 0)"


@query("channels_replaced", sql(LONG_DENSE, _REPLACED, "en AS (SELECT site, min(k) AS lo, max(k) + 1 AS hi FROM long_dense GROUP BY 1)", f"SELECT l.site, l.channel, CAST(l.k AS BIGINT) AS k, {q6('x', 'x')} FROM long_dense l LEFT JOIN sp USING (site, channel) WHERE donor IS NULL UNION ALL SELECT sp.site, sp.channel, CAST(l.k AS BIGINT), {q6('x', 'x')} FROM sp JOIN en ON en.site = sp.site JOIN long_dense l ON l.site = donor AND l.channel = sp.channel AND l.k >= lo AND l.k < hi"))
def channels_replaced(spark, sf_dir):
    """A magnetic channel taken from a donor site on the same days."""
    rows = long_dense(spark, sf_dir)
    spec = rows.where("site % 3 <> 0").select("site", F.lit("hx").alias("channel"), (F.col("site") - F.col("site") % 3).alias("donor")).distinct()
    return donors.replaced(rows, spec).select("site", "channel", "k", r6("x", "x"))


# Runs of customers: starts on a grid of ten seconds, some a thousandth off it.
_RUNS = "ru AS (SELECT CAST(o_custkey AS BIGINT) AS site, CAST(o_orderkey AS BIGINT) AS run, CAST(epoch(CAST(o_orderdate AS TIMESTAMP)) AS BIGINT) * 1000000000 + CASE WHEN o_custkey % 11 = 0 THEN 20000000 ELSE 0 END AS start_ns, CAST(1000 + o_orderkey % 5000 AS BIGINT) * 60 AS n FROM orders), pa AS (SELECT DISTINCT site, site + 1 AS donor FROM ru WHERE site % 2 = 0)"
_PIECES = "pc AS (SELECT x.site, x.run, pa.donor, y.run AS donor_run, greatest(0, CAST(round_even((y.start_ns - x.start_ns) / 1e10, 0) AS BIGINT)) AS lo, least(x.n, CAST(round_even((y.start_ns - x.start_ns) / 1e10, 0) AS BIGINT) + y.n) AS hi, CAST(round_even((y.start_ns - x.start_ns) / 1e10, 0) AS BIGINT) AS shift, (y.start_ns - x.start_ns) / 1e10 - round_even((y.start_ns - x.start_ns) / 1e10, 0) AS off_grid FROM ru x JOIN pa ON pa.site = x.site JOIN ru y ON y.site = pa.donor), pk AS (SELECT * FROM pc WHERE hi > lo)"


def _runs(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    start = F.unix_seconds(F.col("o_orderdate").cast("timestamp")) * 1_000_000_000 + F.when(F.col("o_custkey") % 11 == 0, 20_000_000).otherwise(0)
    runs = o.select(F.col("o_custkey").cast("long").alias("site"), F.col("o_orderkey").cast("long").alias("run"), start.alias("start_ns"), ((1000 + F.col("o_orderkey") % 5000) * 60).cast("long").alias("n"))
    return runs, runs.where("site % 2 = 0").select("site", (F.col("site") + 1).alias("donor")).distinct()


@query("pieces_borrowed", sql(_RUNS, _PIECES, f"SELECT site, run, donor, donor_run, lo, hi, shift, {q6('off_grid', 'off_grid')} FROM pk"))
def pieces_borrowed(spark, sf_dir):
    """Pieces of runs for which the donor site has samples."""
    runs, pairs = _runs(spark, sf_dir)
    return donors.borrowed_pieces(runs, runs, pairs, 0.1).select("site", "run", "donor", "donor_run", "lo", "hi", "shift", r6("off_grid", "off_grid"))


@query("donor_cover", sql(_RUNS, _PIECES, "to_ AS (SELECT site, sum(n) AS total FROM ru GROUP BY 1), go AS (SELECT site, sum(hi - lo) AS covered, max(abs(off_grid)) AS off FROM pk GROUP BY 1)", f"SELECT pa.site, pa.donor, CAST(coalesce(covered, 0) AS BIGINT) AS covered, CAST(total AS BIGINT) AS total, {q6('coalesce(covered, 0) / total::DOUBLE', 'share')}, CASE WHEN off > 1e-3 THEN 'off grid' WHEN coalesce(covered, 0) < 0.02 * total THEN 'too little' END AS refused FROM pa JOIN to_ ON to_.site = pa.site LEFT JOIN go ON go.site = pa.site"))
def donor_cover(spark, sf_dir):
    """How much of each site its donor covers, and what forbids it."""
    runs, pairs = _runs(spark, sf_dir)
    out = donors.cover(donors.borrowed_pieces(runs, runs, pairs, 0.1), runs, pairs, 0.02)
    return out.select("site", "donor", "covered", "total", r6("share", "share"), "refused")


@query("second_means", sql(LONG_DENSE, "gp AS (SELECT site, channel, k, x FROM long_dense WHERE NOT (site % 2 = 1 AND k % 50 < 3))", "wh AS (SELECT site, channel, avg(x) AS m, stddev_pop(x) AS sd, quantile_disc(x, 0.5) AS md, min(k) AS lo, max(k) - min(k) + 1 > count(*) AS gaps FROM gp GROUP BY 1, 2)", "se AS (SELECT g.site, g.channel, avg(x) AS v FROM gp g JOIN wh ON wh.site = g.site AND wh.channel = g.channel GROUP BY g.site, g.channel, (k - lo) // 7)", "me AS (SELECT site, channel, avg(v) AS mm, quantile_disc(v, 0.5) AS vd FROM se GROUP BY 1, 2)", f"SELECT wh.site, wh.channel, {q6('abs(mm - m) / sd', 'mean_error')}, {q6('abs(vd - md) / sd', 'median_error')}, abs(mm - m) / sd <= CASE WHEN gaps THEN 0.05 ELSE 0.001 END AS passed FROM wh JOIN me ON me.site = wh.site AND me.channel = wh.channel"))
def second_means(spark, sf_dir):
    """Whether means of blocks of seven days give the mean of each channel."""
    rows = long_dense(spark, sf_dir).where("not (site % 2 = 1 and k % 50 < 3)")
    return donors.block_means_agree(rows, ["site", "channel"], "x", 7, exact=1e-3).select("site", "channel", r6("mean_error", "mean_error"), r6("median_error", "median_error"), "passed")


_POINTS = "po AS (SELECT site, product, period * 1.07 AS period, pow(zxy_re, 2) + pow(zxy_im, 2) AS rho, degrees(atan2(zxy_im, zxy_re)) AS phi, CAST(period AS BIGINT) % 3 AS rate FROM products)"


@query("rate_differences", sql(PRODUCTS, _POINTS, "cu AS (SELECT site, log10(period) AS lp, log10(pow(zxy_re, 2) + pow(zxy_im, 2)) AS r, degrees(atan2(zxy_im, zxy_re)) AS f, lead(log10(period)) OVER w AS lp2, lead(log10(pow(zxy_re, 2) + pow(zxy_im, 2))) OVER w AS r2, lead(degrees(atan2(zxy_im, zxy_re))) OVER w AS f2, row_number() OVER w AS i FROM products WHERE substr(product, 2) = substr(site, 2) WINDOW w AS (PARTITION BY site ORDER BY period))", "fa AS (SELECT p.site, product, rate, abs(CASE WHEN lp2 IS NULL OR log10(period) < lp THEN r ELSE r + (r2 - r) * (log10(period) - lp) / (lp2 - lp) END - log10(rho)) AS r, abs(CASE WHEN lp2 IS NULL OR log10(period) < lp THEN f ELSE f + (f2 - f) * (log10(period) - lp) / (lp2 - lp) END - phi) AS f FROM po p JOIN cu ON cu.site = p.site AND (log10(period) >= lp OR i = 1) AND (lp2 IS NULL OR log10(period) < lp2))", f"SELECT site, rate, count(DISTINCT product) AS n_files, count(*) AS n, {q6('median(r)', 'rho')}, {q6('median(f)', 'phi')} FROM fa GROUP BY GROUPING SETS ((site, rate), (site))"))
def rate_differences(spark, sf_dir):
    """Distance of each site's products from its first one's curve, by rate and over all."""
    p = products(spark, sf_dir)
    rows = p.select("site", F.lit("xy").alias("mode"), "product", "period", (F.col("zxy_re") ** 2 + F.col("zxy_im") ** 2).alias("rho"), F.degrees(F.atan2("zxy_im", "zxy_re")).alias("phi"))
    first = rows.where("substr(product, 2) = substr(site, 2)")
    points = rows.withColumn("rate", F.col("period").cast("long") % 3).withColumn("period", F.col("period") * 1.07)
    out = donors.rate_differences(first, points, ["site"], "product")
    return out.select("site", "rate", "n_files", "n", r6("rho", "rho"), r6("phi", "phi"))
