"""Scoring, choosing and merging transfer-function products; corrections and quality tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from terrawave.functions import cx
from terrawave.operators import levels, space
from terrawave.plans.base import DAILY, HOURLY, LONG, PRODUCTS, daily, hourly, long_daily, products, q6, r6, sql, table
from terrawave.plans.catalog import query

_RHO = "0.2 * period * (zxy_re * zxy_re + zxy_im * zxy_im)"


@query("product_rho_phase", sql(PRODUCTS, f"SELECT product, period, {q6(_RHO, 'rho')}, {q6('degrees(atan2(zxy_im, zxy_re))', 'phase')}, {q6(f'2 * ({_RHO}) * zxy_err / sqrt(zxy_re * zxy_re + zxy_im * zxy_im)', 'rho_err')}, {q6('degrees(zxy_err / sqrt(zxy_re * zxy_re + zxy_im * zxy_im))', 'phase_err')} FROM products"))
def product_rho_phase(spark, sf_dir):
    """Apparent resistivity, phase and their errors of each product row."""
    p2 = F.col("zxy_re") * F.col("zxy_re") + F.col("zxy_im") * F.col("zxy_im")
    rho = 0.2 * F.col("period") * p2
    return products(spark, sf_dir).select("product", "period", r6(rho, "rho"), r6(F.degrees(F.atan2("zxy_im", "zxy_re")), "phase"), r6(2 * rho * F.col("zxy_err") / F.sqrt(p2), "rho_err"), r6(F.degrees(F.col("zxy_err") / F.sqrt(p2)), "phase_err"))


_WRAP = "({d}) - 360 * ceil(({d}) / 360 - 0.5)"


@query("mode_phase", sql(PRODUCTS, f"SELECT product, period, {q6(_WRAP.format(d='degrees(atan2(zyx_im, zyx_re)) + 180'), 'phase_yx')} FROM products"))
def mode_phase(spark, sf_dir):
    """The yx phase turned by 180 degrees onto the display branch."""
    return products(spark, sf_dir).select("product", "period", r6(cx.wrap(F.degrees(F.atan2("zyx_im", "zyx_re")) + 180), "phase_yx"))


@query("product_quality", sql(PRODUCTS, "s AS (SELECT product, period, abs(zxy_re) + abs(zxy_im) AS a, log10(zxy_re * zxy_re + zxy_im * zxy_im) AS l, degrees(atan2(zxy_im, zxy_re)) AS ph, zxy_err / sqrt(zxy_re * zxy_re + zxy_im * zxy_im) AS rel FROM products)", "t AS (SELECT *, abs(l - lag(l) OVER (PARTITION BY product ORDER BY period)) AS step FROM s)", f"SELECT product, CAST(count(*) AS BIGINT) AS n, {q6('avg(CASE WHEN ph >= 0 AND ph <= 90 THEN 1.0::DOUBLE ELSE 0 END)', 'quadrant')}, {q6('exp(-pow(median(step) / 0.25, 2))', 'smooth')}, {q6('median(rel)', 'error')}, CAST(sum(CASE WHEN step > 0.02 THEN 1 ELSE 0 END) AS BIGINT) AS blow_ups FROM t GROUP BY product"))
def product_quality(spark, sf_dir):
    """Quadrant share, smoothness, error and blow-ups of each product."""
    p2 = F.col("zxy_re") * F.col("zxy_re") + F.col("zxy_im") * F.col("zxy_im")
    s = products(spark, sf_dir).select("product", "period", F.log10(p2).alias("l"), F.degrees(F.atan2("zxy_im", "zxy_re")).alias("ph"), (F.col("zxy_err") / F.sqrt(p2)).alias("rel"))
    s = s.withColumn("step", F.abs(F.col("l") - F.lag("l").over(Window.partitionBy("product").orderBy("period"))))
    inside = ((F.col("ph") >= 0) & (F.col("ph") <= 90)).cast("double")
    return s.groupBy("product").agg(F.count("*").alias("n"), r6(F.avg(inside), "quadrant"), r6(F.exp(-F.pow(F.percentile("step", F.lit(0.5)) / 0.25, F.lit(2))), "smooth"), r6(F.percentile("rel", F.lit(0.5)), "error"), F.count_if(F.col("step") > 0.02).alias("blow_ups"))


_AGREE = "p AS (SELECT product, period, log10(zxy_re * zxy_re + zxy_im * zxy_im) AS l, degrees(atan2(zxy_im, zxy_re)) AS ph FROM products)"


@query("product_agreement", sql(PRODUCTS, _AGREE, f"SELECT x.product AS one, y.product AS other, CAST(count(*) AS BIGINT) AS n, {q6('median(abs(x.l - y.l))', 'd_log_rho')}, {q6('median(abs(' + _WRAP.format(d='x.ph - y.ph') + '))', 'd_phase')} FROM p x JOIN p y ON x.product < y.product AND abs(x.period / y.period - 1) <= 0.02 GROUP BY x.product, y.product"))
def product_agreement(spark, sf_dir):
    """Median differences of products on matched periods; matches meet in buckets of log period."""
    p = products(spark, sf_dir).select("product", "period", F.log10(F.col("zxy_re") * F.col("zxy_re") + F.col("zxy_im") * F.col("zxy_im")).alias("l"), F.degrees(F.atan2("zxy_im", "zxy_re")).alias("ph"))
    bucket = F.floor(F.log(F.col("period")) / 0.05)
    x = p.select(*(F.col(c).alias(f"x_{c}") for c in p.columns), F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("bucket"))
    y = p.select(*(F.col(c).alias(f"y_{c}") for c in p.columns), bucket.alias("bucket"))
    both = x.join(y, "bucket").where((F.col("x_product") < F.col("y_product")) & cx.near_period(F.col("x_period"), F.col("y_period"), 0.02))
    return both.groupBy(F.col("x_product").alias("one"), F.col("y_product").alias("other")).agg(F.count("*").alias("n"), r6(F.percentile(F.abs(F.col("x_l") - F.col("y_l")), F.lit(0.5)), "d_log_rho"), r6(F.percentile(F.abs(cx.wrap(F.col("x_ph") - F.col("y_ph"))), F.lit(0.5)), "d_phase"))


@query("best_product_per_site", sql(PRODUCTS, "e AS (SELECT site, product, median(zxy_err / sqrt(zxy_re * zxy_re + zxy_im * zxy_im)) AS err, count(*) AS n FROM products GROUP BY site, product)", f"SELECT site, product, {q6('err', 'error')} FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY round(err, 9), product) AS r FROM e WHERE n >= 10) WHERE r = 1"))
def best_product_per_site(spark, sf_dir):
    """Each site's product of least error among those with enough periods."""
    e = products(spark, sf_dir).groupBy("site", "product").agg(F.percentile(F.col("zxy_err") / F.sqrt(F.col("zxy_re") * F.col("zxy_re") + F.col("zxy_im") * F.col("zxy_im")), F.lit(0.5)).alias("err"), F.count("*").alias("n"))
    best = e.where("n >= 10").withColumn("r", F.row_number().over(Window.partitionBy("site").orderBy(F.round("err", 9), "product"))).where("r = 1")
    return best.select("site", "product", r6("err", "error"))


@query("merge_first_usable", sql(PRODUCTS, "c AS (SELECT site, period, product, zxy_re, zxy_im, row_number() OVER (PARTITION BY site, period ORDER BY product) AS r FROM products WHERE zxy_err < 0.07 AND ((product IN ('P0', 'P1', 'P2', 'P3') AND period <= 30) OR product IN ('P4', 'P5', 'P6', 'P7')))", f"SELECT site, period, product AS source, {q6('zxy_re', 'zxy_re')}, {q6('zxy_im', 'zxy_im')} FROM c WHERE r = 1"))
def merge_first_usable(spark, sf_dir):
    """Best-of merge: at each period the first source in order whose range covers it with a usable value."""
    ok = products(spark, sf_dir).where("zxy_err < 0.07 and ((product in ('P0', 'P1', 'P2', 'P3') and period <= 30) or product in ('P4', 'P5', 'P6', 'P7'))")
    best = ok.groupBy("site", "period").agg(F.min_by(F.struct("product", "zxy_re", "zxy_im"), "product").alias("s"))
    return best.select("site", "period", F.col("s.product").alias("source"), r6("s.zxy_re", "zxy_re"), r6("s.zxy_im", "zxy_im"))


@query("merge_at_crossover", sql(PRODUCTS, "t AS (SELECT site, max(CASE WHEN product < 'P4' AND zxy_err < 0.07 THEN period END) AS t FROM products WHERE period <= 25 GROUP BY site)", f"SELECT p.site, p.period, p.product AS source, {q6('zxy_re', 'zxy_re')} FROM products p JOIN t ON p.site = t.site WHERE (p.product < 'P4' AND p.period <= t.t) OR (p.product >= 'P4' AND p.period > t.t)"))
def merge_at_crossover(spark, sf_dir):
    """A short source up to a crossover period and a long source beyond it."""
    p = products(spark, sf_dir)
    t = p.where("period <= 25").groupBy("site").agg(F.max(F.when((F.col("product") < "P4") & (F.col("zxy_err") < 0.07), F.col("period"))).alias("t"))
    return p.join(t, "site").where("(product < 'P4' and period <= t) or (product >= 'P4' and period > t)").select("site", "period", F.col("product").alias("source"), r6("zxy_re", "zxy_re"))


@query("merge_modes", sql(PRODUCTS, f"SELECT x.site, x.period, {q6('x.zxy_re', 'zxy_re')}, {q6('x.zxy_im', 'zxy_im')}, {q6('y.zyx_re', 'zyx_re')}, {q6('y.zyx_im', 'zyx_im')} FROM products x JOIN products y ON x.site = y.site AND x.product < 'P4' AND y.product >= 'P4' AND x.period = y.period"))
def merge_modes(spark, sf_dir):
    """The x row of one product with the y row of another on shared periods."""
    p = products(spark, sf_dir)
    x = p.where("product < 'P4'").select("site", "period", "zxy_re", "zxy_im")
    y = p.where("product >= 'P4'").select("site", "period", "zyx_re", "zyx_im")
    return x.join(y, ["site", "period"]).select("site", "period", *(r6(c, c) for c in ("zxy_re", "zxy_im", "zyx_re", "zyx_im")))


@query("band_choice", sql(PRODUCTS, "b AS (SELECT site, product, CAST(floor(log10(period) * 4) AS BIGINT) AS band, avg(zxy_err / sqrt(zxy_re * zxy_re + zxy_im * zxy_im)) AS err, count(*) AS n FROM products GROUP BY 1, 2, 3)", f"SELECT site, band, product, CAST(n AS BIGINT) AS n, {q6('err', 'error')} FROM (SELECT *, row_number() OVER (PARTITION BY site, band ORDER BY round(err, 9), product) AS r FROM b) WHERE r = 1"))
def band_choice(spark, sf_dir):
    """In each quarter decade of period the candidate of least relative error."""
    b = products(spark, sf_dir).groupBy("site", "product", cx.quarter_decade(F.col("period")).alias("band")).agg(F.avg(F.col("zxy_err") / F.sqrt(F.col("zxy_re") * F.col("zxy_re") + F.col("zxy_im") * F.col("zxy_im"))).alias("err"), F.count("*").alias("n"))
    best = b.withColumn("r", F.row_number().over(Window.partitionBy("site", "band").orderBy(F.round("err", 9), "product"))).where("r = 1")
    return best.select("site", "band", "product", "n", r6("err", "error"))


@query("bad_rows_blanked", sql(PRODUCTS, "f AS (SELECT product, period, CASE WHEN zxy_err > 0 AND zxy_err < 0.062 THEN zxy_re END AS x, CASE WHEN zyx_err > 0 AND zyx_err < 0.0535 THEN zyx_re END AS y FROM products)", f"SELECT product, period, {q6('x', 'zxy_re')}, {q6('y', 'zyx_re')} FROM f WHERE x IS NOT NULL OR y IS NOT NULL"))
def bad_rows_blanked(spark, sf_dir):
    """Rows with unusable errors blanked; periods without any row dropped."""
    p = products(spark, sf_dir).select("product", "period", F.when(F.expr("zxy_err > 0 and zxy_err < 0.062"), F.col("zxy_re")).alias("x"), F.when(F.expr("zyx_err > 0 and zyx_err < 0.0535"), F.col("zyx_re")).alias("y"))
    return p.where("x is not null or y is not null").select("product", "period", r6("x", "zxy_re"), r6("y", "zyx_re"))


@query("overlap_z_test", sql(PRODUCTS, "z AS (SELECT x.site, x.period, abs(x.zxy_re - y.zxy_re) / sqrt(x.zxy_err * x.zxy_err + y.zxy_err * y.zxy_err) AS z FROM products x JOIN products y ON x.site = y.site AND x.product < 'P4' AND y.product >= 'P4' AND x.period = y.period)", f"SELECT site, CAST(count(*) AS BIGINT) AS n, {q6('max(z)', 'worst')}, max(z) > 2 AS fails FROM z GROUP BY site"))
def overlap_z_test(spark, sf_dir):
    """z of the difference of two products on shared bands; a site fails beyond 2."""
    p = products(spark, sf_dir)
    x = p.where("product < 'P4'").select("site", "period", F.col("zxy_re").alias("a"), F.col("zxy_err").alias("ea"))
    y = p.where("product >= 'P4'").select("site", "period", F.col("zxy_re").alias("b"), F.col("zxy_err").alias("eb"))
    z = F.abs(F.col("a") - F.col("b")) / F.sqrt(F.col("ea") * F.col("ea") + F.col("eb") * F.col("eb"))
    return x.join(y, ["site", "period"]).groupBy("site").agg(F.count("*").alias("n"), r6(F.max(z), "worst"), (F.max(z) > 2).alias("fails"))


@query("score_matrix", sql(PRODUCTS, f"SELECT site, {', '.join(q6(f'avg(CASE WHEN product = {chr(39)}P{i}{chr(39)} THEN zxy_err END)', f'P{i}') for i in range(8))} FROM products GROUP BY site"))
def score_matrix(spark, sf_dir):
    """Site by product matrix of mean errors."""
    m = products(spark, sf_dir).groupBy("site").pivot("product", [f"P{i}" for i in range(8)]).agg(F.avg("zxy_err"))
    return m.select("site", *(r6(f"P{i}", f"P{i}") for i in range(8)))


@query("rotation_fixed", sql(DAILY, f"SELECT site, CAST(k AS BIGINT) AS k, {q6('cos(radians(30)) * hx + sin(radians(30)) * hy', 'hx')}, {q6('-sin(radians(30)) * hx + cos(radians(30)) * hy', 'hy')} FROM daily"))
def rotation_fixed(spark, sf_dir):
    """Horizontal field turned by 30 degrees."""
    c, s = F.cos(F.radians(F.lit(30.0))), F.sin(F.radians(F.lit(30.0)))
    return daily(spark, sf_dir).select("site", "k", r6(c * F.col("hx") + s * F.col("hy"), "hx"), r6(-s * F.col("hx") + c * F.col("hy"), "hy"))


@query("sign_and_swap", sql(LONG, f"SELECT site, CASE channel WHEN 'ex' THEN 'ey' WHEN 'ey' THEN 'ex' ELSE channel END AS channel, CAST(k AS BIGINT) AS k, {q6('CASE WHEN channel IN (' + chr(39) + 'hx' + chr(39) + ', ' + chr(39) + 'ey' + chr(39) + ') THEN -x ELSE x END', 'x')} FROM long_daily"))
def sign_and_swap(spark, sf_dir):
    """Reversed channels flipped, electric lines exchanged."""
    swap = F.when(F.col("channel") == "ex", "ey").when(F.col("channel") == "ey", "ex").otherwise(F.col("channel"))
    return long_daily(spark, sf_dir).select("site", swap.alias("channel"), "k", r6(F.when(F.col("channel").isin("hx", "ey"), -F.col("x")).otherwise(F.col("x")), "x"))


@query("mean_field_angle", sql(DAILY, f"SELECT site, {q6('degrees(atan2(avg(hy), avg(hx)))', 'angle')} FROM daily GROUP BY site"))
def mean_field_angle(spark, sf_dir):
    """Angle of the mean horizontal field."""
    return daily(spark, sf_dir).groupBy("site").agg(r6(F.degrees(F.atan2(F.avg("hy"), F.avg("hx"))), "angle"))


@query("channel_stats", sql(HOURLY, "m AS (SELECT site, channel, median(x) AS med FROM hourly GROUP BY 1, 2)", "d AS (SELECT h.site, h.channel, h.x, m.med, abs(h.x - m.med) AS dev FROM hourly h JOIN m ON h.site = m.site AND h.channel = m.channel)", "s AS (SELECT site, channel, median(dev) * 1.4826 AS mad FROM d GROUP BY 1, 2)", f"SELECT d.site, d.channel, CAST(count(*) AS BIGINT) AS n, {q6('max(med)', 'median')}, {q6('max(mad)', 'mad')}, {q6('quantile_cont(x, 0.05)', 'p5')}, {q6('quantile_cont(x, 0.95)', 'p95')}, {q6('avg(CASE WHEN round(dev, 9) > round(3 * mad, 9) THEN 1.0::DOUBLE ELSE 0 END)', 'beyond')} FROM d JOIN s ON d.site = s.site AND d.channel = s.channel GROUP BY d.site, d.channel"))
def channel_stats(spark, sf_dir):
    """Median, MAD, percentiles and the share beyond three MAD of each channel."""
    out = levels.channel_stats(hourly(spark, sf_dir), ["site", "channel"])
    return out.select("site", "channel", "n", *(r6(c, c) for c in ("median", "mad", "p5", "p95", "beyond")))


@query("block_reduction", sql(LONG, f"SELECT site, channel, CAST(k // 16 AS BIGINT) AS block, {q6('avg(x)', 'mean')}, {q6('min(x)', 'least')}, {q6('max(x)', 'most')} FROM long_daily GROUP BY site, channel, k // 16 HAVING count(*) = 16"))
def block_reduction(spark, sf_dir):
    """Mean, least and most of whole blocks."""
    g = long_daily(spark, sf_dir).groupBy("site", "channel", F.floor(F.col("k") / 16).alias("block")).agg(F.count("*").alias("n"), F.avg("x").alias("a"), F.min("x").alias("b"), F.max("x").alias("c"))
    return g.where("n = 16").select("site", "channel", "block", r6("a", "mean"), r6("b", "least"), r6("c", "most"))


@query("cycle_stack_subtracted", sql(LONG, "c AS (SELECT site, channel, k, x, k // 280 AS win, k % 7 AS phase FROM long_daily)", "w AS (SELECT site, channel, win, (max(k) - min(k) + 1) // 7 AS cycles FROM c GROUP BY ALL)", "m AS (SELECT site, channel, win, phase, median(x) AS med FROM c GROUP BY ALL)", "z AS (SELECT site, channel, win, median(med) AS mid FROM m GROUP BY ALL)", f"SELECT c.site, c.channel, CAST(c.k AS BIGINT) AS k, {q6('CASE WHEN w.cycles >= 5 THEN c.x - (m.med - z.mid) ELSE c.x END', 'x')} FROM c JOIN m ON c.site = m.site AND c.channel = m.channel AND c.win = m.win AND c.phase = m.phase JOIN z ON c.site = z.site AND c.channel = z.channel AND c.win = z.win JOIN w ON c.site = w.site AND c.channel = w.channel AND c.win = w.win"))
def cycle_stack_subtracted(spark, sf_dir):
    """A periodic disturbance removed: the median cycle of each window, less its own median; a window of fewer than five cycles stays."""
    c = long_daily(spark, sf_dir).withColumn("win", F.floor(F.col("k") / 280)).withColumn("phase", F.col("k") % 7)
    m = c.groupBy("site", "channel", "win", "phase").agg(F.percentile("x", F.lit(0.5)).alias("med"), F.min("k").alias("lo"), F.max("k").alias("hi"))
    z = m.groupBy("site", "channel", "win").agg(F.percentile("med", F.lit(0.5)).alias("mid"), F.expr("(max(hi) - min(lo) + 1) div 7").alias("cycles"))
    out = c.join(m.drop("lo", "hi"), ["site", "channel", "win", "phase"]).join(z, ["site", "channel", "win"])
    return out.select("site", "channel", "k", r6(F.when(F.col("cycles") >= 5, F.col("x") - (F.col("med") - F.col("mid"))).otherwise(F.col("x")), "x"))


@query("lag_correlation", sql(DAILY, "l AS (SELECT unnest(range(-5, 6)) AS lag)", "c AS (SELECT a.site, l.lag, corr(a.hx, b.rx) AS r, count(*) AS n FROM daily a CROSS JOIN l JOIN daily b ON a.site = b.site AND b.k = a.k + l.lag GROUP BY a.site, l.lag)", f"SELECT site, CAST(lag AS INTEGER) AS lag, CAST(n AS BIGINT) AS n, {q6('r', 'r')} FROM c"))
def lag_correlation(spark, sf_dir):
    """Cross-correlation of two channels over lags, for clock offsets."""
    d = daily(spark, sf_dir)
    a = d.select("site", "k", "hx", F.explode(F.sequence(F.lit(-5), F.lit(5))).alias("lag")).withColumn("at", F.col("k") + F.col("lag"))
    both = a.join(d.select("site", F.col("k").alias("at"), "rx"), ["site", "at"])
    return both.groupBy("site", "lag").agg(F.count("*").alias("n"), r6(F.corr("hx", "rx"), "r"))


@query("weekly_health", sql(DAILY, "w AS (SELECT site, k // 7 AS week, avg(sqrt(hx * hx + hy * hy + hz * hz)) AS f, avg(ex) AS ex, count(*) AS n FROM daily GROUP BY 1, 2)", "m AS (SELECT site, median(f) AS mf FROM w GROUP BY site)", f"SELECT w.site, CAST(week AS BIGINT) AS week, CAST(n AS BIGINT) AS n, {q6('f', 'field')}, {q6('f / mf', 'ratio')}, round(f / mf, 9) BETWEEN 0.5 AND 1.5 AS sound FROM w JOIN m ON w.site = m.site"))
def weekly_health(spark, sf_dir):
    """Weekly total field against the site's median, with a verdict."""
    w = daily(spark, sf_dir).groupBy("site", F.floor(F.col("k") / 7).alias("week")).agg(F.avg(F.sqrt(F.col("hx") * F.col("hx") + F.col("hy") * F.col("hy") + F.col("hz") * F.col("hz"))).alias("f"), F.count("*").alias("n"))
    m = w.groupBy("site").agg(F.percentile("f", F.lit(0.5)).alias("mf"))
    ratio = F.col("f") / F.col("mf")
    return w.join(m, "site").select("site", "week", "n", r6("f", "field"), r6(ratio, "ratio"), F.round(ratio, 9).between(0.5, 1.5).alias("sound"))


@query("longest_sound_weeks", sql(DAILY, "w AS (SELECT site, k // 7 AS week, avg(sqrt(hx * hx + hy * hy + hz * hz)) AS f FROM daily GROUP BY 1, 2)", "m AS (SELECT site, median(f) AS mf FROM w GROUP BY site)", "g AS (SELECT w.site, week, week - row_number() OVER (PARTITION BY w.site ORDER BY week) AS g FROM w JOIN m ON w.site = m.site WHERE round(f / mf, 9) BETWEEN 0.8 AND 1.2)", "r AS (SELECT site, min(week) AS a, max(week) + 1 AS b FROM g GROUP BY site, g)", "SELECT site, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY b - a DESC, a) AS n FROM r) WHERE n = 1"))
def longest_sound_weeks(spark, sf_dir):
    """The longest run of consecutive sound weeks of each site."""
    from terrawave.operators import intervals as iv

    w = weekly_health(spark, sf_dir).where(F.round("ratio", 9).between(0.8, 1.2))
    r = iv.islands(w, ["site"], "week").withColumn("n", F.row_number().over(Window.partitionBy("site").orderBy(F.desc(F.col("b") - F.col("a")), "a")))
    return r.where("n = 1").select("site", "a", "b")


@query("nearest_sites", sql("s AS (SELECT s_suppkey AS id, (s_suppkey * 37 % 120) - 60 + 0.25 AS lat, (s_suppkey * 53 % 300) - 150 + 0.5 AS lon FROM supplier)", "p AS (SELECT x.id, y.id AS other, 2 * 6371.0088 * asin(sqrt(pow(sin(radians(y.lat - x.lat) / 2), 2) + cos(radians(x.lat)) * cos(radians(y.lat)) * pow(sin(radians(y.lon - x.lon) / 2), 2))) AS km FROM s x JOIN s y ON x.id <> y.id)", f"SELECT CAST(id AS BIGINT) AS id, CAST(other AS BIGINT) AS other, {q6('km', 'km')} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(km, 6), other) AS r FROM p) WHERE r <= 3"))
def nearest_sites(spark, sf_dir):
    """The three nearest sites of each site, by great-circle distance."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") * 37 % 120 - 60 + 0.25).alias("lat"), (F.col("s_suppkey") * 53 % 300 - 150 + 0.5).alias("lon"))
    return space.nearest(s, 3).select("id", "other", r6("km", "km"))
