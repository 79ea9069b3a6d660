"""Quality tables of samples and files, pair tables, and small network tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from terrawave.functions import cx
from terrawave.operators import spectra
from terrawave.operators.order import ranked
from terrawave.plans.base import DAILY, HOURLY, LONG, MASKS, PRODUCTS, SPANS, daily, hourly, long_daily, masks, products, q6, r6, spans, sql, table
from terrawave.plans.catalog import query
from terrawave.plans.transfer import _spec_sql, spectrum

_S = ["site", "channel"]


@query("cogrid_pivot", sql(HOURLY, "SELECT site, CAST(k AS BIGINT) AS k, " + ", ".join(q6(f"max(CASE WHEN channel = '{c}' THEN x END)", c) for c in ("hx", "hy", "hz", "ex", "ey")) + " FROM hourly GROUP BY site, k"))
def cogrid_pivot(spark, sf_dir):
    """Channels of a site on one grid, without a join."""
    names = ["hx", "hy", "hz", "ex", "ey"]
    return hourly(spark, sf_dir).groupBy("site", "k").pivot("channel", names).agg(F.max("x")).select("site", "k", *(r6(c, c) for c in names))


@query("complete_hours", sql(HOURLY, "SELECT site, CAST(k AS BIGINT) AS k FROM hourly GROUP BY site, k HAVING count(DISTINCT channel) = 5"))
def complete_hours(spark, sf_dir):
    """Stamps that all channels of a site share."""
    return hourly(spark, sf_dir).groupBy("site", "k").agg(F.countDistinct("channel").alias("n")).where("n = 5").select("site", "k")


@query("incomplete_stamps", sql(HOURLY, "SELECT site, CAST(k AS BIGINT) AS k, string_agg(channel, ',' ORDER BY channel) AS held FROM hourly GROUP BY site, k HAVING count(*) < 3"))
def incomplete_stamps(spark, sf_dir):
    """Stamps with fewer than three channels, and those that they hold."""
    g = hourly(spark, sf_dir).groupBy("site", "k").agg(F.count("*").alias("n"), F.concat_ws(",", F.array_sort(F.collect_list("channel"))).alias("held"))
    return g.where("n < 3").select("site", "k", "held")


_RUNS = """f AS (SELECT site, a, b, a - lag(a) OVER (PARTITION BY site ORDER BY a, run_id) AS d, row_number() OVER (PARTITION BY site ORDER BY a, run_id) AS i FROM spans),
m AS (SELECT site, median(d) AS m FROM f GROUP BY site)"""


@query("file_runs", sql(SPANS, _RUNS, "g AS (SELECT f.site, a, b, sum(CASE WHEN d = m THEN 0 ELSE 1 END) OVER (PARTITION BY f.site ORDER BY i) AS run FROM f JOIN m ON f.site = m.site)", "SELECT site, CAST(run AS BIGINT) AS run, CAST(min(a) AS BIGINT) AS a, CAST(max(b) AS BIGINT) AS b, CAST(count(*) AS BIGINT) AS files FROM g GROUP BY site, run"))
def file_runs(spark, sf_dir):
    """Files grouped into runs: a step of the site's median spacing goes on, any other begins a run."""
    w = Window.partitionBy("site").orderBy("a", "run_id")
    f = spans(spark, sf_dir).withColumn("d", F.col("a") - F.lag("a").over(w)).withColumn("i", F.row_number().over(w))
    m = f.groupBy("site").agg(F.percentile("d", F.lit(0.5)).alias("m"))
    new = F.when(F.col("d") == F.col("m"), 0).otherwise(1)
    g = f.join(m, "site").withColumn("run", F.sum(new).over(Window.partitionBy("site").orderBy("i")))
    return g.groupBy("site", "run").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.count("*").alias("files"))


@query("spacing_anomalies", sql(SPANS, _RUNS, "SELECT f.site, CAST(a AS BIGINT) AS a, CAST(d AS BIGINT) AS spacing, " + q6("m", "usual") + " FROM f JOIN m ON f.site = m.site WHERE d > 3 * m"))
def spacing_anomalies(spark, sf_dir):
    """Files that follow after more than three times the site's median spacing."""
    w = Window.partitionBy("site").orderBy("a", "run_id")
    f = spans(spark, sf_dir).withColumn("d", F.col("a") - F.lag("a").over(w))
    m = f.groupBy("site").agg(F.percentile("d", F.lit(0.5)).alias("m"))
    return f.join(m, "site").where("d > 3 * m").select("site", "a", F.col("d").alias("spacing"), r6("m", "usual"))


@query("diurnal_table", sql(HOURLY, "s AS (SELECT site, channel, k % 24 AS hour, median(x) AS m FROM hourly GROUP BY 1, 2, 3)", f"SELECT channel, CAST(hour AS BIGINT) AS hour, {q6('median(m)', 'level')} FROM s GROUP BY channel, hour"))
def diurnal_table(spark, sf_dir):
    """Median over sites of each site's median by hour of the day."""
    s = hourly(spark, sf_dir).groupBy("site", "channel", (F.col("k") % 24).alias("hour")).agg(F.percentile("x", F.lit(0.5)).alias("m"))
    return s.groupBy("channel", "hour").agg(r6(F.percentile("m", F.lit(0.5)), "level"))


@query("site_pairs_on_common_hours", sql(HOURLY, f"SELECT a.channel, a.site AS one, b.site AS other, CAST(count(*) AS BIGINT) AS hours, {q6('corr(a.x, b.x)', 'r')} FROM hourly a JOIN hourly b ON a.channel = b.channel AND a.k = b.k AND a.site < b.site GROUP BY 1, 2, 3"))
def site_pairs_on_common_hours(spark, sf_dir):
    """Correlation of site pairs over the hours they share."""
    h = hourly(spark, sf_dir)
    both = h.select("channel", "k", F.col("site").alias("one"), F.col("x").alias("x1")).join(h.select("channel", "k", F.col("site").alias("other"), F.col("x").alias("x2")), ["channel", "k"]).where("one < other")
    return both.groupBy("channel", "one", "other").agg(F.count("*").alias("hours"), r6(F.corr("x1", "x2"), "r"))


_PSD = "psd AS (SELECT site, h, 10 * log10(avg(hx_re * hx_re + hx_im * hx_im)) AS db FROM spec GROUP BY site, h)"


@query("narrow_lines", sql(DAILY, _spec_sql(["hx"]), _PSD, "e AS (SELECT site, h, db, db - median(db) OVER (PARTITION BY site ORDER BY h ROWS BETWEEN 8 PRECEDING AND 8 FOLLOWING) AS excess, lag(db) OVER (PARTITION BY site ORDER BY h) AS p, lead(db) OVER (PARTITION BY site ORDER BY h) AS n FROM psd)", f"SELECT site, CAST(h AS INTEGER) AS h, {q6('excess', 'excess_db')} FROM e WHERE db > p AND db > n AND round(excess, 9) >= 0.5"))
def narrow_lines(spark, sf_dir):
    """Local peaks of the mean spectrum over the running median floor."""
    psd = spectrum(spark, sf_dir, ["hx"]).groupBy("site", "h").agg((10 * F.log10(F.avg(F.col("hx_re") * F.col("hx_re") + F.col("hx_im") * F.col("hx_im")))).alias("db"))
    w = Window.partitionBy("site").orderBy("h")
    e = psd.select("site", "h", "db", (F.col("db") - F.percentile("db", F.lit(0.5)).over(w.rowsBetween(-8, 8))).alias("excess"), F.lag("db").over(w).alias("p"), F.lead("db").over(w).alias("n"))
    return e.where((F.col("db") > F.col("p")) & (F.col("db") > F.col("n")) & (F.round("excess", 9) >= 0.5)).select("site", "h", r6("excess", "excess_db"))


@query("density_by_log_bin", sql(DAILY, _spec_sql(["hx"]), f"SELECT site, CAST(floor(log10(128.0 / h) * 10) AS BIGINT) AS bin, CAST(count(*) AS BIGINT) AS n, {q6('avg(2 * (hx_re * hx_re + hx_im * hx_im) / 48.0) / 1000', 'density')} FROM spec GROUP BY 1, 2"))
def density_by_log_bin(spark, sf_dir):
    """One-sided density averaged in bins of log period."""
    power = 2 * (F.col("hx_re") * F.col("hx_re") + F.col("hx_im") * F.col("hx_im")) / float((spectra.hann(128) ** 2).sum())
    return spectrum(spark, sf_dir, ["hx"]).groupBy("site", F.floor(F.log10(128.0 / F.col("h")) * 10).alias("bin")).agg(F.count("*").alias("n"), r6(F.avg(power) / 1000, "density"))


@query("masks_retired", sql(MASKS, "SELECT site, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b, found_by, found_by IN ('polar', 'cluster') AND pmin IS NULL AS retired FROM masks"))
def masks_retired(spark, sf_dir):
    """Masks with those a selector retires marked, for a write to history."""
    return masks(spark, sf_dir).select("site", "a", "b", "found_by", (F.col("found_by").isin("polar", "cluster") & F.col("pmin").isNull()).alias("retired"))


@query("mask_coverage", sql(MASKS, "SELECT site, found_by, CAST(count(*) AS BIGINT) AS masks, CAST(sum(b - a) AS BIGINT) AS hours FROM masks GROUP BY ROLLUP (site, found_by)"))
def mask_coverage(spark, sf_dir):
    """Masks and hours by site and origin, with totals."""
    return masks(spark, sf_dir).rollup("site", "found_by").agg(F.count("*").alias("masks"), F.sum(F.col("b") - F.col("a")).alias("hours"))


_EDGES = "edges AS (SELECT a.l_suppkey % 12 AS one, b.l_suppkey % 12 AS other, avg(a.l_discount - b.l_discount) * 400 AS psi, count(*) AS n FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey % 12 < b.l_suppkey % 12 GROUP BY 1, 2)"


def edges(spark, sf_dir):
    """one, other, psi (degrees), n: phase differences of supplier groups that share orders."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_suppkey") % 12).alias("s"), "l_discount")
    a, b = rows.select("l_orderkey", F.col("s").alias("one"), F.col("l_discount").alias("x")), rows.select("l_orderkey", F.col("s").alias("other"), F.col("l_discount").alias("y"))
    return a.join(b, "l_orderkey").where("one < other").groupBy("one", "other").agg((F.avg(F.col("x") - F.col("y")) * 400).alias("psi"), F.count("*").alias("n"))


@query("gauge_rank", sql(_EDGES, "e AS (SELECT one AS s, other AS p, n FROM edges UNION ALL SELECT other, one, n FROM edges)", "g AS (SELECT s, sum(n) AS n, count(DISTINCT p) AS partners FROM e GROUP BY s)", "SELECT CAST(s AS BIGINT) AS site, CAST(n AS BIGINT) AS equations, CAST(partners AS BIGINT) AS partners, CAST(row_number() OVER (ORDER BY n DESC, partners DESC, s) AS BIGINT) AS place FROM g"))
def gauge_rank(spark, sf_dir):
    """Sites of the pair graph by equations and partners."""
    e = edges(spark, sf_dir)
    both = e.select(F.col("one").alias("site"), F.col("other").alias("p"), "n").unionByName(e.select(F.col("other").alias("site"), F.col("one").alias("p"), "n"))
    g = both.groupBy("site").agg(F.sum("n").alias("equations"), F.countDistinct("p").alias("partners"))
    return ranked(g, [F.desc("equations"), F.desc("partners"), F.asc("site")], "place")


@query("circular_band_reading", sql(_EDGES, f"SELECT CAST(one AS BIGINT) AS site, CAST(sum(n) AS BIGINT) AS n, {q6('degrees(atan2(sum(n * sin(radians(2 * psi))), sum(n * cos(radians(2 * psi))))) / 2', 'psi')} FROM edges GROUP BY one"))
def circular_band_reading(spark, sf_dir):
    """Weighted circular mean, modulo 180 degrees, of each site's phases."""
    angle = F.radians(2 * F.col("psi"))
    return edges(spark, sf_dir).groupBy(F.col("one").alias("site")).agg(F.sum("n").alias("n"), r6(F.degrees(F.atan2(F.sum(F.col("n") * F.sin(angle)), F.sum(F.col("n") * F.cos(angle)))) / 2, "psi"))


@query("loop_closures", sql(_EDGES, f"SELECT CAST(a.one AS BIGINT) AS one, CAST(a.other AS BIGINT) AS other, CAST(b.other AS BIGINT) AS third, {q6('a.psi + b.psi - c.psi - 180 * ceil((a.psi + b.psi - c.psi) / 180 - 0.5)', 'closure')} FROM edges a JOIN edges b ON a.other = b.one JOIN edges c ON c.one = a.one AND c.other = b.other"))
def loop_closures(spark, sf_dir):
    """Closure of each triangle of the pair graph, modulo 180 degrees."""
    e = edges(spark, sf_dir)
    a = e.select("one", "other", F.col("psi").alias("p"))
    b = e.select(F.col("one").alias("other"), F.col("other").alias("third"), F.col("psi").alias("q"))
    c = e.select("one", F.col("other").alias("third"), F.col("psi").alias("r"))
    return a.join(b, "other").join(c, ["one", "third"]).select("one", "other", "third", r6(cx.wrap(F.col("p") + F.col("q") - F.col("r"), 180.0), "closure"))


@query("rotation_fit", sql(DAILY, f"SELECT site, {q6('degrees(atan2(sum(ex * hy - ey * hx), sum(ex * hx + ey * hy)))', 'angle')}, {q6('sqrt(pow(sum(ex * hy - ey * hx), 2) + pow(sum(ex * hx + ey * hy), 2)) / sum(hx * hx + hy * hy)', 'scale')} FROM daily GROUP BY site"))
def rotation_fit(spark, sf_dir):
    """Least-squares rotation and scale from the magnetic onto the electric pair, in closed form."""
    c, s = F.sum(F.col("ex") * F.col("hx") + F.col("ey") * F.col("hy")), F.sum(F.col("ex") * F.col("hy") - F.col("ey") * F.col("hx"))
    n = F.sum(F.col("hx") * F.col("hx") + F.col("hy") * F.col("hy"))
    return daily(spark, sf_dir).groupBy("site").agg(r6(F.degrees(F.atan2(s, c)), "angle"), r6(F.sqrt(s * s + c * c) / n, "scale"))


@query("pairwise_spread", sql(PRODUCTS, f"SELECT x.period, CAST(count(*) AS BIGINT) AS pairs, {q6('median(abs(x.zxy_re - y.zxy_re))', 'spread')} FROM products x JOIN products y ON x.period = y.period AND x.product < y.product GROUP BY x.period"))
def pairwise_spread(spark, sf_dir):
    """Median difference of all pairs of products at each period."""
    p = products(spark, sf_dir)
    both = p.select("period", F.col("product").alias("one"), F.col("zxy_re").alias("a")).join(p.select("period", F.col("product").alias("other"), F.col("zxy_re").alias("b")), "period").where("one < other")
    return both.groupBy("period").agg(F.count("*").alias("pairs"), r6(F.percentile(F.abs(F.col("a") - F.col("b")), F.lit(0.5)), "spread"))


@query("window_list", sql(SPANS, "w AS (SELECT site, d // 30 AS w, count(DISTINCT d) AS days FROM (SELECT site, unnest(range(a, b)) AS d FROM spans) GROUP BY 1, 2)", "SELECT site, CAST(w * 30 AS BIGINT) AS a, CAST(w * 30 + 30 AS BIGINT) AS b, CAST(days AS BIGINT) AS days FROM w WHERE days >= 10"))
def window_list(spark, sf_dir):
    """Windows of thirty days of which a site's record covers ten at least."""
    from terrawave.operators import intervals as iv

    # Spans without overlaps are cut at the windows' borders; a day is no row.
    cut = iv.union(spans(spark, sf_dir), ["site"]).select("site", "a", "b", F.explode(F.sequence(F.floor(F.col("a") / 30), F.floor((F.col("b") - 1) / 30))).alias("w"))
    inside = F.least("b", F.col("w") * 30 + 30) - F.greatest("a", F.col("w") * 30)
    w = cut.groupBy("site", "w").agg(F.sum(inside).alias("days")).where("days >= 10")
    return w.select("site", (F.col("w") * 30).alias("a"), (F.col("w") * 30 + 30).alias("b"), "days")


@query("decimal_years", sql("SELECT o_orderkey AS id, round(year(o_orderdate) + (epoch_us(o_orderdate) / 1e6 - epoch(make_date(year(o_orderdate), 1, 1))) / (epoch(make_date(year(o_orderdate) + 1, 1, 1)) - epoch(make_date(year(o_orderdate), 1, 1))), 6) AS year FROM orders").removeprefix("WITH \n"))
def decimal_years(spark, sf_dir):
    """Order dates as decimal years."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.round(cx.decimal_year(F.col("o_orderdate")), 6).alias("year"))
