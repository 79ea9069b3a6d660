"""Queries over the samples, files and products of all sites: levels, corrections, runs, masks, choices. Sites are users, customers and suppliers, so that they grow with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrawave.functions import names
from terrawave.operators import choosing, corrections, filters, graph, levels, masking, runs, tables
from terrawave.plans.base import CHANNELS, SPANS, q6, r6, spans, sql, table
from terrawave.plans.catalog import query


def samples(spark, sf_dir):
    """site, channel, k (hours), x: a sparse series of each user."""
    kind = F.create_map(*(F.lit(v) for kv in CHANNELS.items() for v in kv))
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("site"), kind[F.col("event_type")].alias("channel"), F.expr("unix_micros(cast(ts as timestamp)) div 3600000000").alias("k"), "value")
    return rows.groupBy("site", "channel", "k").agg(F.avg("value").alias("x"))


SAMPLES = """samples AS (SELECT CAST(user_id AS BIGINT) AS site, CASE event_type WHEN 'error' THEN 'hx' WHEN 'click' THEN 'hy' WHEN 'view' THEN 'hz' WHEN 'signup' THEN 'ex' WHEN 'purchase' THEN 'ey' END AS channel,
  CAST(epoch_us(ts) // 3600000000 AS BIGINT) AS k, avg(value) AS x FROM events GROUP BY 1, 2, 3)"""


def vectors(spark, sf_dir):
    """site, k (days), hx, hy, hz, ex, ey, n_windows: daily means of each supplier."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("site"), F.expr("unix_micros(cast(l_shipdate as timestamp)) div 86400000000").alias("k"), (F.col("l_extendedprice") / 1000).alias("p"), (F.col("l_discount") * 100).alias("d"), (F.col("l_tax") * 100).alias("t"), F.col("l_quantity").alias("q"))
    return rows.groupBy("site", "k").agg(F.avg("p").alias("hx"), F.avg("d").alias("hy"), F.avg("t").alias("hz"), F.avg("q").alias("ex"), F.avg(F.col("d") - F.col("t")).alias("ey"), F.count("*").alias("n_windows"))


VECTORS = """vectors AS (SELECT CAST(l_suppkey AS BIGINT) AS site, CAST(epoch_us(CAST(l_shipdate AS TIMESTAMP)) // 86400000000 AS BIGINT) AS k, avg(l_extendedprice / 1000) AS hx, avg(l_discount * 100) AS hy, avg(l_tax * 100) AS hz,
  avg(l_quantity) AS ex, avg(l_discount * 100 - l_tax * 100) AS ey, count(*) AS n_windows FROM lineitem GROUP BY 1, 2)"""

_FIVE = ("hx", "hy", "hz", "ex", "ey")


def _vec(rows, *names):
    return rows.select(F.col("site").cast("long").alias("site"), F.col("k").cast("long").alias("k"), *(r6(n, n) for n in names))


def _vec_sql(cte: str, source: str, **named: str) -> str:
    return sql(VECTORS, cte, f"SELECT site, k, {', '.join(q6(e, n) for n, e in named.items())} FROM {source}") if cte else sql(VECTORS, f"SELECT site, k, {', '.join(q6(e, n) for n, e in named.items())} FROM {source}")


@query("subsample_medians", sql(SAMPLES, "s AS (SELECT site, channel, min(k) AS k0, CAST(ceil(count(*) / 20.0) AS BIGINT) AS step FROM samples GROUP BY 1, 2)", f"SELECT s.site, s.channel, count(*) AS n, {q6('median(x)', 'level')} FROM samples p JOIN s ON p.site = s.site AND p.channel = s.channel WHERE (k - k0) % step = 0 GROUP BY 1, 2"))
def subsample_medians(spark, sf_dir):
    """Medians of even subsamples of about 20 samples."""
    rows = levels.even_subsample(samples(spark, sf_dir), ["site", "channel"], 20)
    return rows.groupBy(F.col("site").cast("long").alias("site"), "channel").agg(F.count("*").alias("n"), r6(F.percentile("x", F.lit(0.5)), "level"))


_LEVELS = """f AS (SELECT site, channel, median(x) AS med, min(x) AS lo, max(x) AS hi FROM samples GROUP BY 1, 2),
r AS (SELECT f.site, f.channel, any_value(med) AS med, greatest(avg(CAST(x >= med + 0.9 * (hi - med) AS DOUBLE)), avg(CAST(x <= med - 0.9 * (med - lo) AS DOUBLE))) AS rail FROM samples p JOIN f ON p.site = f.site AND p.channel = f.channel GROUP BY 1, 2),
t AS (SELECT channel, median(abs(med)) AS typical FROM r GROUP BY 1),
v AS (SELECT r.*, typical, CASE WHEN typical > 0 THEN abs(med) / typical END AS ratio,
  CASE WHEN abs(med) > 150 OR coalesce(abs(med) / nullif(typical, 0) > 1.5, false) THEN 'open' WHEN rail > 0.4 THEN 'saturated' ELSE 'ok' END AS verdict FROM r JOIN t ON r.channel = t.channel)"""


def _levels(spark, sf_dir):
    rows = levels.rail_fraction(samples(spark, sf_dir), ["site", "channel"])
    return levels.verdicts(rows, "channel", 150.0, 1.5, 0.4)


@query("rail_fractions", sql(SAMPLES, _LEVELS, f"SELECT site, channel, {q6('med', 'median')}, {q6('rail', 'rail_fraction')} FROM r"))
def rail_fractions(spark, sf_dir):
    """Share of each channel's samples at its rail."""
    rows = levels.rail_fraction(samples(spark, sf_dir), ["site", "channel"])
    return rows.select(F.col("site").cast("long").alias("site"), "channel", r6("median", "median"), r6("rail_fraction", "rail_fraction"))


@query("level_verdicts", sql(SAMPLES, _LEVELS, f"SELECT site, channel, {q6('typical', 'typical')}, {q6('ratio', 'ratio')}, verdict FROM v"))
def level_verdicts(spark, sf_dir):
    """Levels against the typical one of their kind of channel."""
    return _levels(spark, sf_dir).select(F.col("site").cast("long").alias("site"), "channel", r6("typical", "typical"), r6("ratio", "ratio"), "verdict")


@query("worst_verdicts", sql(SAMPLES, _LEVELS, "SELECT site, CASE max(CASE verdict WHEN 'ok' THEN 1 WHEN 'saturated' THEN 2 ELSE 3 END) WHEN 1 THEN 'ok' WHEN 2 THEN 'saturated' ELSE 'open' END AS worst FROM v GROUP BY site"))
def worst_verdicts(spark, sf_dir):
    """The worst verdict of each site's channels."""
    return levels.worst(_levels(spark, sf_dir), ["site"]).select(F.col("site").cast("long").alias("site"), "worst")


@query("lines_reversed", sql(SAMPLES, f"SELECT site, channel, k, {q6('''CASE WHEN site % 5 = 0 AND channel IN ('ex', 'ey') AND (site % 2 = 0 OR channel = 'ey') THEN -x ELSE x END''', 'x')} FROM samples"))
def lines_reversed(spark, sf_dir):
    """Samples of declared channels with their sign turned."""
    rows = samples(spark, sf_dir)
    declared = rows.where("site % 5 = 0 and channel in ('ex', 'ey') and (site % 2 = 0 or channel = 'ey')").select("site", "channel")
    return corrections.signs_flipped(rows, declared).select(F.col("site").cast("long").alias("site"), "channel", "k", r6("x", "x"))


@query("channels_exchanged", sql(SAMPLES, f"SELECT site, CASE WHEN site % 3 = 0 AND channel = 'hx' THEN 'hy' WHEN site % 3 = 0 AND channel = 'hy' THEN 'hx' ELSE channel END AS channel, k, {q6('x', 'x')} FROM samples"))
def channels_exchanged(spark, sf_dir):
    """Samples of sites whose two magnetic channels were taken for each other."""
    rows = samples(spark, sf_dir)
    declared = rows.where("site % 3 = 0").select("site").distinct().select("site", F.lit("hx").alias("one"), F.lit("hy").alias("other"))
    return corrections.exchanged(rows, declared).select(F.col("site").cast("long").alias("site"), "channel", "k", r6("x", "x"))


@query("parts_rotated", sql(VECTORS, "p AS (SELECT site, min(k) AS lo, max(k) AS hi FROM vectors GROUP BY site)", "q AS (SELECT site, lo AS a2, lo + (hi - lo) // 2 AS b2, (site % 90)::DOUBLE AS degrees FROM p UNION ALL SELECT site, lo + (hi - lo) // 2 + 30, hi, -(site % 45)::DOUBLE FROM p)", f"SELECT v.site, k, CAST(a2 AS BIGINT) AS part, {q6('cos(radians(degrees)) * hx + sin(radians(degrees)) * hy', 'hx')}, {q6('cos(radians(degrees)) * hy - sin(radians(degrees)) * hx', 'hy')} FROM vectors v JOIN q ON v.site = q.site AND v.k >= a2 AND v.k < b2"))
def parts_rotated(spark, sf_dir):
    """Samples turned by the angle of their part of the record; those in no part left out."""
    rows = vectors(spark, sf_dir)
    p = rows.groupBy("site").agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    middle = F.col("lo") + F.floor((F.col("hi") - F.col("lo")) / 2)
    parts = p.select("site", F.col("lo").alias("a2"), middle.alias("b2"), (F.col("site") % 90).cast("double").alias("degrees")).unionByName(p.select("site", (middle + 30).alias("a2"), F.col("hi").alias("b2"), (-(F.col("site") % 45)).cast("double").alias("degrees"))).where("a2 < b2")
    out = corrections.rotated_in_parts(rows, parts, "hx", "hy", 365)
    return out.select(F.col("site").cast("long").alias("site"), F.col("k").cast("long").alias("k"), F.col("part").cast("long").alias("part"), r6("hx", "hx"), r6("hy", "hy"))


_V = ("(site % 7) / 10.0", "(site % 5) / 10.0", "(site % 3) / 10.0")
_ANGLE = "sqrt(" + " + ".join(f"{v} * {v}" for v in _V) + ")"


def _levelled_sql() -> str:
    u = [f"coalesce({v} / nullif(a, 0), 0)" for v in _V]
    along = " + ".join(f"{u[i]} * {n}" for i, n in enumerate(("hx", "hy", "hz")))
    h = ("hx", "hy", "hz")
    return _vec_sql(f"t AS (SELECT *, {_ANGLE} AS a FROM vectors)", "t", **{h[i]: f"{h[i]} * cos(a) + ({u[(i + 1) % 3]} * {h[(i + 2) % 3]} - {u[(i + 2) % 3]} * {h[(i + 1) % 3]}) * sin(a) + {u[i]} * ({along}) * (1 - cos(a))" for i in range(3)})


@query("three_axes_levelled", _levelled_sql())
def three_axes_levelled(spark, sf_dir):
    """Three channels turned about each site's rotation vector."""
    v = tuple((F.col("site") % n) / 10.0 for n in (7, 5, 3))
    return _vec(corrections.levelled(vectors(spark, sf_dir), v, ("hx", "hy", "hz")), "hx", "hy", "hz")


_D = "(cos(radians(site % 40)) * sin(radians(90 - site % 30)) - sin(radians(site % 40)) * cos(radians(90 - site % 30)))"


@query("electric_from_lines", _vec_sql("", "vectors", ex=f"(sin(radians(90 - site % 30)) * ex - sin(radians(site % 40)) * ey) / {_D}", ey=f"(cos(radians(site % 40)) * ey - cos(radians(90 - site % 30)) * ex) / {_D}"))
def electric_from_lines(spark, sf_dir):
    """North and east from lines laid off the axes."""
    return _vec(corrections.from_lines(vectors(spark, sf_dir), F.col("site") % 40, 90 - F.col("site") % 30, "ex", "ey"), "ex", "ey")


@query("diagonal_lines", sql(VECTORS, f"SELECT site, k, {q6('ex - CASE WHEN site % 2 = 0 THEN 1 ELSE -1 END * ey', 'diagonal')}, {q6('sqrt(100.0 * 100.0 + 80.0 * 80.0)', 'length')} FROM vectors"))
def diagonal_lines(spark, sf_dir):
    """The line between the ends of two others."""
    sign = F.when(F.col("site") % 2 == 0, 1.0).otherwise(-1.0)
    size, _ = corrections.diagonal_geometry(F.lit(100.0), F.lit(0.0), F.lit(80.0), F.lit(90.0), sign)
    return _vec(corrections.diagonal(vectors(spark, sf_dir), sign).withColumn("length", size), "diagonal", "length")


@query("clocks_and_windows", sql(SPANS, "s AS (SELECT site, run_id, a + CASE WHEN CAST(substr(site, 2) AS BIGINT) % 4 = 0 THEN 3 ELSE 0 END AS a, b + CASE WHEN CAST(substr(site, 2) AS BIGINT) % 4 = 0 THEN 3 ELSE 0 END AS b FROM spans)", "w AS (SELECT site, CASE WHEN CAST(substr(site, 2) AS BIGINT) % 3 = 0 THEN min(a) + 200 END AS lo, max(b) - 100 AS hi FROM s GROUP BY site)", "SELECT s.site, run_id, CAST(greatest(a, coalesce(lo, a)) AS BIGINT) AS a, CAST(least(b, hi) AS BIGINT) AS b FROM s JOIN w ON s.site = w.site WHERE greatest(a, coalesce(lo, a)) < least(b, hi)"))
def clocks_and_windows(spark, sf_dir):
    """Runs with their clock set right, cut to the window of their record."""
    rows = spans(spark, sf_dir)
    n = F.substring("site", 2, 20).cast("long")
    offsets = rows.select("site").distinct().where(n % 4 == 0).withColumn("offset", F.lit(3))
    moved = corrections.clock_shifted(rows, offsets)
    windows = moved.groupBy("site").agg(F.min("a").alias("lo"), F.max("b").alias("hi")).select("site", F.when(n % 3 == 0, F.col("lo") + 200).alias("start"), (F.col("hi") - 100).alias("end"))
    return corrections.clipped(moved, windows).select("site", "run_id", "a", "b")


@query("channels_kept", sql(SAMPLES, f"SELECT site, channel, k, {q6('x', 'x')} FROM samples WHERE site % 2 = 1 OR channel IN ('hx', 'hy')"))
def channels_kept(spark, sf_dir):
    """Samples of the channels that a site declares."""
    rows = samples(spark, sf_dir)
    declared = rows.select("site").distinct().where("site % 2 = 0").withColumn("channels", F.array(F.lit("hx"), F.lit("hy")))
    return corrections.channels_kept(rows, declared).select(F.col("site").cast("long").alias("site"), "channel", "k", r6("x", "x"))


@query("short_bands_dropped", sql(VECTORS, f"SELECT site, k, {q6('hx', 'hx')} FROM vectors WHERE n_windows >= 2 AND k BETWEEN 8500 AND 10000"))
def short_bands_dropped(spark, sf_dir):
    """Rows on enough windows, in a range."""
    rows = corrections.long_enough(vectors(spark, sf_dir), 2).withColumn("period", F.col("k"))
    return _vec(corrections.in_range(rows, 8500, 10000), "hx")


@query("rows_as_laid", sql(VECTORS, f"SELECT site, k, {q6('CASE WHEN site % 4 = 1 THEN -hx ELSE hx END', 'hx')}, {q6('CASE WHEN site % 4 = 1 THEN -hy ELSE hy END', 'hy')}, {q6('CASE WHEN site % 6 = 1 THEN -ey ELSE ey END', 'ey')} FROM vectors"))
def rows_as_laid(spark, sf_dir):
    """Products of sites with reversed lines as the lines were laid."""
    rows = vectors(spark, sf_dir)
    sites = rows.select("site").distinct()
    declared = sites.where("site % 4 = 1").withColumn("channel", F.lit("ex")).unionByName(sites.where("site % 6 = 1").withColumn("channel", F.lit("ey")))
    return _vec(corrections.as_laid(rows, declared, {"ex": ["hx", "hy"], "ey": ["ey"]}), "hx", "hy", "ey")


@query("files_split_at_gaps", sql(SPANS, "SELECT site, run_id, CAST(sum(n) OVER (PARTITION BY site ORDER BY a, b, run_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM (SELECT *, CASE WHEN abs(a - lag(b) OVER (PARTITION BY site ORDER BY a, b, run_id)) <= 90 AND run_id % 2 = lag(run_id % 2) OVER (PARTITION BY site ORDER BY a, b, run_id) THEN 0 ELSE 1 END AS n FROM spans)"))
def files_split_at_gaps(spark, sf_dir):
    """Files into runs at gaps of more than 90 days and at changes of rate."""
    return _runs_of(runs.split_at_gaps(spans(spark, sf_dir).withColumn("rate", F.col("run_id") % 2), ["site"], 90, "rate", ("run_id",)))


def _runs_of(rows):
    return rows.select("site", "run_id", F.col("run").cast("long").alias("run"))


@query("file_runs_ended", sql("f AS (SELECT l_orderkey AS site, CAST(l_linenumber AS BIGINT) AS a, max(l_quantity) AS q FROM lineitem GROUP BY 1, 2)", "d AS (SELECT *, a - lag(a) OVER w AS d, lag(q > 40) OVER w AS ended FROM f WINDOW w AS (PARTITION BY site ORDER BY a))", "m AS (SELECT site, CAST(trunc(median(d)) AS BIGINT) AS m FROM d GROUP BY site)", "r AS (SELECT d.site, a, sum(CASE WHEN d.d = m AND NOT coalesce(ended, false) THEN 0 ELSE 1 END) OVER (PARTITION BY d.site ORDER BY a) AS run FROM d JOIN m ON d.site = m.site)", "SELECT CAST(site AS BIGINT) AS site, a, CAST(sum(CASE WHEN i % 3 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY site ORDER BY a) AS BIGINT) AS run FROM (SELECT *, row_number() OVER (PARTITION BY site, run ORDER BY a) - 1 AS i FROM r)"))
def file_runs_ended(spark, sf_dir):
    """Files into runs of three at most, a large file being the last of its run."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("long").alias("site"), F.col("l_linenumber").cast("long").alias("a"), F.col("l_quantity").alias("q")).groupBy("site", "a").agg(F.max("q").alias("q"))
    return runs.grouped(rows, ["site"], most=3, ends=F.col("q") > 40).select("site", "a", F.col("run").cast("long").alias("run"))


@query("sequences_aligned", sql("f AS (SELECT l_orderkey AS rec, l_linenumber % 2 AS folder, l_linenumber // 2 AS seq, CAST(floor(l_quantity / 10) AS BIGINT) AS n FROM lineitem)", "t AS (SELECT rec, count(DISTINCT folder) AS folders FROM f GROUP BY rec)", "SELECT CAST(f.rec AS BIGINT) AS rec, CAST(seq AS BIGINT) AS seq, min(n) AS n FROM f JOIN t ON f.rec = t.rec GROUP BY f.rec, seq HAVING count(DISTINCT folder) = any_value(folders) AND min(n) = max(n)"))
def sequences_aligned(spark, sf_dir):
    """Sequences that all folders of a record hold with one number of samples."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("long").alias("rec"), (F.col("l_linenumber") % 2).alias("folder"), F.floor(F.col("l_linenumber") / 2).alias("seq"), F.floor(F.col("l_quantity") / 10).alias("n"))
    return runs.aligned(rows, ["rec"], "folder", "seq", "n").select("rec", "seq", "n")


_RATES = [f"l{i} AS (SELECT s.run_id, max(c.since) AS since FROM spans s JOIN c ON s.site = c.site AND c.since <= s.a AND c.channel = {i} GROUP BY 1)" for i in (0, 1)]


@query("files_of_other_rate", sql(SPANS, "c AS (SELECT site, a AS since, run_id // 3 % 2 AS channel, max(CAST(run_id % 2 AS DOUBLE)) AS rate FROM spans WHERE run_id % 3 = 0 GROUP BY 1, 2, 3)", *_RATES, "r AS (SELECT s.site, s.run_id, s.a, x.rate AS r0, y.rate AS r1 FROM spans s LEFT JOIN l0 ON s.run_id = l0.run_id LEFT JOIN c x ON x.site = s.site AND x.since = l0.since AND x.channel = 0 LEFT JOIN l1 ON s.run_id = l1.run_id LEFT JOIN c y ON y.site = s.site AND y.since = l1.since AND y.channel = 1)", "SELECT site, run_id, CAST(a AS BIGINT) AS a, CAST((CASE WHEN r0 IS NULL THEN 0 ELSE 1 END) + (CASE WHEN r1 IS NULL THEN 0 ELSE 1 END) AS INTEGER) AS known FROM r WHERE coalesce(r0, 1) <> 1 OR coalesce(r1, 1) <> 1"))
def files_of_other_rate(spark, sf_dir):
    """Files with a channel at another rate than the site's, by its log of changes."""
    rows = spans(spark, sf_dir)
    changes = rows.where("run_id % 3 = 0").select("site", F.col("a").alias("since"), F.expr("cast(run_id div 3 % 2 as string)").alias("channel"), (F.col("run_id") % 2).cast("double").alias("rate"))
    return runs.of_other_rate(rows.select("site", "run_id", "a"), changes, ["site"], 1.0, ["0", "1"]).select("site", "run_id", "a", F.size("rates").alias("known"))


@query("runs_on_grid", sql(SPANS, "t AS (SELECT site, run_id, CAST(run_id AS HUGEINT) * 3333333333333 - 1000000000 AS ns FROM spans)", "u AS (SELECT site, run_id, (ns * 24000) // 1000000000 AS down, (ns * 24000) % 1000000000 AS over FROM t)", "SELECT site, run_id, CAST(down + CASE WHEN over >= 500000000 THEN 1 ELSE 0 END AS BIGINT) AS index, least(over, 1000000000 - over) / 1000000000.0 <= 1e-3 AS on_grid FROM u"))
def runs_on_grid(spark, sf_dir):
    """Places of runs on a grid of 24 kHz, years from its origin."""
    rows = spans(spark, sf_dir).withColumn("start", F.col("run_id").cast("decimal(20,0)") * 3333333333333)
    return runs.placed(rows, F.lit(1_000_000_000), F.lit(24_000)).select("site", "run_id", "index", "on_grid")


@query("gaps_carried_down", sql(SPANS.replace("FROM orders", "FROM orders WHERE epoch_us(o_orderdate) // 86400000000 < 9500"), *(f"w{i} AS (SELECT site, greatest(0, floor(a / 4.0) - 32) AS a, least(floor(b / 4.0) + 1 + 32, {2375 if i == 1 else 594}) AS b FROM {'spans' if i == 1 else f'u{i - 1}'}), r{i} AS (SELECT *, max(b) OVER (PARTITION BY site ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM w{i}), u{i} AS (SELECT site, min(a) AS a, max(b) AS b FROM (SELECT *, sum(CASE WHEN a <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY site ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM r{i}) GROUP BY site, g)" for i in (1, 2)), "SELECT site, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b, CAST(level AS INTEGER) AS level FROM (SELECT site, a, b, 1 AS level FROM u1 UNION ALL SELECT site, a, b, 2 FROM u2)"))
def gaps_carried_down(spark, sf_dir):
    """Gaps on coarser levels, widened by the filter's reach."""
    out = runs.carried_gaps(spans(spark, sf_dir).where("a < 9500"), ["site"], 3, 4, samples=F.lit(9500)).where("level > 0")
    return out.select("site", F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), "level")


@query("files_selected", sql(SPANS, "SELECT site, run_id, CAST(a AS BIGINT) AS a FROM (SELECT *, lead(a) OVER (PARTITION BY site ORDER BY a) AS e FROM (SELECT site, a, max(run_id) AS run_id FROM spans GROUP BY 1, 2)) WHERE a < 9500 AND (e IS NULL OR e > 9000)"))
def files_selected(spark, sf_dir):
    """Files that overlap a window, each ending where the next one starts."""
    rows = spans(spark, sf_dir).groupBy("site", "a").agg(F.max("run_id").alias("run_id"))
    return runs.selected(rows, ["site"], F.lit(9000), F.lit(9500)).select("site", "run_id", "a")


@query("flag_stretches", sql(SAMPLES, "f AS (SELECT site, k, max(x) > 60 AS flag FROM samples GROUP BY 1, 2)", "g AS (SELECT *, CASE WHEN flag = lag(flag) OVER w AND k - lag(k) OVER w = 1 THEN 0 ELSE 1 END AS n FROM f WINDOW w AS (PARTITION BY site ORDER BY k))", "SELECT site, flag, min(k) AS a, max(k) + 1 AS b FROM (SELECT *, sum(n) OVER (PARTITION BY site ORDER BY k) AS r FROM g) GROUP BY site, r, flag"))
def flag_stretches(spark, sf_dir):
    """Stretches of consecutive hours with one value of a flag."""
    rows = samples(spark, sf_dir).groupBy("site", "k").agg((F.max("x") > 60).alias("flag"))
    return runs.stretches(rows, ["site"], "flag").select(F.col("site").cast("long").alias("site"), "flag", "a", "b")


@query("recorded_spans", sql(SPANS, "d AS (SELECT site, a, a - lag(a) OVER (PARTITION BY site ORDER BY a) AS d FROM spans)", f"SELECT site, CAST(min(a) AS BIGINT) AS a, {q6('max(a) + coalesce(median(d), 0)', 'b')}, count(*) AS files FROM d GROUP BY site"))
def recorded_spans(spark, sf_dir):
    """From each site's first file to its last and the usual spacing more."""
    return runs.recorded_span(spans(spark, sf_dir), ["site"]).select("site", "a", r6(F.col("b").cast("double"), "b"), "files")


def raw_masks(spark, sf_dir):
    """site, a, b, pmin, pmax, scope, channels, found_by: masks as people write them, faults included."""
    e = table(spark, sf_dir, "events")
    k = F.expr("unix_micros(cast(ts as timestamp)) div 3600000000")
    n = F.col("event_id")
    channels = F.when(n % 4 == 0, F.array(F.lit(" EX"), F.lit("hy"), F.lit("ex"))).when(n % 4 == 1, F.array(F.lit("")).cast("array<string>"))
    return e.select(n.alias("mask_id"), F.when(n % 11 != 0, F.col("user_id")).alias("site"), k.alias("a"), (k + n % 6 - 1).alias("b"), F.when(n % 3 == 0, (n % 7).cast("double")).alias("pmin"), F.when((n % 3 == 0) & (n % 5 != 0), F.lit(4.0)).alias("pmax"), F.element_at(F.array(*map(F.lit, ("Local", "both", "remote", "all"))), (n % 4 + 1).cast("int")).alias("scope"), channels.alias("channels"), F.when(n % 2 == 0, "polar").when(n % 3 == 0, "cluster").alias("found_by"))


_RAW = """raw AS (SELECT event_id AS mask_id, CASE WHEN event_id % 11 <> 0 THEN user_id END AS site, CAST(epoch_us(ts) // 3600000000 AS BIGINT) AS a, CAST(epoch_us(ts) // 3600000000 + event_id % 6 - 1 AS BIGINT) AS b,
  CASE WHEN event_id % 3 = 0 THEN (event_id % 7)::DOUBLE END AS pmin, CASE WHEN event_id % 3 = 0 AND event_id % 5 <> 0 THEN 4.0::DOUBLE END AS pmax, ['local', 'both', 'remote', 'all'][event_id % 4 + 1] AS scope,
  CASE WHEN event_id % 4 = 0 THEN 'ex,hy' END AS channels, CASE WHEN event_id % 2 = 0 THEN 'polar' WHEN event_id % 3 = 0 THEN 'cluster' END AS found_by FROM events),
fit AS (SELECT *, CASE WHEN site IS NULL THEN 'no site' WHEN a >= b THEN 'ends before it starts' WHEN (pmin IS NULL) <> (pmax IS NULL) THEN 'half a band' WHEN pmin > pmax THEN 'band upside down' WHEN scope = 'all' THEN 'unknown scope' END AS refused FROM raw)"""


@query("masks_normalised", sql(_RAW, "SELECT CAST(mask_id AS BIGINT) AS mask_id, scope, channels, refused FROM fit"))
def masks_normalised(spark, sf_dir):
    """Mask rows made fit, or the first reason against them."""
    rows = masking.normalised(raw_masks(spark, sf_dir))
    return rows.select(F.col("mask_id").cast("long").alias("mask_id"), "scope", F.array_join("channels", ",").alias("channels"), "refused")


@query("masks_split", sql(_RAW, "SELECT CAST(mask_id AS BIGINT) AS mask_id, CASE WHEN scope NOT IN ('remote', 'both') THEN 'other role' WHEN channels IS NOT NULL AND channels = '' THEN 'other channels' WHEN pmin IS NOT NULL THEN 'one band only' END AS left_out FROM fit WHERE refused IS NULL"))
def masks_split(spark, sf_dir):
    """What a remote with two magnetic channels takes of the masks, and why it leaves the others out."""
    rows = masking.normalised(raw_masks(spark, sf_dir)).where("refused is null")
    return masking.split(rows, "remote", ["hx", "hy"], False).select(F.col("mask_id").cast("long").alias("mask_id"), "left_out")


@query("masks_replaced", sql(_RAW, "SELECT CAST(mask_id AS BIGINT) AS mask_id, found_by, CAST(b - a AS BIGINT) AS hours FROM fit WHERE refused IS NULL AND found_by IS DISTINCT FROM 'cluster' UNION ALL SELECT CAST(mask_id AS BIGINT), 'cluster', CAST(b - a + 1 AS BIGINT) FROM fit WHERE refused IS NULL AND mask_id % 10 = 3"))
def masks_replaced(spark, sf_dir):
    """Masks of one origin replaced by new ones."""
    rows = masking.normalised(raw_masks(spark, sf_dir)).where("refused is null").select("mask_id", "a", "b", "found_by")
    out = masking.replaced(rows, rows.where("mask_id % 10 = 3").withColumn("b", F.col("b") + 1).drop("found_by"), "cluster")
    return out.select(F.col("mask_id").cast("long").alias("mask_id"), "found_by", (F.col("b") - F.col("a")).cast("long").alias("hours"))


@query("group_mask_states", sql(SAMPLES, "SELECT site, CAST(k // 24 AS BIGINT) AS day, CAST(CASE WHEN sum(CASE WHEN x < 80 THEN 1 ELSE 0 END) > 0 AND sum(CASE WHEN x < 80 AND x > 40 THEN 1 ELSE 0 END) = sum(CASE WHEN x < 80 THEN 1 ELSE 0 END) THEN 2 WHEN sum(CASE WHEN x < 80 AND x > 40 THEN 1 ELSE 0 END) > 0 THEN 1 ELSE 0 END AS INTEGER) AS state FROM samples GROUP BY 1, 2"))
def group_mask_states(spark, sf_dir):
    """Groups of windows clear of masks, under them in part, or whole."""
    rows = samples(spark, sf_dir).withColumn("day", F.floor(F.col("k") / 24))
    return masking.states(rows, ["site", "day"], F.col("x") > 40, F.col("x") < 80).select(F.col("site").cast("long").alias("site"), "day", "state")


@query("night_masks", sql(SAMPLES, "r AS (SELECT site, min(k) * 3600 AS lo, (max(k) + 1) * 3600 AS hi FROM samples GROUP BY site)", "d AS (SELECT site, lo, hi, unnest(range(lo // 86400 - 2, hi // 86400 + 2)) AS day FROM r)", "n AS (SELECT site, lo, hi, greatest(lo, day * 86400 + (22 - 3) * 3600) AS a, least(hi, (day + 1) * 86400 + (5 - 3) * 3600) AS b FROM d)", "e AS (SELECT site, a, b FROM n WHERE a < b UNION ALL SELECT site, lo, lo FROM r UNION ALL SELECT site, hi, hi FROM r)", "SELECT site, CAST(b AS BIGINT) AS a, CAST(nxt AS BIGINT) AS b FROM (SELECT site, b, lead(a) OVER (PARTITION BY site ORDER BY a, b) AS nxt FROM e) WHERE b < nxt"))
def night_masks(spark, sf_dir):
    """Daytime of each record: what nights by a local clock leave of it."""
    r = samples(spark, sf_dir).groupBy("site").agg((F.min("k") * 3600).alias("a"), ((F.max("k") + 1) * 3600).alias("b"))
    return masking.night_masks(r, ["site"], 22, 5, "Africa/Nairobi").select(F.col("site").cast("long").alias("site"), F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))


@query("eligible_remotes", sql(SPANS, "o AS (SELECT x.site, x.run_id, y.run_id AS other, least(x.b, y.b) - greatest(x.a, y.a) AS overlap, abs(x.run_id - y.run_id)::DOUBLE AS km FROM spans x JOIN spans y ON x.site = y.site AND x.run_id <> y.run_id AND x.a < y.b AND y.a < x.b)", "r AS (SELECT *, CASE WHEN other % 7 = 0 THEN 'never a remote' WHEN overlap < 5 THEN 'too little time in common' WHEN km < 40 THEN 'twin' END AS left_out FROM o)", "SELECT CAST(run_id AS BIGINT) AS site, CAST(other AS BIGINT) AS other, left_out, CASE WHEN left_out IS NULL THEN CAST(row_number() OVER (PARTITION BY run_id, left_out IS NULL ORDER BY km, other) AS BIGINT) END AS place FROM r"))
def eligible_remotes(spark, sf_dir):
    """Pairs of overlapping records with the first reason against each, and the nearest of the eligible."""
    from terrawave.operators.intervals import overlap_join

    s = spans(spark, sf_dir)
    both = overlap_join(s, s.select("site", F.col("run_id").alias("other"), F.col("a").alias("a2"), F.col("b").alias("b2")), ["site"], 60).where("run_id <> other")
    pairs = both.select(F.col("run_id").cast("long").alias("site"), F.col("other").cast("long").alias("other"), (F.least("b", "b2") - F.greatest("a", "a2")).alias("overlap"), F.abs(F.col("run_id") - F.col("other")).cast("double").alias("km"))
    pairs = choosing.with_reason(pairs, [(F.col("other") % 7 == 0, "never a remote"), (F.col("overlap") < 5, "too little time in common"), (F.col("km") < 40, "twin")])
    return choosing.nearest_eligible(pairs, 3).select("site", "other", "left_out", F.col("place").cast("long").alias("place"))


@query("stack_members", sql("c AS (SELECT l_suppkey AS site, l_partkey AS other, max(l_quantity / 50) AS best, min(l_extendedprice) AS km FROM lineitem GROUP BY 1, 2)", "f AS (SELECT *, CASE WHEN sum(CASE WHEN best >= 0.98 THEN 1 ELSE 0 END) OVER (PARTITION BY site) >= 4 THEN 0.98 ELSE 0.9 END AS floor FROM c)", "p AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY km, other) AS place, count(*) OVER (PARTITION BY site) AS n FROM f WHERE best >= floor)", "SELECT CAST(site AS BIGINT) AS site, CAST(other AS BIGINT) AS other, CAST(place AS BIGINT) AS place FROM p WHERE n >= 4 AND place <= 8"))
def stack_members(spark, sf_dir):
    """Members of each site's stack: the nearest of those covered enough, by the second floor where the first leaves too few."""
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").cast("long").alias("site"), F.col("l_partkey").cast("long").alias("other")).agg(F.max(F.col("l_quantity") / 50).alias("best_share"), F.min("l_extendedprice").alias("km"))
    return choosing.members(rows, 0.98, 0.9, 8, 4).select("site", "other", F.col("place").cast("long").alias("place"))


@query("simultaneous_runs", sql(SPANS, "x AS (SELECT site, greatest(a, 8800) AS a, least(b, 10200) AS b FROM spans WHERE run_id % 2 = 0)", "SELECT x.site, CAST(greatest(x.a, y.a) AS BIGINT) AS a, CAST(least(x.b, y.b) AS BIGINT) AS b FROM x JOIN spans y ON x.site = y.site AND y.run_id % 2 = 1 AND x.a < y.b AND y.a < x.b WHERE x.a < x.b AND least(x.b, y.b) - greatest(x.a, y.a) >= 6"))
def simultaneous_runs(spark, sf_dir):
    """Runs cut to a window and to the remote's runs, short pieces dropped."""
    s = spans(spark, sf_dir)
    return choosing.simultaneous(s.where("run_id % 2 = 0"), s.where("run_id % 2 = 1"), 8800, 10200, 60, 6)


@query("rows_on_union", sql(VECTORS, "x AS (SELECT site, k::DOUBLE AS period, hx FROM vectors WHERE k % 3 <> 0)", "y AS (SELECT site, k * (1 + 1e-13) AS period, hy FROM vectors WHERE k % 2 = 0)", f"SELECT coalesce(x.site, y.site) AS site, {q6('coalesce(x.period, y.period)', 'period')}, {q6('hx', 'hx')}, {q6('hy', 'hy')} FROM x FULL JOIN y ON x.site = y.site AND round(ln(x.period), 9) = round(ln(y.period), 9)"))
def rows_on_union(spark, sf_dir):
    """Two products' rows on the union of their periods."""
    v = vectors(spark, sf_dir)
    x = v.where("k % 3 <> 0").select("site", F.col("k").cast("double").alias("period"), "hx")
    y = v.where("k % 2 = 0").select("site", (F.col("k") * (1 + 1e-13)).alias("period"), "hy")
    return choosing.on_union(x, y, ["site"], ["hx"], ["hy"]).select(F.col("site").cast("long").alias("site"), r6("period", "period"), r6("hx", "hx"), r6("hy", "hy"))


@query("grouped_under_longest", sql(SPANS, "o AS (SELECT x.site, x.run_id, y.run_id AS other, y.a AS start, least(x.b, y.b) - greatest(x.a, y.a) AS overlap FROM spans x JOIN spans y ON x.site = y.site AND x.run_id <> y.run_id AND x.a < y.b AND y.a < x.b)", "SELECT CAST(run_id AS BIGINT) AS site, CAST(other AS BIGINT) AS other, CAST(overlap AS BIGINT) AS overlap FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY overlap DESC, start, other) AS r FROM o) WHERE r = 1"))
def grouped_under_longest(spark, sf_dir):
    """Each record under the one that it overlaps most."""
    from terrawave.operators.intervals import overlap_join

    s = spans(spark, sf_dir)
    both = overlap_join(s, s.select("site", F.col("run_id").alias("other"), F.col("a").alias("a2"), F.col("b").alias("b2")), ["site"], 60).where("run_id <> other")
    pairs = both.select(F.col("run_id").cast("long").alias("site"), F.col("other").cast("long").alias("other"), F.col("a2").alias("start"), (F.least("b", "b2") - F.greatest("a", "a2")).cast("long").alias("overlap"))
    return choosing.under_most_overlapped(pairs).select("site", "other", "overlap")


@query("site_components", sql(SPANS.replace("spans AS", "RECURSIVE spans AS"), "l AS (SELECT x.run_id AS a, y.run_id AS b FROM spans x JOIN spans y ON x.site = y.site AND x.run_id <> y.run_id AND x.a < y.b AND y.a < x.b)", "reach AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a)", "SELECT CAST(a AS BIGINT) AS node, CAST(min(b) AS BIGINT) AS root FROM (SELECT a, b FROM reach UNION SELECT a, a FROM l) GROUP BY a"))
def site_components(spark, sf_dir):
    """Connected components of records that overlap."""
    from terrawave.operators.intervals import overlap_join

    s = spans(spark, sf_dir)
    both = overlap_join(s, s.select("site", F.col("run_id").alias("other"), F.col("a").alias("a2"), F.col("b").alias("b2")), ["site"], 60).where("run_id < other")
    return graph.components(both.select(F.col("run_id").cast("long").alias("a"), F.col("other").cast("long").alias("b")))


@query("decimated_levels", sql(VECTORS, "s AS (SELECT site, k, hx AS x FROM vectors)", "m AS (SELECT unnest(range(-20, 21)) AS m)", "t AS (SELECT m, CASE WHEN m = 0 THEN 1 ELSE sin(pi() * m / 2.0) / (pi() * m / 2.0) END * (0.54 + 0.46 * cos(pi() * m / 20.0)) AS h FROM m)", "taps AS (SELECT m, h / (SELECT sum(h) FROM t) AS h FROM t)", *(f"d{i} AS (SELECT o.site, o.k // 2 AS k, sum(p.x * h) AS x FROM {p} o CROSS JOIN taps JOIN {p} p ON p.site = o.site AND p.k = o.k + m WHERE o.k % 2 = 0 GROUP BY 1, 2)" for i, p in ((1, "s"), (2, "d1"))), f"SELECT site, CAST(k AS BIGINT) AS k, CAST(level AS INTEGER) AS level, {q6('x', 'x')} FROM (SELECT site, k, 1 AS level, x FROM d1 UNION ALL SELECT site, k, 2, x FROM d2)"))
def decimated_levels(spark, sf_dir):
    """A ladder of two coarser levels, anti-aliased."""
    out = filters.ladder(vectors(spark, sf_dir).withColumn("x", F.col("hx")), ["site"], 2, 3).where("level > 0")
    return out.select(F.col("site").cast("long").alias("site"), "k", "level", r6("x", "x"))


@query("gains_applied", sql(SAMPLES, f"SELECT site, channel, k, {q6("CASE WHEN site % 3 = 1 AND channel = 'hx' THEN x / (1 + site % 4) ELSE x END", 'x')} FROM samples"))
def gains_applied(spark, sf_dir):
    """Samples over the gains of their channels; a gain of zero counts for none."""
    rows = samples(spark, sf_dir)
    sites = rows.select("site").distinct()
    gains = sites.where("site % 3 = 1").select("site", F.lit("hx").alias("channel"), (1.0 + F.col("site") % 4).alias("gain")).unionByName(sites.where("site % 3 = 2").select("site", F.lit("hy").alias("channel"), F.lit(0.0).alias("gain")))
    return tables.gained(rows, gains).select(F.col("site").cast("long").alias("site"), "channel", "k", r6("x", "x"))


@query("positions_filled", sql("s AS (SELECT CAST(s_suppkey AS BIGINT) AS site, s_nationkey, CASE WHEN s_acctbal > 0 THEN s_acctbal END AS lat FROM supplier)", "f AS (SELECT n_nationkey AS k, avg(c_acctbal) AS lat FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1)", f"SELECT site, {q6('coalesce(s.lat, f.lat)', 'lat')} FROM s LEFT JOIN f ON s_nationkey = k"))
def positions_filled(spark, sf_dir):
    """Positions of sites filled from a table where the site has none."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("site"), F.col("s_nationkey").alias("nation"), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("lat"))
    facts = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.avg("c_acctbal").alias("lat"))
    return tables.filled(s, facts, ["nation"], ["lat"]).select("site", r6("lat", "lat"))


@query("stale_products", sql("p AS (SELECT o_orderkey AS id, o_custkey % 3 AS win, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS taper FROM orders)", "n AS (SELECT l_orderkey AS id, min(l_linenumber) % 3 AS win, CASE WHEN l_orderkey % 4 = 0 THEN '1-URGENT' END AS taper FROM lineitem GROUP BY l_orderkey HAVING l_orderkey % 5 <> 0)", "SELECT CAST(p.id AS BIGINT) AS id, CASE WHEN n.id IS NULL THEN 'missing' WHEN p.win IS DISTINCT FROM n.win THEN 'win' WHEN p.taper IS DISTINCT FROM n.taper THEN 'taper' END AS changed FROM p LEFT JOIN n ON p.id = n.id"))
def stale_products(spark, sf_dir):
    """Products whose settings are no longer those in force, with the first that differs."""
    p = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("long").alias("id"), (F.col("o_custkey") % 3).cast("long").alias("win"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("taper"))
    n = table(spark, sf_dir, "lineitem").where("l_orderkey % 5 <> 0").groupBy(F.col("l_orderkey").cast("long").alias("id")).agg((F.min("l_linenumber") % 3).cast("long").alias("win")).withColumn("taper", F.when(F.col("id") % 4 == 0, "1-URGENT"))
    return tables.stale(p, n, ["id"], ["win", "taper"]).select("id", "changed")


@query("usable_ranges", sql(SAMPLES, "f AS (SELECT site, k FROM samples GROUP BY 1, 2 HAVING max(x) > 30)", "g AS (SELECT site, k, k - row_number() OVER (PARTITION BY site ORDER BY k) AS g FROM f)", "r AS (SELECT site, min(k) AS a, max(k) + 1 AS b FROM g GROUP BY site, g)", "SELECT site, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY b - a DESC, a) AS i FROM r) WHERE i = 1"))
def usable_ranges(spark, sf_dir):
    """The longest stretch of each site that is fit for use."""
    rows = samples(spark, sf_dir).groupBy("site", "k").agg(F.max("x").alias("x"))
    return tables.longest_run(rows, ["site"], F.col("x") > 30).select(F.col("site").cast("long").alias("site"), F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))


@query("stack_medians", sql(VECTORS, f"SELECT k, count(hx) AS members, {q6('median(hx)', 'hx')}, {q6('median(hy)', 'hy')} FROM vectors GROUP BY k HAVING count(hx) >= 2"))
def stack_medians(spark, sf_dir):
    """Median of the members of a stack, parts apart, where two or more are there."""
    out = tables.marginal_median(vectors(spark, sf_dir), ["k"], ["hx", "hy"], 2)
    return out.select(F.col("k").cast("long").alias("k"), "members", r6("hx", "hx"), r6("hy", "hy"))


@query("sound_weeks", sql(VECTORS, "w AS (SELECT site, k // 7 AS week, avg(hx) AS f FROM vectors GROUP BY 1, 2)", "SELECT site, count(*) AS weeks, count(*) FILTER (round(f, 6) BETWEEN 20 AND 60) AS sound, CAST(min(week) FILTER (round(f, 6) BETWEEN 20 AND 60) AS BIGINT) AS first, CAST(max(week) FILTER (round(f, 6) BETWEEN 20 AND 60) AS BIGINT) AS last FROM w GROUP BY site"))
def sound_weeks(spark, sf_dir):
    """Weeks of each site, sound and in all."""
    w = vectors(spark, sf_dir).groupBy("site", F.floor(F.col("k") / 7).alias("week")).agg(F.avg("hx").alias("f"))
    out = tables.sound_summary(w, ["site"], F.round("f", 6).between(20, 60))
    return out.select(F.col("site").cast("long").alias("site"), "weeks", "sound", "first", "last")


@query("azimuth_spreads", sql(VECTORS, "h AS (SELECT site, k // 30 AS hour, median(hx) AS x, median(hy) AS y FROM vectors GROUP BY 1, 2)", "m AS (SELECT site, atan2(avg(y), avg(x)) AS m FROM h GROUP BY site)", "t AS (SELECT h.site, degrees(atan2(y, x) - m) + 180.0 AS d FROM h JOIN m ON h.site = m.site)", "u AS (SELECT site, d - 360.0 * floor(d / 360.0) - 180.0 AS t FROM t)", f"SELECT site, count(*) AS hours, {q6('quantile_cont(t, 0.95) - quantile_cont(t, 0.05)', 'spread')} FROM u GROUP BY site"))
def azimuth_spreads(spark, sf_dir):
    """Spread of the direction of monthly medians."""
    out = tables.azimuth_spread(vectors(spark, sf_dir), ["site"], F.floor(F.col("k") / 30))
    return out.select(F.col("site").cast("long").alias("site"), "hours", r6("spread", "spread"))


@query("lattices_merged", sql("p AS (SELECT CAST(l_suppkey AS BIGINT) AS site, l_quantity * (1 + (l_linenumber % 3) * 4e-10) AS period FROM lineitem)", "g AS (SELECT *, CASE WHEN period / lag(period) OVER (PARTITION BY site ORDER BY period) - 1 <= 1e-9 THEN 0 ELSE 1 END AS n FROM p)", f"SELECT site, {q6('min(period)', 'period')}, count(*) AS n FROM (SELECT *, sum(n) OVER (PARTITION BY site ORDER BY period RANGE UNBOUNDED PRECEDING) AS r FROM g) GROUP BY site, r"))
def lattices_merged(spark, sf_dir):
    """Periods of each site that differ by rounding alone made one."""
    p = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("long").alias("site"), (F.col("l_quantity") * (1 + (F.col("l_linenumber") % 3) * 4e-10)).alias("period"))
    return tables.merged_lattice(p, ["site"]).select("site", r6("period", "period"), "n")


@query("local_diurnal", sql("e AS (SELECT user_id, CAST((epoch_us(ts) // 3600000000 + 3) % 24 AS INTEGER) AS hour, value FROM events)", "s AS (SELECT user_id, hour, median(value) AS m FROM e GROUP BY 1, 2)", f"SELECT hour, count(*) AS sites, {q6('median(m)', 'level')} FROM s GROUP BY hour"))
def local_diurnal(spark, sf_dir):
    """Median over sites of their medians by hour of a local clock."""
    e = table(spark, sf_dir, "events").select("user_id", names.local_hour(F.col("ts").cast("timestamp"), "Africa/Nairobi").alias("hour"), "value")
    s = e.groupBy("user_id", "hour").agg(F.percentile("value", F.lit(0.5)).alias("m"))
    return s.groupBy("hour").agg(F.count("*").alias("sites"), r6(F.percentile("m", F.lit(0.5)), "level"))


@query("bands_pooled", sql("b(band, lo, hi) AS (VALUES (0, 1.0, 10.0), (1, 10.0, 30.0), (2, 25.0, 51.0))", "s AS (SELECT CAST(l_suppkey AS BIGINT) AS site, l_quantity AS period, l_discount AS re, l_tax AS im, l_extendedprice / 1000 AS var FROM lineitem WHERE l_linenumber <> 3)", f"SELECT site, CAST(band AS INTEGER) AS band, count(*) AS n, {q6('avg(re)', 're')}, {q6('avg(im)', 'im')}, {q6('sum(var) / (count(*) * count(*))', 'var')} FROM s JOIN b ON period >= lo AND period < hi GROUP BY 1, 2"))
def bands_pooled(spark, sf_dir):
    """Estimates on a fine grid pooled in bands, some of them in two."""
    bins = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("long").alias("site"), F.col("l_quantity").alias("period"), F.col("l_discount").alias("re"), F.col("l_tax").alias("im"), (F.col("l_extendedprice") / 1000).alias("var"), "l_linenumber")
    bands = spark.createDataFrame([(0, 1.0, 10.0), (1, 10.0, 30.0), (2, 25.0, 51.0)], "band int, lo double, hi double")
    return tables.pooled(bins, bands, ["site"], F.col("l_linenumber") != 3).select("site", "band", "n", r6("re", "re"), r6("im", "im"), r6("var", "var"))


@query("clock_states", f"SELECT CAST(user_id AS BIGINT) AS site, {q6('avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END)', 'unsynchronised')}, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS stages FROM events WHERE event_id % 5 = 0 GROUP BY user_id")
def clock_states(spark, sf_dir):
    """Share of every fifth record without a locked clock, and the stages met."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("long").alias("site"), F.col("event_id").alias("k"), (F.col("value") > 50).cast("int").alias("sync"), F.col("event_type").alias("stage"))
    return tables.clock_status(e, ["site"], "sync", "stage", stride=5).select("site", r6("unsynchronised", "unsynchronised"), "stages")


@query("phase_quadrants", sql("p AS (SELECT CAST(l_suppkey AS BIGINT) AS site, l_discount * 3600 - (l_suppkey % 4) * 90 AS ph FROM lineitem)", "a AS (SELECT site, ph - 45 + 180 - 360 * floor((ph - 45 + 180) / 360.0) - 180 AS t FROM p)", f"SELECT site, count(*) AS n, {q6('CASE WHEN count(*) >= 5 THEN median(t) + 45 END', 'phase')}, CASE WHEN count(*) >= 5 THEN round(abs(median(t)), 9) <= 45 END AS in_place FROM a GROUP BY site"))
def phase_quadrants(spark, sf_dir):
    """Median phases against the first quadrant."""
    p = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("long").alias("site"), (F.col("l_discount") * 3600 - (F.col("l_suppkey") % 4) * 90).alias("phase"))
    return tables.phase_quadrant(p, ["site"], F.col("phase"), 45.0).select("site", "n", r6("phase", "phase"), "in_place")


@query("products_stitched", sql(VECTORS, "s AS (SELECT site, k % 50 AS band, min(hx) AS z FROM vectors WHERE k % 3 = 0 GROUP BY 1, 2)", "l AS (SELECT site, k % 50 + 20 AS band, max(hx) AS z FROM vectors WHERE k % 3 = 1 GROUP BY 1, 2)", "f AS (SELECT s.site, min(s.band) AS first FROM s JOIN l ON s.site = l.site AND s.band = l.band GROUP BY 1)", "u AS (SELECT s.* FROM s LEFT JOIN f ON s.site = f.site WHERE f.first IS NULL OR band < f.first UNION ALL SELECT l.* FROM l LEFT JOIN f ON l.site = f.site WHERE f.first IS NULL OR band >= f.first)", f"SELECT site, CAST(band AS BIGINT) AS band, {q6('z', 'z')} FROM u"))
def products_stitched(spark, sf_dir):
    """Burst rows below the first shared band, continuous ones from it on."""
    v = vectors(spark, sf_dir)
    s = v.where("k % 3 = 0").groupBy("site", (F.col("k") % 50).alias("band")).agg(F.min("hx").alias("z"))
    x = v.where("k % 3 = 1").groupBy("site", (F.col("k") % 50 + 20).alias("band")).agg(F.max("hx").alias("z"))
    return tables.stitched(s, x, ["site"]).select(F.col("site").cast("long").alias("site"), F.col("band").cast("long").alias("band"), r6("z", "z"))


@query("site_findings", sql("s AS (SELECT CAST(s_suppkey AS BIGINT) AS site, s_acctbal AS bal, s_nationkey AS n FROM supplier)", "SELECT site, 'STOP' AS level, 'no position' AS finding FROM s WHERE bal < 0 UNION ALL SELECT site, 'warn', 'far apart' FROM s WHERE bal > 5000 UNION ALL SELECT site, 'warn', 'lines not square' FROM s WHERE n % 3 = 0"))
def site_findings(spark, sf_dir):
    """What is wrong with each site's declaration, by level."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("site"), "s_acctbal", "s_nationkey")
    return tables.findings(s, ["site"], [(F.col("s_acctbal") < 0, "STOP", "no position"), (F.col("s_acctbal") > 5000, "warn", "far apart"), (F.col("s_nationkey") % 3 == 0, "warn", "lines not square")])


@query("masks_on_grid", sql("m AS (SELECT CAST(event_id AS BIGINT) AS id, CAST(event_id AS HUGEINT) * 3700000000001 AS a, CAST(event_id AS HUGEINT) * 3700000000001 + (event_id % 9) * 21000000 AS b FROM events)", "g AS (SELECT id, greatest(0, ((a - 1000000000) * 24000 + 999999999) // 1000000000) AS f, least(900000000000, ((b - 1000000000) * 24000 + 999999999) // 1000000000) AS l FROM m)", 'SELECT id, CAST(f AS BIGINT) AS "first", CAST(l AS BIGINT) AS "last" FROM g WHERE f < l'))
def masks_on_grid(spark, sf_dir):
    """Samples of a grid of 24 kHz that masks cover."""
    i = F.col("event_id").cast("long")
    at = i.cast("decimal(20,0)") * 3700000000001  # beyond a long from 2.5 million events on
    m = table(spark, sf_dir, "events").select(i.alias("id"), at.alias("a"), (at + (i % 9) * 21000000).alias("b"))
    return masking.on_grid(m, F.lit(1_000_000_000), F.lit(900_000_000_000), F.lit(24_000)).select("id", "first", "last")


_KEPT = "f AS (SELECT site, k, max(x) > 55 AS kept FROM samples GROUP BY 1, 2)"


@query("controls_shifted", sql(SAMPLES, _KEPT, "r AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY k) - 1 AS r, count(*) OVER (PARTITION BY site) AS n FROM f)", "SELECT a.site, a.k, b.kept FROM r a JOIN r b ON a.site = b.site AND a.r = (b.r + 7) % b.n"))
def controls_shifted(spark, sf_dir):
    """A control of kept hours: the same pattern seven slots on."""
    s = samples(spark, sf_dir).groupBy("site", "k").agg((F.max("x") > 55).alias("kept"))
    return masking.shifted_control(s, ["site"], "kept", 7).select(F.col("site").cast("long").alias("site"), "k", "kept")


@query("controls_by_half", sql(SAMPLES, _KEPT, "g AS (SELECT site, k, k - row_number() OVER (PARTITION BY site ORDER BY k) AS g FROM f WHERE kept)", "r AS (SELECT site, min(k) AS a, max(k) + 1 AS b FROM g GROUP BY site, g)", "SELECT site, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY a) - 1 AS n FROM r) WHERE n % 2 = 1"))
def controls_by_half(spark, sf_dir):
    """Every other run of kept hours."""
    s = samples(spark, sf_dir).groupBy("site", "k").agg((F.max("x") > 55).alias("kept"))
    out = masking.alternate_runs(s, ["site"], "kept", 1)
    return out.select(F.col("site").cast("long").alias("site"), F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))


@query("bursts_on_compact_grid", sql("b AS (SELECT CAST(l_suppkey AS BIGINT) AS site, CAST(l_orderkey AS BIGINT) AS slot, CAST(l_linenumber - 1 AS BIGINT) AS j FROM lineitem GROUP BY 1, 2, 3)", "SELECT site, slot, j, CAST((dense_rank() OVER (PARTITION BY site ORDER BY slot) - 1) * 8 + j AS BIGINT) AS index FROM b"))
def bursts_on_compact_grid(spark, sf_dir):
    """Bursts of seven samples laid back to back."""
    b = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("long").alias("site"), F.col("l_orderkey").cast("long").alias("slot"), (F.col("l_linenumber") - 1).cast("long").alias("j")).distinct()
    return runs.burst_grid(b, ["site"], "slot", "j", 7).select("site", "slot", "j", F.col("index").cast("long").alias("index"))


_OWN = [
    "f AS (SELECT CAST(o_orderkey AS BIGINT) AS id, 'VIC' || CAST(o_custkey % 200 AS VARCHAR) || 'a' AS folder, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'Vic' || CASE WHEN o_orderkey % 3 = 0 THEN '00' ELSE '' END || CAST(o_custkey % 200 + CASE WHEN o_custkey % 4 = 1 THEN 1 + o_orderkey % 3 ELSE o_orderkey % 4 % 3 + CASE WHEN o_custkey % 4 = 2 THEN 5 ELSE 0 END END AS VARCHAR) || 'A' || CASE WHEN o_orderkey % 5 = 0 THEN '_' ELSE '' END END AS station, 'vic' || CAST(o_custkey % 200 + CASE WHEN o_custkey % 4 = 1 THEN 2 ELSE 9 END AS VARCHAR) || 'a' AS head FROM orders)",
    *(f"k{i} AS (SELECT *, lower(regexp_replace({c}, '[_-]+$', '')) AS {o} FROM {'f' if i == 0 else f'k{i - 1}'})" for i, (c, o) in enumerate((("station", "s0"), ("folder", "f0"), ("head", "h0")))),
    "k AS (SELECT id, folder, station, 'vic' || regexp_replace(substr(s0, 4), '^0+([0-9])', '\\1') AS s, 'vic' || regexp_replace(substr(f0, 4), '^0+([0-9])', '\\1') AS fk, h0 AS h FROM k2)",
    "n AS (SELECT folder, s, count(*) AS n, max(CASE WHEN s = fk THEN 1 ELSE 0 END) AS named, max(CASE WHEN s = h THEN 1 ELSE 0 END) AS head FROM k WHERE s IS NOT NULL GROUP BY 1, 2)",
    "m AS (SELECT *, max(n) OVER (PARTITION BY folder) AS most, max(named) OVER (PARTITION BY folder) AS any_named, max(head) OVER (PARTITION BY folder) AS any_head, row_number() OVER (PARTITION BY folder ORDER BY n DESC, s) AS r FROM n)",
    "o AS (SELECT folder, s FROM m WHERE CASE WHEN any_named = 1 THEN named = 1 WHEN any_head = 0 THEN FALSE WHEN EXISTS (SELECT 1 FROM m m2 WHERE m2.folder = m.folder AND m2.head = 1 AND m2.n = m2.most) THEN head = 1 ELSE r = 1 END)",
    "a AS (SELECT DISTINCT folder FROM o)",
]


@query("own_stations", sql(*_OWN, "SELECT id, k.folder, station FROM k LEFT JOIN a ON k.folder = a.folder LEFT JOIN o ON k.folder = o.folder AND k.s = o.s WHERE a.folder IS NULL OR o.s IS NOT NULL"))
def own_stations(spark, sf_dir):
    """Files of each folder's own station: of some folders the one named like them, of others the log's or the fullest, of the rest all."""
    site, i = F.col("o_custkey") % 200, F.col("o_orderkey")
    off = F.when(F.col("o_custkey") % 4 == 1, 1 + i % 3).otherwise(i % 4 % 3 + F.when(F.col("o_custkey") % 4 == 2, 5).otherwise(0))
    station = F.when(i % 11 != 0, F.concat(F.lit("Vic"), F.when(i % 3 == 0, "00").otherwise(""), (site + off).cast("string"), F.lit("A"), F.when(i % 5 == 0, "_").otherwise("")))
    head = F.concat(F.lit("vic"), (site + F.when(F.col("o_custkey") % 4 == 1, 2).otherwise(9)).cast("string"), F.lit("a"))
    f = table(spark, sf_dir, "orders").select(i.cast("long").alias("id"), F.concat(F.lit("VIC"), site.cast("string"), F.lit("a")).alias("folder"), station.alias("station"), head.alias("head"))
    return runs.own_station(f, "folder", "station", "head").select("id", "folder", "station")
