"""Queries that clean long series: levels, bursts, despiking, recursive filters, mains and glitches. Sites are groups of ten suppliers, so that they grow with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrawave.operators import blocks, bursts, declared, glitches, masking, recursive
from terrawave.plans.base import EPOCH, LONG, long_daily, q6, r6, sql, table
from terrawave.plans.catalog import query
from terrawave.session import stash

_S = ["site", "channel"]
_PARTS = {"hx": ("A", "q"), "hy": ("R", "q"), "ex": ("A", "e"), "ey": ("R", "e"), "rx": ("A", "r"), "ry": ("R", "r")}


def dense(spark, sf_dir):
    """site, k (days), hx, hy, ex, ey, rx, ry: sums of each day, a day without any being zero."""
    k = F.datediff(F.col("l_shipdate").cast("date"), F.lit(EPOCH).cast("date")).cast("long")
    q = F.col("l_quantity")
    rows = table(spark, sf_dir, "lineitem").select(F.expr("cast(l_suppkey div 10 as bigint)").alias("site"), k.alias("k"), "l_returnflag", q.alias("q"), (F.col("l_extendedprice") / 1024).alias("e"), (q * (1 - F.col("l_discount"))).alias("r"))
    held = rows.groupBy("site", "k").agg(*(F.sum(F.when(F.col("l_returnflag") == f, F.col(c)).otherwise(0.0)).alias(n) for n, (f, c) in _PARTS.items()))
    grid = held.groupBy("site").agg(F.min("k").alias("a"), F.max("k").alias("b")).select("site", F.explode(F.sequence("a", "b")).alias("k"))
    return stash(grid.join(held, ["site", "k"], "left").fillna(0.0, list(_PARTS)), "dense")  # operators read it more than once


def long_dense(spark, sf_dir, names=("hx", "ex")):
    """dense as site, channel, k, x."""
    return dense(spark, sf_dir).unpivot(["site", "k"], list(names), "channel", "x")


DENSE = f"""held AS (
  SELECT CAST(l_suppkey // 10 AS BIGINT) AS site, CAST(date_diff('day', DATE '{EPOCH}', CAST(l_shipdate AS DATE)) AS BIGINT) AS k,
    {", ".join(f"sum(CASE WHEN l_returnflag = '{f}' THEN {dict(q='l_quantity', e='l_extendedprice / 1024', r='l_quantity * (1 - l_discount)')[c]} ELSE 0 END) AS {n}" for n, (f, c) in _PARTS.items())} FROM lineitem GROUP BY 1, 2),
ends AS (SELECT site, min(k) AS a, max(k) AS b FROM held GROUP BY site),
grid AS (SELECT site, unnest(range(a, b + 1)) AS k FROM ends),
dense AS (SELECT g.site, g.k, {", ".join(f"coalesce(h.{n}, 0) AS {n}" for n in _PARTS)} FROM grid g LEFT JOIN held h ON g.site = h.site AND g.k = h.k)"""
LONG_DENSE = DENSE + ",\nlong_dense AS (" + " UNION ALL ".join(f"SELECT site, '{n}' AS channel, k, {n} AS x FROM dense" for n in ("hx", "ex")) + ")"


@query("despiked", sql(LONG, "d AS (SELECT *, x - lag(x) OVER (PARTITION BY site, channel ORDER BY k) AS step FROM long_daily)", "m AS (SELECT site, channel, 1.4826 * quantile_disc(abs(step), 0.5) AS s FROM d WHERE step IS NOT NULL GROUP BY site, channel)", "b AS (SELECT d.site, d.channel, d.k, d.x, max(CASE WHEN round(abs(step), 9) > round(4 * s, 9) THEN 1 ELSE 0 END) OVER (PARTITION BY d.site, d.channel ORDER BY d.k ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS bad FROM d JOIN m ON d.site = m.site AND d.channel = m.channel)", f"SELECT site, channel, CAST(k AS BIGINT) AS k, {q6('x', 'x')} FROM b WHERE bad = 0"))
def despiked(spark, sf_dir):
    """Samples away from steps beyond four robust scales."""
    return bursts.despiked(long_daily(spark, sf_dir), _S, "x", 4, 2).select(*_S, "k", r6("x", "x"))


_BLOCKS = "c AS (SELECT *, (k - min(k) OVER (PARTITION BY site, channel)) // {m} AS c, min(k) OVER (PARTITION BY site, channel) AS lo, max(k) OVER (PARTITION BY site, channel) + 1 AS hi FROM {t})"
_MEDIANS = "m AS (SELECT site, channel, c, median(x) AS v, (any_value(lo) + c * {m} + least(any_value(lo) + c * {m} + {m}, any_value(hi)) - 1) / 2.0 AS o FROM c GROUP BY site, channel, c), n AS (SELECT *, lag(v) OVER w AS pv, lag(o) OVER w AS po, lead(v) OVER w AS nv, lead(o) OVER w AS no FROM m WINDOW w AS (PARTITION BY site, channel ORDER BY c))"
_LEVEL = "l AS (SELECT c.site, c.channel, c.k, c.x, c.c, lo, hi, CASE WHEN k < o THEN coalesce(pv + (v - pv) * (k - po) / (o - po), v) ELSE coalesce(v + (nv - v) * (k - o) / (no - o), v) END AS level FROM c JOIN n ON c.site = n.site AND c.channel = n.channel AND c.c = n.c)"


def _level_sql(m: int, t: str) -> tuple[str, ...]:
    return tuple(part.format(m=m, t=t) for part in (_BLOCKS, _MEDIANS, _LEVEL))


@query("local_level", sql(LONG, *_level_sql(7, "long_daily"), f"SELECT site, channel, CAST(k AS BIGINT) AS k, {q6('level', 'level')} FROM l"))
def local_level(spark, sf_dir):
    """Medians of blocks joined by straight lines between their centres."""
    return bursts.with_level(long_daily(spark, sf_dir), _S, "x", 7).select(*_S, "k", r6("level", "level"))


@query("running_median_residual", sql(LONG, f"SELECT site, channel, CAST(k AS BIGINT) AS k, {q6('x - median(x) OVER (PARTITION BY site, channel ORDER BY k ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING)', 'x')} FROM long_daily"))
def running_median_residual(spark, sf_dir):
    """Residual about a running median."""
    rows = long_daily(spark, sf_dir)
    return rows.join(blocks.moving_median(rows, _S, "x", 10, 10), [*_S, "k"]).select(*_S, "k", r6(F.col("x") - F.col("median"), "x"))


_W, _M, _HALF = 3, 20, 15
_RATIO = (
    *_level_sql(_M, "long_dense"),
    "d AS (SELECT *, abs(x - level) AS d FROM l)",
    f"""e AS (SELECT *, (sum(d) OVER (p ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) + (1 - count(*) OVER (p ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING)) * first_value(d) OVER (p ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)
      + (2 - count(*) OVER (p ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING)) * last_value(d) OVER (p ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)) / {_W} AS mean FROM d WINDOW p AS (PARTITION BY site, channel ORDER BY k))""",
    "s AS (SELECT site, channel, c, median(d) AS v FROM d GROUP BY 1, 2, 3)",
    f"z AS (SELECT a.site, a.channel, a.c, median(b.v) AS scale FROM s a JOIN s b ON a.site = b.site AND a.channel = b.channel AND b.c BETWEEN a.c - {_HALF} AND a.c + {_HALF} AND b.v > 0 GROUP BY 1, 2, 3)",
    "ratios AS (SELECT e.site, e.channel, e.k, e.x, e.level, lo, hi, coalesce(mean / scale, 0) AS ratio FROM e LEFT JOIN z ON e.site = z.site AND e.channel = z.channel AND e.c = z.c)",
)
_FOUND = (
    "g AS (SELECT site, k, k - row_number() OVER (PARTITION BY site ORDER BY k) AS g FROM (SELECT site, k FROM ratios GROUP BY 1, 2 HAVING max(ratio) > 1.5))",
    f"r AS (SELECT g.site, min(g.k) AS a, max(g.k) + 1 AS b FROM g GROUP BY g.site, g HAVING max(g.k) + 1 - min(g.k) >= 2 * {_W} - 1)",
    "q AS (SELECT r.site, greatest(r.a - 3, e.a) AS a, least(r.b + 3, e.b + 1) AS b FROM r JOIN ends e ON r.site = e.site)",
    "h AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY site ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM q)",
    "u AS (SELECT site, min(a) AS a, max(b) AS b FROM (SELECT *, sum(new) OVER (PARTITION BY site ORDER BY a ROWS UNBOUNDED PRECEDING) AS run FROM h) GROUP BY site, run)",
)


def _ratios(rows):
    return bursts.burst_ratio(rows, _S, "x", _W, _M, _HALF)


def _found(rows):
    hot = bursts.any_louder([_ratios(rows).drop("channel")], ["site"], 1.5)
    return masking.bursts(hot, ["site"], F.col("loud"), _W, 3)


@query("burst_ratios", sql(LONG_DENSE, *_RATIO, f"SELECT site, channel, k, {q6('ratio', 'ratio')} FROM ratios"))
def burst_ratios(spark, sf_dir):
    """Distance from the local level over a few days, in shares of the usual one nearby."""
    return _ratios(long_dense(spark, sf_dir)).select(*_S, "k", r6("ratio", "ratio"))


@query("bursts_found", sql(LONG_DENSE, *_RATIO, *_FOUND, "SELECT site, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b FROM u"))
def bursts_found(spark, sf_dir):
    """Stretches on which a channel of the site is loud for long enough, padded and merged."""
    return _found(long_dense(spark, sf_dir)).select("site", F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))


@query("bursts_filled", sql(LONG_DENSE, *_RATIO, *_FOUND, "f AS (SELECT r.*, least(k - a, b - 1 - k) AS edge, least(4, (b - a) // 2) AS half, a IS NULL AS out FROM ratios r LEFT JOIN u ON r.site = u.site AND k >= a AND k < b)", f"SELECT site, channel, k, {q6('CASE WHEN out THEN x ELSE level + (CASE WHEN edge < half THEN (1 + cos(pi() * edge / half)) / 2 ELSE 0 END) * (x - level) END', 'x')} FROM f"))
def bursts_filled(spark, sf_dir):
    """Samples set to the local level inside bursts, by a cosine from both ends."""
    base = long_dense(spark, sf_dir)
    rows = bursts.with_level(base, _S, "x", _M)
    spans = _found(base).withColumnsRenamed({"a": "a2", "b": "b2"})
    both = spans.join(base.select(*_S).distinct(), "site")
    return masking.spans_filled(rows, both, _S, "x", "level", 4, 64).select(*_S, "k", r6("x", "x"))


_PAD = 9


def _zero_phase_sql(b0: str, b1: str, b2: str, a1: str, a2: str, w: str, column: str, taps: int = 250) -> str:
    """A section forward and back by its response to an impulse: a run is turned about its ends, and constant before its first sample."""
    def passed(source: str, name: str, sign: str, first: str) -> str:
        # What comes from before the run's first sample is that sample times the rest of the response.
        return f"""{name}e AS (SELECT site, k, x, {first} AS x0, {"k - min(k) OVER (PARTITION BY site)" if sign == "-" else "max(k) OVER (PARTITION BY site) - k"} AS n FROM {source}),
{name} AS (SELECT p.site, p.k, sum(h.h * o.x) + any_value(p.x0 * coalesce(t.tail, 0)) AS x FROM {name}e p CROSS JOIN h JOIN {name}e o ON o.site = p.site AND o.k = p.k {sign} h.i LEFT JOIN t ON t.i = p.n GROUP BY p.site, p.k)"""

    return "WITH RECURSIVE " + ",\n".join((
        DENSE,
        f"c AS (SELECT {w} AS w)",
        f"s AS (SELECT {b0} AS b0, {b1} AS b1, {b2} AS b2, {a1} AS a1, {a2} AS a2 FROM c)",
        f"h AS (SELECT 0 AS i, b0 AS h, b1 - a1 * b0 AS z1, b2 - a2 * b0 AS z2 FROM s UNION ALL SELECT i + 1, z1, z2 - a1 * z1, -a2 * z1 FROM h CROSS JOIN s WHERE i < {taps})",
        "t AS (SELECT i, sum(h) OVER (ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS tail FROM h)",
        f"e AS (SELECT d.site, d.k, d.{column} AS x, a, b, f.{column} AS x1, l.{column} AS x2 FROM dense d JOIN ends ON d.site = ends.site JOIN dense f ON f.site = d.site AND f.k = a JOIN dense l ON l.site = d.site AND l.k = b)",
        f"p AS (SELECT site, k, x FROM e UNION ALL SELECT site, 2 * a - k, 2 * x1 - x FROM e WHERE k > a AND k <= a + {_PAD} UNION ALL SELECT site, 2 * b - k, 2 * x2 - x FROM e WHERE k < b AND k >= b - {_PAD})",
        passed("p", "y", "-", "first_value(x) OVER (PARTITION BY site ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"),
        passed("y", "z", "+", "last_value(x) OVER (PARTITION BY site ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"),
    )) + f"\nSELECT z.site, z.k, {q6('z.x', column)} FROM z JOIN ends ON z.site = ends.site WHERE k >= a AND k <= b"


@query("butterworth_filtered", _zero_phase_sql("1 / (1 + sqrt(2.0::DOUBLE) * w + w * w)", "-2 / (1 + sqrt(2.0::DOUBLE) * w + w * w)", "1 / (1 + sqrt(2.0::DOUBLE) * w + w * w)", "2 * (w * w - 1) / (1 + sqrt(2.0::DOUBLE) * w + w * w)", "(1 - sqrt(2.0::DOUBLE) * w + w * w) / (1 + sqrt(2.0::DOUBLE) * w + w * w)", "tan(pi() * 0.05)", "hx"))
def butterworth_filtered(spark, sf_dir):
    """Series without what is slower than twenty days."""
    return recursive.filtered(dense(spark, sf_dir), ["site"], "hx", 1.0, 0.05, "high", order=2).select("site", "k", r6("hx", "hx"))


_GAIN = "(1 / (1 + tan(pi() / 7 / 2)))"


@query("weekly_line_notched", _zero_phase_sql(_GAIN, f"-2 * {_GAIN} * w", _GAIN, f"-2 * {_GAIN} * w", f"2 * {_GAIN} - 1", "cos(2 * pi() / 7)", "ex"))
def weekly_line_notched(spark, sf_dir):
    """Series without a line of seven days."""
    return recursive.notched(dense(spark, sf_dir), ["site"], "ex", 1.0, f0=1 / 7, harmonics=1, q=2.0, passes=1).select("site", "k", r6("ex", "ex"))


@query("glitches_subtracted")
def glitches_subtracted(spark, sf_dir):
    """Series without what repeats every thirty days; tests hold it against one series in numpy."""
    out = glitches.subtracted(long_dense(spark, sf_dir), ["site"], 1.0, period_s=30.0, width_s=4.0, skip_s=30.0, chunk_s=400.0, least=2.0)
    return out.select(*_S, "k", r6("x", "x"))


@query("filters_applied")
def filters_applied(spark, sf_dir):
    """A declared list: a channel turned, bursts filled, slow parts and a line out; tests hold it against the filters one by one."""
    loud = {"threshold": 1.5, "min_len_s": _W, "pad_s": 3, "taper_s": 4, "reference": ["hx", "ex"]}
    filters = [{"flip": {"channels": ["hx"]}}, {"burst": loud}, {"hp": {"cutoff_hz": 0.01}}, {"notch": {"f0": 1 / 7, "q": 4.0, "passes": 1, "channels": ["ex"]}}]
    return declared.applied(long_dense(spark, sf_dir), ["site"], 1.0, filters).select(*_S, "k", r6("x", "x"))


_CYCLES = f"""cc AS (SELECT *, (k - min(k) OVER (PARTITION BY site, channel)) AS i, max(k) OVER (PARTITION BY site, channel) + 1 - min(k) OVER (PARTITION BY site, channel) AS n FROM long_dense),
cw AS (SELECT *, i // 280 AS w, i % 280 AS o, least(280, n - i // 280 * 280) AS size FROM cc),
ct AS (SELECT *, CAST(floor(o / 7.3) AS BIGINT) + d AS j FROM cw, (SELECT unnest([-1, 0, 1]) AS d)),
cp AS (SELECT *, o - CAST(round_even(j * 7.3, 0) AS BIGINT) AS p FROM ct WHERE floor(size / 7.3) >= 5 AND j >= 0 AND j < floor(size / 7.3)),
cq AS (SELECT * FROM cp WHERE p >= 0 AND p < 7 AND round_even(j * 7.3, 0) + w * 280 + 7 <= n),
cm AS (SELECT site, channel, w, p, median(x) AS m FROM cq GROUP BY 1, 2, 3, 4),
cz AS (SELECT site, channel, w, median(m) AS z FROM cm GROUP BY 1, 2, 3),
cl AS (SELECT q.site, q.channel, q.k, sum(m - z) AS less FROM cq q JOIN cm ON q.site = cm.site AND q.channel = cm.channel AND q.w = cm.w AND q.p = cm.p JOIN cz ON q.site = cz.site AND q.channel = cz.channel AND q.w = cz.w GROUP BY 1, 2, 3)"""


@query("fractional_cycles_subtracted", sql(LONG_DENSE, _CYCLES, f"SELECT c.site, c.channel, c.k, {q6('c.x - coalesce(less, 0)', 'x')} FROM cc c LEFT JOIN cl ON c.site = cl.site AND c.channel = cl.channel AND c.k = cl.k"))
def fractional_cycles_subtracted(spark, sf_dir):
    """Series without the median cycle of a period that is no whole number of samples."""
    return declared.cycles_subtracted(long_dense(spark, sf_dir), _S, "x", 7.3, 280).select(*_S, "k", r6("x", "x"))
