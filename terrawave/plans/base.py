"""Series, runs, intervals and products that Spark derives from the given tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHANNELS = {"error": "hx", "click": "hy", "view": "hz", "signup": "ex", "purchase": "ey"}
EPOCH = "1995-01-02"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def us(column: str):
    return F.unix_micros(F.col(column).cast("timestamp"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """site, channel, k (hours), x: a series with gaps."""
    kind = F.create_map(*(F.lit(v) for kv in CHANNELS.items() for v in kv))
    rows = table(spark, sf_dir, "events").select(F.concat(F.lit("U"), (F.col("user_id") % 2).cast("string")).alias("site"), kind[F.col("event_type")].alias("channel"), F.expr("unix_micros(cast(ts as timestamp)) div 3600000000").alias("k"), "value")
    return rows.groupBy("site", "channel", "k").agg(F.avg("value").alias("x"))


HOURLY = """hourly AS (
  SELECT 'U' || (user_id % 2) AS site, CASE event_type WHEN 'error' THEN 'hx' WHEN 'click' THEN 'hy' WHEN 'view' THEN 'hz' WHEN 'signup' THEN 'ex' WHEN 'purchase' THEN 'ey' END AS channel,
         CAST(epoch_us(ts) // 3600000000 AS BIGINT) AS k, avg(value) AS x FROM events GROUP BY 1, 2, 3)"""


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """site, k (days), hx, hy, hz, ex, ey, rx, ry: a dense series of two sites, medians removed."""
    k = F.datediff(F.col("l_shipdate").cast("date"), F.lit(EPOCH).cast("date")).cast("long")
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 2).alias("s"), k.alias("k"), "l_returnflag", "l_quantity", "l_extendedprice", "l_discount")

    def total(flag: str, value):
        return F.sum(F.when(F.col("l_returnflag") == flag, value).otherwise(0.0))

    q, e, r = F.col("l_quantity"), F.col("l_extendedprice") / 1000, F.col("l_quantity") * (1 - F.col("l_discount"))
    names = {"hx": total("A", q), "hy": total("R", q), "hz": total("N", q), "ex": total("A", e), "ey": total("R", e), "rx": total("A", r), "ry": total("R", r)}
    held = rows.groupBy("s", "k").agg(*(v.alias(n) for n, v in names.items()))
    grid = held.groupBy("s").agg(F.min("k").alias("a"), F.max("k").alias("b")).select("s", F.explode(F.sequence("a", "b")).alias("k"))
    full = grid.join(held, ["s", "k"], "left").fillna(0.0, list(names))
    middle = full.groupBy("s").agg(*(F.percentile(n, F.lit(0.5)).alias(f"m_{n}") for n in names))
    return full.join(middle, "s").select(F.concat(F.lit("S"), F.col("s").cast("string")).alias("site"), "k", *((F.col(n) - F.col(f"m_{n}")).alias(n) for n in names))


_N = ("hx", "hy", "hz", "ex", "ey", "rx", "ry")
DAILY = f"""held AS (
  SELECT l_suppkey % 2 AS s, CAST(date_diff('day', DATE '{EPOCH}', CAST(l_shipdate AS DATE)) AS BIGINT) AS k,
    sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS hx, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS hy,
    sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS hz, sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice / 1000 ELSE 0 END) AS ex,
    sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice / 1000 ELSE 0 END) AS ey, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity * (1 - l_discount) ELSE 0 END) AS rx,
    sum(CASE WHEN l_returnflag = 'R' THEN l_quantity * (1 - l_discount) ELSE 0 END) AS ry FROM lineitem GROUP BY 1, 2),
ends AS (SELECT s, min(k) AS a, max(k) AS b FROM held GROUP BY s),
grid AS (SELECT s, unnest(range(a, b + 1)) AS k FROM ends),
filled AS (SELECT g.s, g.k, {", ".join(f"coalesce(h.{n}, 0) AS {n}" for n in _N)} FROM grid g LEFT JOIN held h ON g.s = h.s AND g.k = h.k),
middle AS (SELECT s, {", ".join(f"median({n}) AS m_{n}" for n in _N)} FROM filled GROUP BY s),
daily AS (SELECT 'S' || f.s AS site, f.k, {", ".join(f"f.{n} - m.m_{n} AS {n}" for n in _N)} FROM filled f JOIN middle m ON f.s = m.s)"""


def long_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """daily as site, channel, k, x."""
    names = ("hx", "hy", "hz", "ex", "ey")
    return daily(spark, sf_dir).unpivot(["site", "k"], list(names), "channel", "x")


LONG = DAILY + ",\nlong_daily AS (" + " UNION ALL ".join(f"SELECT site, '{n}' AS channel, k, {n} AS x FROM daily" for n in _N[:5]) + ")"


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """site, run_id, a, b: intervals [a, b) in days, from orders of a customer."""
    day = F.expr("unix_micros(cast(o_orderdate as timestamp)) div 86400000000")
    return table(spark, sf_dir, "orders").select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("site"), F.col("o_orderkey").alias("run_id"), day.alias("a"), (day + F.col("o_orderkey") % 60 + 1).alias("b"))


SPANS = "spans AS (SELECT 'C' || o_custkey AS site, o_orderkey AS run_id, CAST(epoch_us(o_orderdate) // 86400000000 AS BIGINT) AS a, CAST(epoch_us(o_orderdate) // 86400000000 + o_orderkey % 60 + 1 AS BIGINT) AS b FROM orders)"


def masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """site, a, b (hours), pmin, pmax, scope, channel, reason: masks of the hourly sites, one for each error event."""
    k = F.expr("unix_micros(cast(ts as timestamp)) div 3600000000")
    e = table(spark, sf_dir, "events").where("event_type = 'error'")
    scope = F.element_at(F.array(*map(F.lit, ("local", "both", "remote"))), (F.col("event_id") % 3 + 1).cast("int"))
    channel = F.element_at(F.array(F.lit(None).cast("string"), F.lit("ex"), F.lit("ey"), F.lit("hx")), (F.col("event_id") % 4 + 1).cast("int"))
    banded = F.col("event_id") % 2 == 0
    return e.select(F.concat(F.lit("U"), (F.col("user_id") % 2).cast("string")).alias("site"), k.alias("a"), (k + F.col("event_id") % 5 + 1).alias("b"), F.when(banded, 2.0).alias("pmin"), F.when(banded, 8.0).alias("pmax"), scope.alias("scope"), channel.alias("channel"), F.element_at(F.array(*map(F.lit, ("time", "polar", "cluster"))), (F.col("event_id") % 3 + 1).cast("int")).alias("found_by"))


MASKS = """masks AS (
  SELECT 'U' || (user_id % 2) AS site, CAST(epoch_us(ts) // 3600000000 AS BIGINT) AS a, CAST(epoch_us(ts) // 3600000000 + event_id % 5 + 1 AS BIGINT) AS b,
    CASE WHEN event_id % 2 = 0 THEN 2.0::DOUBLE END AS pmin, CASE WHEN event_id % 2 = 0 THEN 8.0::DOUBLE END AS pmax,
    ['local', 'both', 'remote'][event_id % 3 + 1] AS scope, [NULL, 'ex', 'ey', 'hx'][event_id % 4 + 1] AS channel,
    ['time', 'polar', 'cluster'][event_id % 3 + 1] AS found_by
  FROM events WHERE event_type = 'error')"""


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product, site, period, zxy_re, zxy_im, zyx_re, zyx_im, zxy_err, zyx_err: transfer functions by supplier group and quantity."""
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 8).alias("p"), F.col("l_quantity").alias("period"), (F.col("l_extendedprice") / 10000).alias("e"), (F.col("l_discount") * 20).alias("d"), (F.col("l_tax") * 20).alias("t"))
    got = rows.groupBy("p", "period").agg(F.avg("e").alias("zxy_re"), F.avg("d").alias("zxy_im"), (-F.avg("t") - 1).alias("zyx_re"), (-F.avg("d") - F.avg("e") / 10).alias("zyx_im"), (F.stddev_samp("d") / 10).alias("zxy_err"), (F.stddev_samp("t") / 10).alias("zyx_err"))
    return got.where("zxy_err > 0 and zyx_err > 0").select(F.concat(F.lit("P"), F.col("p").cast("string")).alias("product"), F.concat(F.lit("T"), (F.col("p") % 4).cast("string")).alias("site"), "period", "zxy_re", "zxy_im", "zyx_re", "zyx_im", "zxy_err", "zyx_err")


PRODUCTS = """products AS (
  SELECT 'P' || p AS product, 'T' || (p % 4) AS site, period, zxy_re, zxy_im, zyx_re, zyx_im, zxy_err, zyx_err FROM (
    SELECT l_suppkey % 8 AS p, l_quantity AS period, avg(l_extendedprice / 10000) AS zxy_re, avg(l_discount * 20) AS zxy_im, -avg(l_tax * 20) - 1 AS zyx_re,
      -avg(l_discount * 20) - avg(l_extendedprice / 10000) / 10 AS zyx_im, stddev_samp(l_discount * 20) / 10 AS zxy_err, stddev_samp(l_tax * 20) / 10 AS zyx_err
    FROM lineitem GROUP BY 1, 2) WHERE zxy_err > 0 AND zyx_err > 0)"""


def sql(*parts: str) -> str:
    """Common table expressions, the last part being the query."""
    return "WITH " + ",\n".join(parts[:-1]) + "\n" + parts[-1]


def r6(c, name: str | None = None):
    """Rounded to six digits, not a number and infinities as null, no negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    out = F.round(F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(c), 6) + F.lit(0.0)
    return out.alias(name) if name else out


def q6(expression: str, name: str) -> str:
    return f"round(CASE WHEN isnan({expression}) OR isinf({expression}) THEN NULL ELSE {expression} END, 6) + 0.0::DOUBLE AS {name}"
