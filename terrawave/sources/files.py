"""Scans of recorder and observatory files into sample tables.

Text formats are parsed with Column functions on `spark.read.text`; the binary one is decoded by numpy in Arrow batches,
a file at a time. Lines that do not parse go to a rejects table, never silently away.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrawave.functions import cx
from terrawave.session import small

# Fields of a LEMI-424 line after its six time fields, and the bytes of a B423 file.
LEMI_CHANNELS = {"hx": 6, "hy": 7, "hz": 8, "ex": 11, "ey": 12}
LEMI_WIDTHS = (16, 24)
B423_HEADER = 1024
B423_RECORD = np.dtype([("time", "<u4"), ("tick", "<u2"), ("hx", "<i4"), ("hy", "<i4"), ("hz", "<i4"), ("ex", "<i4"), ("ey", "<i4"), ("sync", "i1"), ("stage", "u1"), ("crc", "<i2")])
MISSING_AT = 88888.0


def _text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))


def lemi424(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Samples (file, t, hx, hy, hz, ex, ey) at one a second, and rejected lines (file, value)."""
    lines = _text(spark, path).withColumn("f", F.split(F.trim("value"), r"\s+"))
    stamp = F.try_to_timestamp(F.concat_ws(" ", F.slice("f", 1, 6)), F.lit("y M d H m s"))
    parsed = lines.select("file", "value", F.size("f").alias("n"), stamp.alias("t"), *(F.expr(f"try_cast(get(f, {i}) as double)").alias(c) for c, i in LEMI_CHANNELS.items()))
    good = F.col("n").isin(*LEMI_WIDTHS) & F.col("t").isNotNull()
    for c in LEMI_CHANNELS:
        good = good & F.col(c).isNotNull()
    good = F.coalesce(good, F.lit(False))
    return parsed.where(good).select("file", "t", *LEMI_CHANNELS), parsed.where(~good & (F.trim("value") != "")).select("file", "value")


def pr6_24(spark: SparkSession, path: str) -> DataFrame:
    """Samples (station, stamp, channel, k, x): one integer a line, files named station, YYMMDDhhmmss and channel. A line without an integer is a missing sample; blank lines are none.

    Files are read by lines, in splits; a split's lines are numbered from the number of lines in the file's splits before it.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")).where(F.trim("value") != "")
    lines = lines.withColumn("n", F.monotonically_increasing_id())  # in the order of a split
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)  # a row for each split
    starts = lines.groupBy("file", "at").agg(F.count("*").alias("held")).select("file", "at", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("first"))
    rows = lines.withColumn("k", F.row_number().over(Window.partitionBy("file", "at").orderBy("n")) - 1).join(starts, ["file", "at"])
    name = F.regexp_extract("file", r"([^/]+)$", 1)
    channel = F.create_map(*(F.lit(x) for kv in {"BX": "hx", "BY": "hy", "BZ": "hz", "EX": "ex", "EY": "ey"}.items() for x in kv))
    stamp = F.try_to_timestamp(F.regexp_extract(name, r"(\d{12})\.", 1), F.lit("yyMMddHHmmss"))
    return rows.select(F.regexp_extract(name, r"^(.*?)(\d{12})\.", 1).alias("station"), stamp.alias("stamp"), channel[F.upper(F.regexp_extract(name, r"\.(\w+)$", 1))].alias("channel"), (F.col("first") + F.col("k")).cast("long").alias("k"), F.expr("try_cast(trim(value) as int)").alias("x"))


def b423(spark: SparkSession, path: str) -> DataFrame:
    """Records (file, k, time, tick, hx, hy, hz, ex, ey, sync, stage) of binary files; a partial record at the end is left out."""
    names = [n for n in B423_RECORD.names if n != "crc"]
    schema = "file string, k long, " + ", ".join(f"{n} long" for n in names)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                body = batch.column(1)[i].as_buffer()
                n = max(0, (body.size - B423_HEADER) // B423_RECORD.itemsize)
                records = np.frombuffer(body, B423_RECORD, n, B423_HEADER) if n else np.empty(0, B423_RECORD)
                for s in range(0, n, 100_000):
                    part = records[s : s + 100_000]
                    columns = [pa.array([batch.column(0)[i].as_py()] * len(part)), pa.array(np.arange(s, s + len(part)))]
                    yield pa.RecordBatch.from_arrays([*columns, *(pa.array(part[c].astype(np.int64)) for c in names)], ["file", "k", *names])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, schema)


def unreadable(records: DataFrame, files: DataFrame, rate: float, least_share: float = 0.01) -> DataFrame:
    """file, reason for files (file, seconds) that hold no record or less than a share of their interval."""
    held = records.groupBy("file").agg(F.count("*").alias("n"))
    share = F.coalesce("n", F.lit(0)) / (F.col("seconds") * rate)
    return files.join(held, "file", "left").where(share < least_share).select("file", F.when(F.col("n").isNull(), "no record").otherwise("short").alias("reason"))


def _iaga_header(lines: DataFrame, name: str) -> DataFrame:
    """file and the text of a header line, by the beginning of its name."""
    return lines.where(F.col("value").rlike(rf"(?i)^ *{name}")).groupBy("file").agg(F.first(F.trim(F.regexp_replace(F.substring("value", 24, 46), r"\|", ""))).alias("text"))


def iaga2002(spark: SparkSession, path: str) -> DataFrame:
    """Rows (code, t, x, y, z, f) of observatory day files; values of 88888 and more, and fields that are no numbers, are missing; times go down to the second. Lines without a time are left out."""
    lines = _text(spark, path)
    code = _iaga_header(lines, "IAGA CODE").select("file", F.col("text").alias("code"))
    rows = lines.where(F.col("value").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d")).withColumn("p", F.split(F.trim("value"), r"\s+"))
    value = {c: F.expr(f"try_cast(get(p, {i + 3}) as double)") for i, c in enumerate("xyzf")}
    time = F.date_trunc("second", F.try_to_timestamp(F.concat_ws(" ", F.col("p")[0], F.col("p")[1])))
    rows = rows.select("file", time.alias("t"), *(F.when(F.abs(v) < MISSING_AT, v).alias(c) for c, v in value.items())).where("t is not null")
    return rows.join(small(code), "file").select("code", "t", "x", "y", "z", "f")


def iaga2002_positions(spark: SparkSession, path: str) -> DataFrame:
    """file, lat, lon of the headers of observatory day files, degrees, longitudes from -180 to 180; null where a header has no number."""
    lines = _text(spark, path)
    lat, lon = (_iaga_header(lines, f"GEODETIC {name}").select("file", F.expr("try_cast(text as double)").alias(c)) for name, c in (("LATITUDE", "lat"), ("LONGITUDE", "lon")))
    return lat.join(lon, "file", "full").select("file", "lat", cx.to_180(F.col("lon")).alias("lon"))


def observatory(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """One-second observatory Parquet (DateTime, BX, BY, BZ, F, pub) from start up to end; the filter reaches the scan."""
    rows = spark.read.parquet(path)
    if start is not None:
        rows = rows.where(F.col("DateTime") >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col("DateTime") < F.lit(end))
    return rows.select(F.col("DateTime").alias("t"), F.col("BX").alias("x"), F.col("BY").alias("y"), F.col("BZ").alias("z"), F.col("F").alias("f"))


def complete_days(rows: DataFrame, fill: float = 99999.0) -> DataFrame:
    """Every second of each day that has a row, missing values filled."""
    days = rows.select(F.to_date("t").alias("day")).distinct()
    grid = days.select("day", F.explode(F.sequence(F.lit(0), F.lit(86399))).alias("s")).select((F.unix_seconds(F.col("day").cast("timestamp")) + F.col("s")).alias("sec"))
    held = rows.withColumn("sec", F.unix_seconds(F.col("t").cast("timestamp"))).groupBy("sec").agg(*(F.first(c, True).alias(c) for c in "xyzf"))
    return grid.join(held, "sec", "left").select(F.timestamp_seconds("sec").alias("t"), *(F.coalesce(c, F.lit(fill)).alias(c) for c in "xyzf"))


def day_coverage(rows: DataFrame) -> DataFrame:
    """day, cached for each UTC day from the first row to the last."""
    held = rows.select(F.to_date("t").alias("day")).distinct().withColumn("cached", F.lit(True))
    span = held.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    return span.select(F.explode(F.sequence("a", "b")).alias("day")).join(held, "day", "left").select("day", F.coalesce("cached", F.lit(False)).alias("cached"))
