"""Declared corrections of channels, runs and products. Declarations are tables by site; a site without one stays as it is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrawave.operators.intervals import overlap_join


def signs_flipped(rows: DataFrame, declared: DataFrame, x: str = "x") -> DataFrame:
    """rows(site, channel, x) with the sign of declared(site, channel) turned."""
    mark = declared.select("site", "channel").distinct().withColumn("_flip", F.lit(True))
    return rows.join(mark, ["site", "channel"], "left").withColumn(x, F.when(F.col("_flip"), -F.col(x)).otherwise(F.col(x))).drop("_flip")


def exchanged(rows: DataFrame, declared: DataFrame) -> DataFrame:
    """rows(site, channel, ...) with the channels one and other of declared(site, one, other) exchanged, and all that stands beside them, calibration included."""
    both = declared.select("site", F.col("one").alias("channel"), F.col("other").alias("_to")).unionByName(declared.select("site", F.col("other").alias("channel"), F.col("one").alias("_to")))
    return rows.join(both, ["site", "channel"], "left").withColumn("channel", F.coalesce("_to", "channel")).drop("_to")


def rotated(rows: DataFrame, degrees: Column, x: str, y: str) -> DataFrame:
    """The pair x, y turned by an angle."""
    c, s = F.cos(F.radians(degrees)), F.sin(F.radians(degrees))
    return rows.withColumn("_x", c * F.col(x) + s * F.col(y)).withColumn(y, c * F.col(y) - s * F.col(x)).withColumn(x, F.col("_x")).drop("_x")


def rotated_in_parts(rows: DataFrame, parts: DataFrame, x: str, y: str, width: int, k: str = "k") -> DataFrame:
    """rows(site, k, ..) turned by the angle of the part(site, a2, b2, degrees) that they lie in, with the part's start as `part`; rows in no part are left out."""
    spans = rows.withColumn("a", F.col(k)).withColumn("b", F.col(k) + 1)
    found = overlap_join(spans, parts, ["site"], width)
    return rotated(found, F.col("degrees"), x, y).withColumnRenamed("a2", "part").drop("a", "b", "b2", "degrees")


def levelled(rows: DataFrame, vector: tuple[Column, Column, Column], names: tuple[str, str, str]) -> DataFrame:
    """Three channels turned about a rotation vector (radians along its axis), by Rodrigues' formula; no turn for a vector of no length."""
    angle = F.sqrt(sum(v * v for v in vector))
    axis = [F.coalesce(v / F.nullif(angle, F.lit(0.0)), F.lit(0.0)) for v in vector]
    h = [F.col(n) for n in names]
    along = sum(a * x for a, x in zip(axis, h, strict=True))
    turned = [h[i] * F.cos(angle) + (axis[(i + 1) % 3] * h[(i + 2) % 3] - axis[(i + 2) % 3] * h[(i + 1) % 3]) * F.sin(angle) + axis[i] * along * (1 - F.cos(angle)) for i in range(3)]
    rows = rows.select("*", *(t.alias(f"_{n}") for t, n in zip(turned, names, strict=True)))
    for n in names:
        rows = rows.withColumn(n, F.col(f"_{n}")).drop(f"_{n}")
    return rows


def from_lines(rows: DataFrame, x_bearing: Column, y_bearing: Column, x: str, y: str) -> DataFrame:
    """North and east from two lines laid at bearings (degrees from north): the inverse of the matrix of their direction cosines; null where the lines are parallel."""
    a, b, c, d = F.cos(F.radians(x_bearing)), F.sin(F.radians(x_bearing)), F.cos(F.radians(y_bearing)), F.sin(F.radians(y_bearing))
    det = a * d - b * c
    det = F.when(F.abs(det) > 1e-9, det)
    return rows.withColumn("_x", (d * F.col(x) - b * F.col(y)) / det).withColumn(y, (a * F.col(y) - c * F.col(x)) / det).withColumn(x, F.col("_x")).drop("_x")


def clock_shifted(runs: DataFrame, offsets: DataFrame, columns: tuple[str, ...] = ("a", "b")) -> DataFrame:
    """Runs with all stamps moved by the offset of offsets(site, offset)."""
    rows = runs.join(offsets, "site", "left")
    for c in columns:
        rows = rows.withColumn(c, F.col(c) + F.coalesce("offset", F.lit(0)))
    return rows.drop("offset")


def clipped(runs: DataFrame, windows: DataFrame) -> DataFrame:
    """Runs cut to start <= t < end of windows(site, start, end), ends optional; runs wholly outside are left out."""
    rows = runs.join(windows, "site", "left")
    rows = rows.withColumn("a", F.greatest("a", F.coalesce("start", "a"))).withColumn("b", F.least("b", F.coalesce("end", "b")))
    return rows.drop("start", "end").where("a < b")


def channels_kept(rows: DataFrame, declared: DataFrame) -> DataFrame:
    """Rows of the channels in declared(site, channels); all of a site without a list."""
    return rows.join(declared, "site", "left").where(F.col("channels").isNull() | F.array_contains("channels", F.col("channel"))).drop("channels")


def diagonal(rows: DataFrame, sign: Column, x: str = "ex", y: str = "ey") -> DataFrame:
    """The line between the ends of two: x - sign y."""
    return rows.withColumn("diagonal", F.col(x) - sign * F.col(y))


def diagonal_geometry(x_length: Column, x_azimuth: Column, y_length: Column, y_azimuth: Column, sign: Column) -> tuple[Column, Column]:
    """Length and azimuth (degrees from north) of a diagonal line."""
    north = x_length * F.cos(F.radians(x_azimuth)) - sign * y_length * F.cos(F.radians(y_azimuth))
    east = x_length * F.sin(F.radians(x_azimuth)) - sign * y_length * F.sin(F.radians(y_azimuth))
    return F.sqrt(x_length * x_length + y_length * y_length), F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0))


def as_laid(products: DataFrame, reversed_lines: DataFrame, rows_of: dict[str, list[str]]) -> DataFrame:
    """Products(site, ...) with the elements of each line in reversed_lines(site, channel) negated; errors stay."""
    turned = reversed_lines.groupBy("site").agg(F.collect_set("channel").alias("_lines"))  # two lines of a site at most
    out = products.join(turned, "site", "left")
    for channel, names in rows_of.items():
        turn = F.coalesce(F.array_contains("_lines", F.lit(channel)), F.lit(False))
        for n in names:
            out = out.withColumn(n, F.when(turn, -F.col(n)).otherwise(F.col(n)))
    return out.drop("_lines")


def long_enough(products: DataFrame, least: int, windows: str = "n_windows") -> DataFrame:
    """Products without the periods that rest on fewer than so many windows."""
    return products.where(F.col(windows) >= least)


def in_range(products: DataFrame, shortest: float | None = None, longest: float | None = None) -> DataFrame:
    """Products of periods in a range whose bounds are optional."""
    for bound, keep in ((shortest, lambda b: F.col("period") >= b), (longest, lambda b: F.col("period") <= b)):
        if bound is not None:
            products = products.where(keep(bound))
    return products
