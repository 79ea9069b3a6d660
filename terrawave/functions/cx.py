"""Column helpers: complex numbers, angles, periods, clock and names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088

Complex = tuple[Column, Column]


def mul(a: Complex, b: Complex) -> Complex:
    return a[0] * b[0] - a[1] * b[1], a[0] * b[1] + a[1] * b[0]


def conj(a: Complex) -> Complex:
    return a[0], -a[1]


def add(*terms: Complex) -> Complex:
    return reduce(lambda x, y: (x[0] + y[0], x[1] + y[1]), terms)


def sub(a: Complex, b: Complex) -> Complex:
    return a[0] - b[0], a[1] - b[1]


def power(a: Complex) -> Column:
    return a[0] * a[0] + a[1] * a[1]


def div(a: Complex, b: Complex) -> Complex:
    """Null where b is zero."""
    n = F.nullif(power(b), F.lit(0.0))
    p = mul(a, conj(b))
    return p[0] / n, p[1] / n


def degrees(a: Complex) -> Column:
    return F.degrees(F.atan2(a[1], a[0]))


def right_divide(e: list[list[Complex]], h: list[list[Complex]]) -> list[list[Complex]]:
    """e h^-1 for 2x2 matrices; null where h is singular."""
    det = sub(mul(h[0][0], h[1][1]), mul(h[0][1], h[1][0]))
    inverse = [[h[1][1], (-h[0][1][0], -h[0][1][1])], [(-h[1][0][0], -h[1][0][1]), h[0][0]]]
    return [[div(add(mul(row[0], inverse[0][j]), mul(row[1], inverse[1][j])), det) for j in range(2)] for row in e]


def wrap(d: Column, period: float = 360.0) -> Column:
    """Into (-period/2, period/2]."""
    return d - period * F.ceil(d / period - 0.5)


def period_of(f_lo: Column, f_hi: Column) -> Column:
    return 1 / F.sqrt(f_lo * f_hi)


def quarter_decade(period: Column) -> Column:
    return F.floor(F.log10(period) * 4).cast("long")


def near_period(a: Column, b: Column, rtol: float) -> Column:
    return F.abs(a / b - 1) <= rtol


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(a))


def decimal_year(t: Column) -> Column:
    """Year and its elapsed part, of a timestamp in UTC."""
    start, end = F.make_date(F.year(t), F.lit(1), F.lit(1)), F.make_date(F.year(t) + 1, F.lit(1), F.lit(1))
    begin = F.unix_seconds(start.cast("timestamp"))
    return F.year(t) + (F.unix_micros(t.cast("timestamp")) / 1e6 - begin) / (F.unix_seconds(end.cast("timestamp")) - begin)


def site_name(name: Column) -> Column:
    """Upper case without leading zeros in its number."""
    return F.regexp_replace(F.upper(F.trim(name)), r"(^|\D)0+(\d)", "$1$2")


def dms(text: Column) -> Column:
    """Degrees from D:M:S, negative with a leading minus."""
    p = F.split(F.regexp_replace(text, "^-", ""), ":")
    value = p[0].cast("double") + p[1].cast("double") / 60 + p[2].cast("double") / 3600
    return F.when(text.startswith("-"), -value).otherwise(value)


def to_180(lon: Column) -> Column:
    return F.when(lon > 180, lon - 360).otherwise(lon)
