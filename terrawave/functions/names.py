"""Names, notes and clocks as Column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Days on which GPS time gained a second on UTC.
LEAP_DAYS = ("1981-07-01", "1982-07-01", "1983-07-01", "1985-07-01", "1988-01-01", "1990-01-01", "1991-01-01", "1992-07-01", "1993-07-01", "1994-07-01", "1996-01-01", "1997-07-01", "1999-01-01", "2006-01-01", "2009-01-01", "2012-07-01", "2015-07-01", "2017-01-01")


def gps_to_utc(seconds: Column) -> Column:
    """UTC seconds since 1970 of GPS seconds since 1980-01-06."""
    at = seconds + 315964800
    leaps = sum((at - i >= F.unix_date(F.lit(day).cast("date")) * 86400).cast("long") for i, day in enumerate(LEAP_DAYS))
    return at - leaps


def local_seconds(seconds: Column, zone: str) -> Column:
    """Seconds on the zone's clock since 1970-01-01 there, of UTC seconds; the session's zone plays no part."""
    clock = F.convert_timezone(F.lit("UTC"), F.lit(zone), _clock(seconds))
    return F.unix_date(clock.cast("date")).cast("long") * 86400 + F.hour(clock) * 3600 + F.minute(clock) * 60 + F.floor(F.second(clock))


def _clock(seconds: Column) -> Column:
    """A time without a zone, so many seconds after 1970-01-01."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days=F.floor(seconds / 86400).cast("int"), secs=F.pmod(seconds, F.lit(86400)).cast("decimal(18,6)"))


def seconds_at(local: Column, zone: str) -> Column:
    """UTC seconds at which the zone's clock shows so many seconds since 1970-01-01 there; of a time shown twice the earlier."""
    clock = F.convert_timezone(F.lit(zone), F.lit("UTC"), _clock(local))
    return F.unix_date(clock.cast("date")).cast("long") * 86400 + F.hour(clock) * 3600 + F.minute(clock) * 60 + F.floor(F.second(clock))


def local_hour(at: Column, zone: str) -> Column:
    """Hour of the zone's clock at an instant."""
    return F.pmod(F.floor(local_seconds(F.unix_seconds(at), zone) / 3600), F.lit(24)).cast("int")


SECOND = 1_000_000_000  # nanoseconds


def seconds(ns: Column) -> tuple[Column, Column]:
    """Whole seconds and the nanoseconds left, as longs; nanoseconds may be decimals beyond a long."""
    ns = ns.cast("decimal(24,0)")
    return F.floor(ns / SECOND).cast("long"), F.pmod(ns, F.lit(SECOND).cast("decimal(24,0)")).cast("long")


def ceil_index(ns: Column, rate: Column) -> Column:
    """Index of the first sample at or after so many nanoseconds from the origin, for a whole number of samples a second; whole seconds and the rest are counted apart, so that nothing overflows or is rounded."""
    whole, rest = seconds(ns)
    up = rest * rate + (SECOND - 1)
    return whole * rate + ((up - F.pmod(up, F.lit(SECOND))) / SECOND).cast("long")


def time_of(index: Column, rate: Column) -> Column:
    """Nanoseconds from the origin of a sample, rounded to the nearest, halves up."""
    whole = F.floor(index.cast("decimal(20,0)") / rate).cast("long")
    rest = F.pmod(index.cast("long"), rate.cast("long")) * SECOND * 2 + rate
    return whole * SECOND + ((rest - F.pmod(rest, 2 * rate.cast("long"))) / (2 * rate)).cast("long")


def station_key(name: Column) -> Column:
    """A station's name as it is compared: without a trailing _ or -, in lower case, each run of digits as the number it writes."""
    return F.regexp_replace(F.lower(F.regexp_replace(name, "[_-]+$", "")), r"(?<![0-9])0+(?=[0-9])", "")


def note_values(note: Column) -> Column:
    """A map of the `key: value` items of a note, parted by semicolons, without blanks about them; of a repeated key the last."""
    items = F.filter(F.transform(F.split(note, ";"), lambda x: F.array(F.lower(F.trim(F.substring_index(x, ":", 1))), F.trim(F.regexp_replace(x, r"^[^:]*:", "")), (F.instr(x, ":") > 0).cast("string"))), lambda z: z[2] == "true")
    return F.map_from_entries(F.reverse(F.aggregate(F.reverse(items), F.array().cast("array<struct<k:string,v:string>>"), lambda acc, z: F.when(F.exists(acc, lambda e: e["k"] == z[0]), acc).otherwise(F.concat(acc, F.array(F.struct(z[0].alias("k"), z[1].alias("v"))))))))


def product_stem(stem: Column) -> tuple[Column, Column, Column, Column]:
    """local, remote, stamp and tag of `<local>_rr-<remote>_<stamp>[_tag]`; null where the name is another."""
    pattern = r"^(.+?)_rr-(.+?)_(\d{8}T?\d*)(?:_(.+))?$"
    return tuple(F.nullif(F.regexp_extract(stem, pattern, i), F.lit("")) for i in (1, 2, 3, 4))
