"""Listings of files as tables: which recorder wrote a file and when, which one a site is read by, and facts that are read again only where a file changed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrawave.functions.names import gps_to_utc

#: The names of each recorder's data files, in the order in which recorders are taken.
KINDS = (
    ("lemi423", r"(?i)^\d+\.b423$"),
    ("lemi424", r"(?i)^\d{12}\.txt$"),
    ("edl", r"(?i)^.*\d{12}\.(bx|by|bz|ex|ey)$"),
    ("phoenix", r"(?i)^\d+_[0-9a-f]{8}_\d+_[0-9a-f]{8}\.(td_150|td_30|td_24k)$"),
    ("orangebox", r"(?i)^(hfm|lp)\d+-\d+\.bin(\.old)?$"),
    ("mtu5a", r"(?i)^.+\.ts4$"),
)


def kind(name: Column) -> Column:
    """The recorder whose data files are so named; null for others and for the ._ twins that some systems leave."""
    out = F.when(name.startswith("._"), None)
    for k, pattern in KINDS:
        out = out.when(name.rlike(pattern), k)
    return out


def evidence(name: Column) -> Column:
    """As `kind`; a recorder's own settings file counts too."""
    return F.when(F.lower(name) == "recorder.ini", "edl").otherwise(kind(name))


def recorder(files: DataFrame, keys: list[str], prefer: str = "lemi423", name: str = "name") -> DataFrame:
    """keys, recorder: of each folder with files of a recorder, the preferred one where it left any, else the first in the order of KINDS."""
    if prefer not in dict(KINDS):
        raise ValueError(f"unknown recorder {prefer}")
    place = F.lit(None).cast("int")
    for i, (k, _) in enumerate(KINDS):
        place = F.when(F.col("_kind") == k, -1 if k == prefer else i).otherwise(place)
    seen = files.select(*keys, evidence(F.col(name)).alias("_kind")).where("_kind is not null").withColumn("_place", place)
    return seen.groupBy(*keys).agg(F.min_by("_kind", "_place").alias("recorder"))


def named_time(name: Column) -> Column:
    """UTC seconds since 1970 that a data file's name tells: an epoch, a stamp YYMMDDhhmmss at the end of the stem, or GPS seconds in hex; null where it tells none or no such time exists."""
    k = kind(name)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    stamp = F.regexp_extract(stem, r"(\d{12})$", 1)
    part = [F.substring(stamp, i, 2).cast("int") for i in range(1, 12, 2)]
    day = F.try_to_date(F.concat(F.lit("20"), F.substring(stamp, 1, 6)), "yyyyMMdd")
    clock = F.when((part[3] < 24) & (part[4] < 60) & (part[5] < 60), part[3] * 3600 + part[4] * 60 + part[5])
    gps = F.conv(F.split(name, "_")[1], 16, 10).cast("long")
    return F.when(k == "lemi423", F.try_to_number(stem, F.lit("9999999999999999")).cast("long")).when(k.isin("lemi424", "edl"), F.unix_date(day).cast("long") * 86400 + clock).when(k == "phoenix", gps_to_utc(gps))


def refreshed(listing: DataFrame, index: DataFrame, read: Callable[[DataFrame], DataFrame], name: str = "name", stamp: tuple[str, ...] = ("mtime", "size")) -> DataFrame:
    """The index of the files listed now: rows of the old index whose file has the same stamp are kept, the others are read by read(files) -> name and facts.

    Files that are gone leave it; files that read gives no row for are listed without facts and with read = false, and are read again next time. listing holds a name once.
    """
    facts = [c for c in index.columns if c not in (name, *stamp, "read")]
    known = index.where("read") if "read" in index.columns else index
    kept = listing.select(name, *stamp).join(known.select(name, *stamp, *facts), [name, *stamp])
    changed = listing.join(known, [name, *stamp], "left_anti")
    fresh = read(changed).select(name, *facts).withColumn("_read", F.lit(True))
    new = changed.select(name, *stamp).join(fresh, name, "left").withColumn("read", F.coalesce("_read", F.lit(False))).drop("_read")
    return kept.withColumn("read", F.lit(True)).unionByName(new)
