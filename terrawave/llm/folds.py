"""Held-out folds and bounded samples by hash of the id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0)).cast("int")


def sample(rows: DataFrame, most: int, seed: int = 7) -> DataFrame:
    """About `most` rows at most, chosen by a hash of doc_id; all rows if there are no more."""
    n = rows.count()
    if n <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) < int((1 << 30) * most / n))
