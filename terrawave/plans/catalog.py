"""Registry of named queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
_MODULES = ["arrays", "cleaning", "field", "intervals", "products", "quality", "records", "screens", "tensors", "transfer", "welch"]


def query(name: str, sql: str | None = None):
    """Register fn(spark, sf_dir) under name, with the SQL that gives the same rows."""

    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def load() -> None:
    import importlib

    for module in _MODULES:
        importlib.import_module(f"terrawave.plans.{module}")


def queries() -> dict[str, Callable]:
    load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load()
    return dict(ORACLES)
