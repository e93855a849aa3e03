"""Every operator applied to the given tables, each with the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

MODULES = ("demand", "rows", "balance", "quality", "ingest", "star")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and the SQL it is compared with."""

    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return keep


def load() -> None:
    for module in MODULES:
        import_module(f"{__name__}.{module}")
