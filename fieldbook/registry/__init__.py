"""Named queries over the driver's tables, each with the SQL it is compared with."""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, tables: str = ""):
    """Register a query; ``tables`` names the derived tables its SQL starts from."""

    def wrap(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            from fieldbook.registry.tables import with_tables

            ORACLES[name] = with_tables(tables.split(), sql)
        return fn

    return wrap


def load_all() -> None:
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
