from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_col
from ledgerloom.sources.tables import Tables

MODULES = ["scans", "filters", "joins", "groups", "windows", "scalars", "reshaping", "domain", "checks",
           "reports", "reconciliations", "differences", "large"]

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query over `Tables` with its reference SQL."""
    def add(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return add


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"ledgerloom.catalog.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(fn):
        return lambda spark, folder: fn(Tables(spark, folder))

    return {name: bind(fn) for name, fn in _QUERIES.items()}


def oracles() -> dict[str, str]:
    _load()
    return dict(_SQL)


def module_of(name: str) -> str:
    return _QUERIES[name].__module__


def num(c: str | Column, digits: int = 2) -> Column:
    """Rounded output value without a negative zero."""
    return F.round(as_col(c), digits) + F.lit(0.0)


def settled(c: str | Column, digits: int = 2) -> Column:
    """Rounded as a decimal with three spare digits, where sums of floats land next to exact halves."""
    return F.round(as_col(c).cast(f"decimal(28,{digits + 3})"), digits).cast("double") + F.lit(0.0)


def settled_sql(expression: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(28, {digits + 3})), {digits}) AS DOUBLE)"


def usd(c: str | Column) -> Column:
    """Converted amount in cents."""
    return num(c, 2)


def text(c: str | Column) -> Column:
    return as_col(c).cast("string")
