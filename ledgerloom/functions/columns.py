"""Small column helpers used everywhere."""

from __future__ import annotations

import operator
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(operator.and_, conditions)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(operator.or_, conditions)


def any_null(cols: list[str]) -> Column:
    return any_of(F.col(c).isNull() for c in cols)


def all_null(cols: list[str]) -> Column:
    return all_of(F.col(c).isNull() for c in cols)


def any_false(cols: list[str]) -> Column:
    return any_of(~F.coalesce(F.col(c), F.lit(True)) for c in cols)


def is_empty_value(c: str | Column) -> Column:
    """Null, 0 or text that reads as 0, whatever the column type."""
    x = as_col(c)
    return x.isNull() | F.coalesce(x.cast("string").try_cast("double") == 0, F.lit(False))


def sum0(c: str | Column) -> Column:
    """Sum that is 0, not null, for a group without values."""
    return F.coalesce(F.sum(as_col(c)), F.lit(0.0))


def sum_when(condition: Column, c: str | Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, as_col(c))), F.lit(0.0))


def columns_like(names: list[str], pattern: str) -> list[str]:
    """Column names that contain `pattern`."""
    return [n for n in names if pattern in n]


def case_when(branches: Iterable[tuple[Column, Column]], otherwise: Column) -> Column:
    """CASE expression of (condition, value) branches, the first true condition wins."""
    chain = None
    for condition, value in branches:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return otherwise if chain is None else chain.otherwise(otherwise)
