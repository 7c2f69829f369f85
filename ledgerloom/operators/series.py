"""Dated series, fills and section slices.

Series functions take a table with one row per key and date (see `to_series`), so a window
partition is bounded by the calendar. Fills over sheets of any length work on fixed row
ranges and carry the last value from range to range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_col
from ledgerloom.operators.joins import join_keys


def to_series(df: DataFrame, keys: list[str], date: str | Column, value: str | Column,
              period: str = "period", out: str = "value") -> DataFrame:
    """Mean value per key and calendar date."""
    return df.groupBy(*keys, as_col(date).cast("date").alias(period)).agg(F.avg(as_col(value)).alias(out))


def _by(keys: list[str], period: str, descending: bool = False):
    return Window.partitionBy(*keys).orderBy(F.desc(period) if descending else F.asc(period))


def rolling_mean(df: DataFrame, keys: list[str], period: str, value: str, rows: int,
                 full_window: bool = False) -> Column:
    """Mean of the last `rows` rows; null before the window is full if that is required."""
    w = _by(keys, period).rowsBetween(-(rows - 1), 0)
    mean = F.avg(value).over(w)
    return F.when(F.count(value).over(w) == rows, mean) if full_window else mean


def rolling_std(df: DataFrame, keys: list[str], period: str, value: str, rows: int) -> Column:
    """Sample deviation of the last `rows` rows, null before the window is full."""
    w = _by(keys, period).rowsBetween(-(rows - 1), 0)
    return F.when(F.count(value).over(w) == rows, F.stddev_samp(value).over(w))


def pct_change(keys: list[str], period: str, value: str) -> Column:
    """Change against the previous row, null on the first."""
    return F.try_divide(F.col(value), F.lag(value).over(_by(keys, period))) - 1


def volatility(df: DataFrame, keys: list[str], period: str, value: str, horizons: dict[str, int | None],
               strict: bool = False) -> DataFrame:
    """Sample deviation (x100) of the changes over the last N rows, one column per horizon.

    By default a series counts its first change as 0 and a horizon may be longer than the
    series. `strict` leaves the first change of each horizon out and asks for N rows, else
    the result is null. A horizon of None means the whole series.
    """
    change = pct_change(keys, period, value)
    rows = df.withColumns({
        "__change": change if strict else F.coalesce(change, F.lit(0.0)),
        "__age": F.row_number().over(_by(keys, period, descending=True)),
    })
    out = []
    for name, n in horizons.items():
        if not strict:
            inside = F.lit(True) if n is None else F.col("__age") <= n
            out.append((F.stddev_samp(F.when(inside, F.col("__change"))) * 100).alias(name))
        elif n is None:
            out.append((F.stddev_samp("__change") * 100).alias(name))
        else:
            inside = F.col("__age") <= n - 1
            enough = F.count(F.when(inside, F.col("__change"))) == n - 1
            out.append(F.when(enough, F.stddev_samp(F.when(inside, F.col("__change"))) * 100).alias(name))
    return rows.groupBy(*keys).agg(*out)


def cross_rate(df: DataFrame, pair: str, period: str, value: str, first: str, second: str, name: str) -> DataFrame:
    """Append the series second/first computed on the dates both are quoted."""
    a = df.where(F.col(pair) == first).select(F.col(period), F.col(value).alias("__a"))
    b = df.where(F.col(pair) == second).select(F.col(period), F.col(value).alias("__b"))
    crossed = a.join(b, period).select(
        F.lit(name).alias(pair), F.col(period), (F.try_divide(F.lit(1.0), F.col("__a")) * F.col("__b")).alias(value))
    return df.select(pair, period, value).unionByName(crossed)


def _fill(df: DataFrame, keys: list[str], order: str, cols: list[str], forward: bool, chunk: int) -> DataFrame:
    direction = F.asc if forward else F.desc
    ranged = df.withColumn("__range", F.floor(F.col(order) / F.lit(chunk)).cast("long"))
    near = Window.partitionBy(*keys, "__range").orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, 0)
    pick = F.max_by if forward else F.min_by
    edges = ranged.groupBy(*keys, "__range").agg(*[
        pick(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"__edge_{c}") for c in cols])
    before = Window.partitionBy(*keys).orderBy(direction("__range")).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(*keys, "__range", *[
        F.last(f"__edge_{c}", ignorenulls=True).over(before).alias(f"__carry_{c}") for c in cols])
    within = ranged.withColumns({f"__in_{c}": F.last(c, ignorenulls=True).over(near) for c in cols})
    joined = join_keys(within, carried, [*keys, "__range"], "left")
    return joined.withColumns({c: F.coalesce(f"__in_{c}", f"__carry_{c}") for c in cols}).drop(
        "__range", *[f"__in_{c}" for c in cols], *[f"__carry_{c}" for c in cols])


def forward_fill(df: DataFrame, keys: list[str], order: str, cols: list[str], chunk: int = 65_536) -> DataFrame:
    """Nulls take the last value above them; `order` is the integer row number of the sheet."""
    return _fill(df, keys, order, cols, True, chunk)


def backward_fill(df: DataFrame, keys: list[str], order: str, cols: list[str], chunk: int = 65_536) -> DataFrame:
    """Nulls take the next value below them."""
    return _fill(df, keys, order, cols, False, chunk)


def section_slice(df: DataFrame, keys: list[str], order: str, start: Column, end: Column,
                  include_end: bool = True) -> DataFrame:
    """Rows of a sheet from its first start marker to the first end marker after it.

    Sheets without a start marker give nothing; without an end marker the section runs on.
    """
    starts = df.where(start).groupBy(*keys).agg(F.min(order).alias("__start"))
    opened = join_keys(df, starts, keys, "inner").where(F.col(order) >= F.col("__start"))
    ends = opened.where(end & (F.col(order) > F.col("__start"))).groupBy(*keys).agg(F.min(order).alias("__end"))
    bounded = join_keys(opened, ends, keys, "left")
    last = F.col(order) <= F.col("__end") if include_end else F.col(order) < F.col("__end")
    return bounded.where(F.col("__end").isNull() | last).drop("__start", "__end")
