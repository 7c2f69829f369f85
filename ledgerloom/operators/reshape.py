"""Pivots, melts, matrices and stacked halves. Pivot values are always given, never looked up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.grouping import with_group_value


def pivot_sum(df: DataFrame, keys: list[str], column: str, values: list[str], value: str,
              fill: float | None = None) -> DataFrame:
    """Long to wide with sums; absent cells are null, or `fill`."""
    wide = df.groupBy(*keys).pivot(column, values).agg(F.sum(value))
    return wide if fill is None else wide.na.fill(fill, subset=[str(v) for v in values])


def melt_pairs(df: DataFrame, ids: list[str], groups: dict[str, tuple[str, str]]) -> DataFrame:
    """Unpivot (value, date) column pairs together: columns source, value, date."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(name).alias("source"), F.col(v).alias("value"), F.col(d).alias("date"))
        for name, (v, d) in groups.items()
    ]))
    return df.select(*ids, rows.alias("r")).select(*ids, "r.*")


def melt(df: DataFrame, ids: list[str], cols: list[str], name: str = "variable", value: str = "value") -> DataFrame:
    return df.unpivot(ids, cols, name, value)


def transpose(df: DataFrame, name: str, rows: list[str], cols: list[str]) -> DataFrame:
    """Swap rows and columns of a small summary whose row names are known."""
    long = df.select(name, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot([name], cols, "column", "value")
    return long.groupBy("column").pivot(name, rows).agg(F.first("value", ignorenulls=True))


def stack_halves(df: DataFrame, left: dict[str, str], right: dict[str, str], classes: tuple[str, str]) -> DataFrame:
    """Side-by-side halves of a sheet as one table with a class label, in one pass.

    `left` and `right` map source columns to the shared output names, in the same order.
    """
    halves = F.explode(F.array(*[
        F.struct(F.lit(label).alias("class_name"), *[F.col(c).alias(n) for c, n in cols.items()])
        for label, cols in zip(classes, (left, right))
    ]))
    keep = [c for c in df.columns if c not in left and c not in right]
    return df.select(*keep, halves.alias("h")).select(*keep, "h.*")


def exposure_matrix(df: DataFrame, keys: list[str], row: str, column: str, segments: list[str], value: str) -> DataFrame:
    """Row segment by column segment sums per key, zero where nothing is due."""
    return pivot_sum(df, [*keys, row], column, segments, value, fill=0.0)


def ordered_pivot(df: DataFrame, group: str, item: str, column: str, values: list[str], value: str,
                  rank_by: Column) -> DataFrame:
    """Item by column sums with sort positions: group total first, then item total within it."""
    wide = pivot_sum(df, [group, item], column, values, value, fill=0.0)
    ranked = wide.withColumn("item_total", rank_by)
    return with_group_value(ranked, [group], group_total=F.sum("item_total"))
