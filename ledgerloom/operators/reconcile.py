"""Comparing two copies of the same data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import all_of, sum0
from ledgerloom.functions.measures import differs, signed_pct
from ledgerloom.operators.joins import join_keys
from ledgerloom.session import staged


def reconcile(
    left: DataFrame, right: DataFrame, keys: list[str], left_value: str, right_value: str,
    tolerance: float = 0.4, fill: float | None = 0.0, flag: str = "differs",
) -> DataFrame:
    """Full join of two sums on shared keys, null keys matching, with a tolerance flag.

    Both sides are summed per key first, so a key meets itself at most once whatever its size.
    """
    a = left.groupBy(*keys).agg(sum0(left_value).alias(left_value))
    b = right.groupBy(*keys).agg(sum0(right_value).alias(right_value))
    both = join_keys(a, b, keys, "full")
    if fill is not None:
        both = both.na.fill(fill, subset=[left_value, right_value])
    return both.withColumn(flag, differs(left_value, right_value, tolerance))


def mirror_pairs(pairs: DataFrame, a: str, b: str, keys: list[str], values: list[str]) -> DataFrame:
    """Each A->B row with the values of its B->A row (null where there is none).

    `pairs` must hold one row per (a, b, keys). Both directions of a pair meet in one group
    of at most two rows, so the table is read once and not joined with itself. Rows with a
    missing party or key have no mirror; they are another part of the result, so `pairs` is written
    once, not made twice.
    """
    pairs = staged(pairs, "pairs")
    named = {v: f"{v}_mirror" for v in values}
    known = all_of(F.col(c).isNotNull() for c in (a, b, *keys))
    row = F.struct(*values)
    both = pairs.where(known).groupBy(F.least(a, b).alias("__lo"), F.greatest(a, b).alias("__hi"), *keys).agg(
        F.max(F.when(F.col(a) <= F.col(b), row)).alias("__up"), F.max(F.when(F.col(a) > F.col(b), row)).alias("__down"))
    same = F.col("__lo") == F.col("__hi")

    def direction(source: str, target: str, own: Column, other: Column) -> Column:
        return F.struct(F.col(source).alias(a), F.col(target).alias(b), own.alias("own"), other.alias("other"))

    rows = both.select(*keys, F.explode(F.array(
        direction("__lo", "__hi", F.col("__up"), F.when(same, F.col("__up")).otherwise(F.col("__down"))),
        direction("__hi", "__lo", F.col("__down"), F.col("__up")),
    )).alias("r")).where(F.col("r.own").isNotNull())
    mirrored = rows.select(
        F.col(f"r.{a}").alias(a), F.col(f"r.{b}").alias(b), *keys, *[F.col(f"r.own.{v}").alias(v) for v in values],
        *[F.col(f"r.other.{v}").alias(m) for v, m in named.items()])
    types = dict(pairs.dtypes)
    alone = pairs.where(~known).select(
        a, b, *keys, *values, *[F.lit(None).cast(types[v]).alias(m) for v, m in named.items()])
    return mirrored.unionByName(alone)


def drop_mirrored(df: DataFrame, a: str, b: str, keys: list[str], only_right: str) -> DataFrame:
    """Drop right-only rows (flag column) whose row with swapped parties exists."""
    twins = df.select(
        F.col(a).alias("__b"), F.col(b).alias("__a"), *[F.col(k).alias(f"__k_{k}") for k in keys],
    ).distinct()
    on = {a: "__a", b: "__b"} | {k: f"__k_{k}" for k in keys}
    return join_keys(df, twins, on, "left_anti", extra=F.col(only_right))


def period_diff(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Old and new value per key with difference and signed share of the old magnitude."""
    a = old.groupBy(*keys).agg(sum0(value).alias(f"{value}_old"))
    b = new.groupBy(*keys).agg(sum0(value).alias(f"{value}_new"))
    both = join_keys(a, b, keys, "full").na.fill(0.0, subset=[f"{value}_old", f"{value}_new"])
    return both.withColumns({
        f"{value}_diff": F.col(f"{value}_new") - F.col(f"{value}_old"),
        f"{value}_pct_diff": signed_pct(f"{value}_old", f"{value}_new"),
    })


def agreement(left: DataFrame, right: DataFrame, keys: list[str], attributes: dict[str, str]) -> DataFrame:
    """Full join of two attribute tables with an equality flag per attribute.

    `attributes` maps left to right columns; a missing value on either side is no agreement.
    """
    both = join_keys(left, right, keys, "full")
    flags = {f"{l}_equal": F.coalesce(F.col(l) == F.col(r), F.lit(False)) for l, r in attributes.items()}
    return both.withColumns(flags)


def coverage(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of both sides labelled 'both', 'left_only' or 'right_only'.

    One grouped pass over the two key columns: a hot key is combined before the shuffle.
    """
    tagged = left.select(*keys, F.lit(1).alias("__l"), F.lit(0).alias("__r")).unionByName(
        right.select(*keys, F.lit(0).alias("__l"), F.lit(1).alias("__r")))
    seen = tagged.groupBy(*keys).agg(F.max("__l").alias("__l"), F.max("__r").alias("__r"))
    side = (F.when((F.col("__l") == 1) & (F.col("__r") == 1), "both")
            .when(F.col("__l") == 1, "left_only").otherwise("right_only"))
    return seen.select(*keys, side.alias("side"))


def version_pairs(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Each distinct version of a key with the version before it."""
    w = Window.partitionBy(*keys).orderBy(version)
    seen = df.select(*keys, version).distinct()
    return (seen.withColumn(f"{version}_old", F.lag(version).over(w))
            .where(F.col(f"{version}_old").isNotNull())
            .withColumnRenamed(version, f"{version}_new"))


def ordered_pairs(df: DataFrame, keys: list[str], day: str, within: int) -> DataFrame:
    """Every ordered pair of distinct days of a key, old before new, at most `within` days apart.

    Days are dealt to ranges of that length; a day meets its own range and the one before, so a
    key with a long history never meets all of itself.
    """
    seen = df.select(*keys, F.col(day).cast("date").alias("__day")).where("__day IS NOT NULL").distinct()
    part = F.floor(F.unix_date("__day") / F.lit(within)).cast("int")
    new = seen.select(*keys, F.col("__day").alias(f"{day}_new"), F.explode(F.array(part, part - 1)).alias("__part"))
    old = seen.select(*keys, F.col("__day").alias(f"{day}_old"), part.alias("__part"))
    gap = F.date_diff(f"{day}_new", f"{day}_old")
    return join_keys(new, old, [*keys, "__part"], "inner", extra=(gap > 0) & (gap <= within)).drop("__part")


def difference_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: rows with a value and distinct values, counted by value first."""
    values = column_values(df, cols)
    return values.groupBy("column").agg(
        F.sum("rows").alias("n_rows"), F.count(F.lit(1)).alias("n_unique"))


def column_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """Every distinct value of every column with its row count, long form."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    return long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("rows"))


def reporting_grid(df: DataFrame, group: str, label: str) -> DataFrame:
    """Every ordered pair of labels within a group, the empty frame of a counterclaim table.

    Labels are reporting segments of a dimension; the frame has all their pairs by definition.
    """
    labels = df.where(F.col(label).isNotNull() & F.col(group).isNotNull()).select(group, label).distinct()
    return join_keys(labels.withColumnRenamed(label, "row_label"), labels.withColumnRenamed(label, "col_label"), [group], "inner", null_safe=False)
