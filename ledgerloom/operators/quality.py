"""Profiles, snapshot changes, expectations and alerts."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import all_of, is_empty_value
from ledgerloom.functions.measures import mostly_equal
from ledgerloom.operators.grouping import exact_quantiles
from ledgerloom.operators.joins import join_keys
from ledgerloom.session import staged
from ledgerloom.sources.tables import literal_table, newest_days, within_day


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: type, row and column counts, nulls, all-zero rows, numeric sum.

    One pass over the table; text that is not a number adds nothing to the sum.
    """
    cols = columns or df.columns
    types = dict(df.dtypes)
    zero_row = all_of(F.coalesce(F.col(c).try_cast("double") == 0, F.lit(False)) for c in cols)
    summary = df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(zero_row).alias("zero_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(cols)],
        *[F.coalesce(F.sum(_number(c, types[c])), F.lit(0.0)).alias(f"__s{i}") for i, c in enumerate(cols)],
    )
    lines = F.explode(F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.lit(len(cols)).alias("n_columns"),
            F.col(f"__n{i}").alias("nulls"), F.col(f"__s{i}").alias("sum"),
        ) for i, c in enumerate(cols)
    ]))
    return summary.select("rows", "zero_rows", lines.alias("l")).select("l.*", "rows", "zero_rows")


def _number(name: str, dtype: str) -> Column:
    if dtype.startswith(("timestamp", "date", "array", "map", "struct", "boolean", "binary")):
        return F.lit(None).cast("double")
    return F.col(name).try_cast("double")


def compare_profiles(old: DataFrame, new: DataFrame, tolerance: float = 0.4) -> DataFrame:
    """Two profiles side by side with equality flags: exact for type, tolerant for figures."""
    def named(df: DataFrame, tail: str) -> DataFrame:
        return df.withColumnsRenamed({c: f"{c}_{tail}" for c in df.columns if c != "column"})

    both = join_keys(named(old, "old"), named(new, "new"), ["column"], "full")
    figures = ["nulls", "sum", "rows", "zero_rows"]
    both = both.na.fill(0, subset=[f"{f}_{t}" for f in figures for t in ("old", "new")])
    flags = {f"{f}_equal": F.coalesce(mostly_equal(f"{f}_old", f"{f}_new", tolerance), F.lit(False)) for f in figures}
    flags["type_equal"] = F.coalesce(F.col("type_old") == F.col("type_new"), F.lit(False))
    flags["n_columns_equal"] = F.coalesce(F.col("n_columns_old") == F.col("n_columns_new"), F.lit(False))
    return both.withColumns(flags)


def drop_empty_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows that hold anything but null, 0 and '0' in the given columns."""
    return df.where(~all_of(is_empty_value(c) for c in cols))


def empty_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column with the flag `empty`: only null, 0 and '0' in the whole table."""
    flags = df.agg(*[F.coalesce(F.every(is_empty_value(c)), F.lit(True)).alias(c) for c in cols])
    return flags.unpivot([], cols, "column", "empty")


def last_two_days(df: DataFrame, day: str) -> DataFrame:
    """The two newest dates of a table, newest first (`position` 1 and 2)."""
    days = [(d, i) for i, d in enumerate(newest_days(df, day, 2), 1)]
    return literal_table(df.sparkSession, days, f"{day} date, position int")


def snapshot_changes(
    df: DataFrame, day: str, keys: list[str], amount: str, days: list[datetime.date] | None = None,
) -> DataFrame:
    """Keys lost ('missing') or gained ('new') between the last two dates, with rows and amount.

    `day` may be a timestamp. The two days are read first unless given; both sides come from one
    grouped pass over them, with constant bounds that reach the scan.
    """
    newest, previous = [*(newest_days(df, day, 2) if days is None else days), None, None][:2]
    last, before = within_day(day, newest), within_day(day, previous)
    seen = df.where(last | before).groupBy(*keys).agg(
        F.count_if(last).alias("__last"), F.count_if(before).alias("__before"),
        F.coalesce(F.sum(amount), F.lit(0.0)).alias("amount"),
    )
    return seen.where((F.col("__last") == 0) | (F.col("__before") == 0)).select(
        F.when(F.col("__last") == 0, "missing").otherwise("new").alias("status"),
        *keys, (F.col("__last") + F.col("__before")).alias("rows"), "amount",
    )


def last_seen(df: DataFrame, day: str, keys: list[str], wanted: DataFrame, before: Column, months: int = 3) -> DataFrame:
    """Newest date of each wanted key in the months before a day, as text, else 'never'.

    One grouped pass for all keys instead of one query per key; a constant day bounds the scan.
    """
    history = df.where((F.col(day) < before) & (F.col(day) >= F.add_months(before, -months)))
    seen = join_keys(history, wanted.select(*keys).distinct(), keys, "left_semi").groupBy(*keys).agg(
        F.max(F.col(day).cast("date")).cast("string").alias("last_seen"))
    return join_keys(wanted, seen, keys, "left").withColumn(
        "last_seen", F.coalesce("last_seen", F.lit("never")))


def alerts(df: DataFrame, limits: dict[str, tuple[Column, float]]) -> DataFrame:
    """One row per alert: its sum, its limit and the level OK, ALERT (nonzero) or CRITICAL."""
    sums = df.agg(*[F.coalesce(F.sum(value), F.lit(0.0)).alias(name) for name, (value, _) in limits.items()])
    lines = F.explode(F.array(*[
        F.struct(F.lit(name).alias("alert"), F.col(name).alias("value"), F.lit(float(limit)).alias("limit"))
        for name, (_, limit) in limits.items()
    ]))
    level = F.when(F.col("value") >= F.col("limit"), "CRITICAL").when(F.col("value") != 0, "ALERT").otherwise("OK")
    return sums.select(lines.alias("l")).select("l.*").withColumn("level", level)


def expectations(df: DataFrame, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One row per check: an aggregate, its expected value and whether they agree."""
    facts = df.agg(*[actual.cast("double").alias(f"a_{n}") for n, (actual, _) in checks.items()],
                   *[wanted.cast("double").alias(f"w_{n}") for n, (_, wanted) in checks.items()])
    lines = F.explode(F.array(*[
        F.struct(F.lit(n).alias("check"), F.col(f"a_{n}").alias("actual"), F.col(f"w_{n}").alias("expected"))
        for n in checks
    ]))
    return facts.select(lines.alias("l")).select("l.*").withColumn("ok", F.col("actual").eqNullSafe(F.col("expected")))


def checklist(df: DataFrame, keys: list[str], numbers: list[str], texts: list[str], k: float = 1.5) -> DataFrame:
    """Counts per check and column: repeated keys, nulls, text that is no number, and outliers.

    An outlier lies more than k interquartile ranges outside the quartiles of its column. One
    pass counts nulls and texts, one grouped pass the repeated keys; quartiles are exact.
    """
    cols = list(dict.fromkeys([*keys, *numbers, *texts]))
    counts = [F.count_if(F.col(c).isNull()).alias(f"null/{c}") for c in cols] + [
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(f"no number/{c}") for c in texts]
    simple = df.agg(*counts)
    lines = simple.unpivot([], simple.columns, "line", "rows").select(
        F.split("line", "/")[0].alias("check"), F.split("line", "/", 2)[1].alias("column"), "rows")
    again = repeated_keys(df, keys).agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("rows")).select(
        F.lit("repeated").alias("check"), F.lit(", ".join(keys)).alias("column"), "rows")
    long = df.select(*[F.col(c).cast("double").alias(c) for c in numbers]).unpivot([], numbers, "column", "value")
    quartiles = staged(exact_quantiles(long, ["column"], "value", {"q1": 0.25, "q3": 0.75}), "quartiles")
    spread = (F.col("q3") - F.col("q1")) * k
    outside = (F.col("value") < F.col("q1") - spread) | (F.col("value") > F.col("q3") + spread)
    far = join_keys(long, quartiles, ["column"], "inner", null_safe=False).groupBy("column").agg(F.count_if(outside).alias("rows"))
    return lines.unionByName(again).unionByName(far.select(F.lit("outlier").alias("check"), "column", "rows"))


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def count_differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys whose row counts differ between two tables."""
    tagged = left.select(key, F.lit(1).alias("__l"), F.lit(0).alias("__r")).unionByName(
        right.select(key, F.lit(0).alias("__l"), F.lit(1).alias("__r")))
    counts = tagged.groupBy(key).agg(F.sum("__l").alias("left_rows"), F.sum("__r").alias("right_rows"))
    return counts.where(F.col("left_rows") != F.col("right_rows"))
