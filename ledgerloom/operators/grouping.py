"""Grouping, latest versions, subtotals, correlations and exact quantiles.

A single key may own a large share of the rows, so nothing here gathers the rows of one
group in one task: group-wide values come from aggregates with map-side combine and are
joined back, instead of windows over the raw rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import all_of, as_col, sum0
from ledgerloom.operators.joins import join_keys


def group_sum(df: DataFrame, keys: list[str], values: list[str], null_keys: str = "keep") -> DataFrame:
    """Sums per group; an all-null group sums to 0; null keys are kept or dropped."""
    source = df if null_keys == "keep" else df.na.drop(subset=keys)
    return source.groupBy(*keys).agg(*[sum0(v).alias(v) for v in values])


def with_group_value(df: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """Every row with aggregates of its group (null keys form a group)."""
    totals = df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggregates.items()])
    return join_keys(df, totals, keys, "left")


def latest_version(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Rows carrying the newest version of their group; ties are kept."""
    newest = df.groupBy(*keys).agg(F.max(version).alias("__newest"))
    return join_keys(df, newest, keys, "inner", extra=F.col(version) == F.col("__newest")).drop("__newest")


def latest_one(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Exactly one row per group: the greatest by `order` (give a tie-break as last column)."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    )
    return best.select(*keys, "__row.*")


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Exactly one row per group: the smallest by `order`."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return best.select(*keys, "__row.*")


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows per group; Spark drops rows beyond k before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def subtotals(detail: DataFrame, levels: list[str], values: list[str], total_label: str = "Total") -> DataFrame:
    """Detail rows, a subtotal per first level and a grand total.

    The input is summed to the finest level first, so the grouping sets expand only that.
    `level` is 0 for detail, 1 for a subtotal, 2.. for higher totals; key columns rolled up
    read `total_label`.
    """
    fine = detail.groupBy(*levels).agg(*[sum0(v).alias(v) for v in values])
    rolled = fine.rollup(*levels).agg(
        *[sum0(v).alias(v) for v in values],
        *[F.grouping(c).alias(f"__g_{c}") for c in levels],
    )
    level = reduce(lambda a, b: a + b, [F.col(f"__g_{c}").cast("int") for c in levels])
    return rolled.select(
        *[F.when(F.col(f"__g_{c}") == 1, F.lit(total_label)).otherwise(F.col(c)).alias(c) for c in levels],
        *values, level.alias("level"),
    )


def collect_chunks(df: DataFrame, keys: list[str], member: str, chunk: int) -> DataFrame:
    """Members of a group as sorted arrays of bounded length.

    Integer members are cut into ranges of `chunk` values, so no array holds more than
    `chunk` entries however large the group is.
    """
    part = F.floor(F.col(member) / F.lit(chunk)).cast("long")
    return df.groupBy(*keys, part.alias("chunk_no")).agg(
        F.array_sort(F.collect_set(member)).alias("members"),
    )


def correlations(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """Pairwise-complete correlations of all column pairs, long form, in one aggregation."""
    by = by or []
    pairs = [(a, b) for a in cols for b in cols]
    wide = df.groupBy(*by).agg(
        *[F.corr(F.col(a), F.col(b)).alias(f"__c{i}") for i, (a, b) in enumerate(pairs) if a < b],
        *[F.when(F.stddev_samp(F.col(a)) > 0, F.lit(1.0)).alias(f"__c{i}")
          for i, (a, b) in enumerate(pairs) if a == b],
    )
    position = {p: i for i, p in enumerate(pairs)}
    cells = F.explode(F.array(*[
        F.struct(
            F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
            F.col(f"__c{position[(min(a, b), max(a, b))]}").alias("corr"),
        )
        for a, b in pairs
    ]))
    return wide.select(*by, cells.alias("cell")).select(*by, "cell.*")


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str | Column, quantiles: dict[str, float],
    accuracy: int = 100_000,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per quantile plus the count `n`.

    A bounded sketch first gives, for each quantile, two cut points that enclose it. Rows
    outside the cut points are then only counted per region, rows inside per distinct value;
    at most a few times n/accuracy values per group are ever ordered in one task.
    """
    base = df.select(*keys, as_col(value).cast("double").alias("__v")).where(F.col("__v").isNotNull())
    eps = 2.0 / accuracy
    shares = [s for q in quantiles.values() for s in (max(0.0, q - eps), min(1.0, q + eps))]
    sketch = F.percentile_approx("__v", shares, accuracy).alias("__cuts")
    if keys:
        marked = join_keys(base, base.groupBy(*keys).agg(sketch), keys, "left")
    else:
        marked = base.withColumn("__cuts", base.agg(sketch).scalar())

    v, cuts = F.col("__v"), F.col("__cuts")
    lows = [cuts[2 * i] for i in range(len(quantiles))]
    highs = [cuts[2 * i + 1] for i in range(len(quantiles))]
    inside = reduce(lambda a, b: a | b, [(v >= lo) & (v <= hi) for lo, hi in zip(lows, highs)])
    region = reduce(lambda a, b: a + b, [(v > c).cast("int") for c in lows + highs])
    cells = marked.groupBy(
        *keys, F.when(inside, v).alias("__value"), F.when(~inside, region).alias("__region"),
    ).agg(F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__min"), F.max("__v").alias("__max"))

    ordered = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("__min")
    ranked = cells.withColumn("__end", F.sum("__n").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.withColumn("__start", F.col("__end") - F.col("__n"))
    n_col = F.sum("__n").over(Window.partitionBy(*(keys or [F.lit(0)])))
    ranked = ranked.withColumn("n", n_col)

    def order_stat(index: Column) -> Column:
        hit = (F.col("__start") <= index) & (index < F.col("__end"))
        at = F.when(index == F.col("__start"), F.col("__min")).otherwise(
            F.when(index == F.col("__end") - 1, F.col("__max")).otherwise(F.col("__value"))
        )
        return F.max(F.when(hit, at))

    out = ranked.groupBy(*keys).agg(
        F.max("n").alias("n"),
        *[order_stat(F.floor((F.col("n") - 1) * F.lit(q))).alias(f"__lo_{name}") for name, q in quantiles.items()],
        *[order_stat(F.ceil((F.col("n") - 1) * F.lit(q))).alias(f"__hi_{name}") for name, q in quantiles.items()],
    )
    result = []
    for name, q in quantiles.items():
        position = (F.col("n") - 1) * F.lit(q)
        lo, hi = (F.when(F.col(f"__{x}_{name}").isNotNull(), F.col(f"__{x}_{name}")).otherwise(
            F.raise_error(F.lit("the sketch does not enclose a quantile; use a higher accuracy")).cast("double")) for x in ("lo", "hi"))
        result.append((lo + (hi - lo) * (position - F.floor(position))).alias(name))
    return out.select(*keys, "n", *result)


def without_outliers(df: DataFrame, cols: list[str], k: float = 1.5) -> DataFrame:
    """Rows whose values lie within k interquartile ranges of the quartiles in every column.

    The quartiles of all columns come from one grouped computation and enter the filter as
    one scalar map.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    quartiles = exact_quantiles(long, ["column"], "value", {"q1": 0.25, "q3": 0.75})
    spread = (F.col("q3") - F.col("q1")) * k
    fences = quartiles.select("column", F.struct((F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high")).alias("fence"))
    # one entry per named column, so the map is as small as the column list
    by_column = fences.agg(F.map_from_entries(F.collect_list(F.struct("column", "fence")))).scalar()
    return df.where(all_of(
        (F.col(c) >= by_column[c]["low"]) & (F.col(c) <= by_column[c]["high"]) for c in cols))


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, one row per column."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    stats = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(long, ["column"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return join_keys(stats, quartiles.drop("n"), ["column"], "left")
