"""Exact ranks and running shares of raw rows, without ordering them in one task.

Rows are first counted per distinct sort key, so ties are one line however many rows share them. The
lines are range-partitioned by the key and written with the number of their partition; counts and sums
per partition give every partition its offset, and inside a partition, which holds a bounded
number of lines, a window adds what comes before. Rows get their rank by a join on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.joins import join_keys
from ledgerloom.session import staged

LINES = 1_000_000


def _ordered(order: dict[str, str]) -> list[Column]:
    return [F.desc_nulls_last(c) if way == "desc" else F.asc_nulls_last(c) for c, way in order.items()]


def rank_lines(df: DataFrame, order: dict[str, str], value: str | None = None, lines: int = LINES) -> DataFrame:
    """One row per distinct key, nulls last: key columns, rows, rank, dense_rank, and of `value` total, running and share.

    `rank` is one more than the rows before the key, `dense_rank` one more than the keys before it; `running`
    sums the value up to the key, ties included, and `share` is its part of the whole sum.
    """
    if not set(order.values()) <= {"asc", "desc"}:
        raise ValueError("order is 'asc' or 'desc' per column")
    keys = list(order)
    amount = F.coalesce(F.sum(F.col(value).cast("double")), F.lit(0.0)) if value else F.lit(0.0)
    grouped = staged(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), amount.alias("total")), "keys")
    parts = max(1, -(-grouped.count() // lines))
    placed = grouped.repartitionByRange(parts, *_ordered(order)).withColumn("__part", F.spark_partition_id())
    placed = staged(placed, "ranges")
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__k"), F.sum("rows").alias("__n"), F.sum("total").alias("__t"))
    # one row per range: all of them together are an array of `parts` entries
    before = F.expr("aggregate(filter(__all, x -> x.__part < __part), named_struct('k', 0L, 'n', 0L, 't', 0.0D), "
                    "(a, x) -> named_struct('k', a.k + x.__k, 'n', a.n + x.__n, 't', a.t + x.__t))")
    whole = F.expr("aggregate(__all, 0.0D, (a, x) -> a + x.__t)")
    every = sizes.agg(F.array_sort(F.collect_list(F.struct("__part", "__k", "__n", "__t"))).alias("__all")).scalar()
    offsets = staged(sizes.select("__part", every.alias("__all")).select("__part", before.alias("__o"), whole.alias("__w")), "offsets")
    key_order = ", ".join(f"`{c}` {way.upper()} NULLS LAST" for c, way in order.items())
    window = f"OVER (PARTITION BY __part ORDER BY {key_order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    local = placed.withColumns({"__n": F.expr(f"sum(rows) {window}"), "__k": F.expr(f"count(1) {window}"), "__t": F.expr(f"sum(total) {window}")})
    joined = local.join(offsets, "__part")
    out = joined.select(*keys, "rows", (F.col("__o.n") + F.col("__n") - F.col("rows") + 1).alias("rank"), (F.col("__o.k") + F.col("__k")).alias("dense_rank"),
                        "total", (F.col("__o.t") + F.col("__t")).alias("running"), F.col("__w").alias("__whole"))
    share = F.when(F.col("__whole") != 0, F.col("running") / F.col("__whole"))
    return out.withColumn("share", share).drop("__whole") if value else out.drop("total", "running", "__whole")


def with_rank(df: DataFrame, order: dict[str, str], value: str | None = None, lines: int = LINES) -> DataFrame:
    """Every row with `rank`, `dense_rank` and, if a value is given, `running` and `share`; equal keys have equal ranks."""
    ranks = rank_lines(df, order, value, lines)
    kept = [c for c in ranks.columns if c not in ("rows", "total")]
    return join_keys(df, staged(ranks.select(*kept), "ranks"), list(order), "left")
