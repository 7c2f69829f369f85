"""Exact quantiles by repeated narrowing, for any values and any number of groups.

`grouping.exact_quantiles` needs one sketch that encloses its quantiles. Here every wanted rank of a group has a
bracket of values that is known to hold it, with exact counts below and inside. While a bracket holds more
than a few rows, two of its values are chosen as pivots by a small sketch, and exact counts around them tell where
the rank lies: on a pivot, or in one of three narrower brackets. A poor sketch only costs another round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_col
from ledgerloom.operators.joins import join_keys
from ledgerloom.session import staged

FEW = 10_000
STEPS = 50
ACCURACY = 1000


def _pivots(share: Column) -> list[Column]:
    """Two values of the bracket around a share of its rows; percentiles come in fixed steps."""
    cuts = F.percentile_approx("__v", [i / STEPS for i in range(STEPS + 1)], ACCURACY)
    low, high = F.floor(share * STEPS) - 1, F.ceil(share * STEPS) + 1
    return [F.get(cuts, F.greatest(F.lit(0), F.least(F.lit(STEPS), at)).cast("int")) for at in (low, high)]


def _inside(base: DataFrame, brackets: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of brackets; an open end is null."""
    within = (F.col("__low").isNull() | (F.col("__v") > F.col("__low"))) & (F.col("__high").isNull() | (F.col("__v") < F.col("__high")))
    return join_keys(base, brackets, keys, "inner", extra=within)


def _narrowed(base: DataFrame, brackets: DataFrame, keys: list[str]) -> DataFrame:
    """Brackets after one round; a solved one has its `__value`."""
    place, name = F.col("__rank") - F.col("__below"), [*keys, "__rank"]
    share = (place + 0.5) / F.col("__inside")
    chosen = _inside(base, brackets, keys).groupBy(*name).agg(*(
        p.alias(c) for p, c in zip(_pivots(F.first(share)), ("__p", "__q"))))
    chosen = staged(join_keys(brackets, chosen, name, "inner"), "pivots")
    v, p, q = F.col("__v"), F.col("__p"), F.col("__q")
    counts = _inside(base, chosen, keys).groupBy(*name).agg(
        F.count_if(v < p).alias("__a"), F.count_if(v == p).alias("__b"), F.count_if((v > p) & (v < q)).alias("__c"),
        F.count_if((v == q) & (q > p)).alias("__d"))
    out = join_keys(chosen, counts, name, "inner")
    ends = [reduce(lambda x, y: x + y, [F.col(c) for c in ("__a", "__b", "__c", "__d")[:i + 1]]) for i in range(4)]
    first, second, third = place < ends[0], (place >= ends[1]) & (place < ends[2]), place >= ends[3]
    value = F.when((place >= ends[0]) & (place < ends[1]), p).when((place >= ends[2]) & (place < ends[3]), q)
    return out.select(
        *name, F.when(second, p).when(third, q).otherwise(F.col("__low")).alias("__low"),
        F.when(first, p).when(second, q).otherwise(F.col("__high")).alias("__high"),
        (F.col("__below") + F.when(second, ends[1]).when(third, ends[3]).otherwise(0)).alias("__below"),
        F.when(first, ends[0]).when(second, F.col("__c")).otherwise(F.col("__inside") - ends[3]).alias("__inside"), value.alias("__value"))


def select_quantiles(df: DataFrame, keys: list[str], value: str | Column, quantiles: dict[str, float], few: int = FEW) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per quantile plus the count `n`; nulls do not count."""
    if not keys:
        return select_quantiles(df.withColumn("__all", F.lit(0)), ["__all"], value, quantiles, few).drop("__all")
    base = staged(df.select(*keys, as_col(value).cast("double").alias("__v")).where("__v IS NOT NULL"), "values")
    sizes = staged(base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "sizes")
    places = {name: (F.col("n") - 1) * F.lit(float(q)) for name, q in quantiles.items()}
    ranks = F.array_distinct(F.array(*(f(p).cast("long") for p in places.values() for f in (F.floor, F.ceil))))
    none = F.lit(None).cast("double")
    state = sizes.where("n > 0").select(*keys, F.explode(ranks).alias("__rank"), none.alias("__low"), none.alias("__high"),
                                        F.lit(0).cast("long").alias("__below"), F.col("n").alias("__inside"), none.alias("__value"))
    solved = []
    while True:
        state = staged(state, "brackets")
        solved.append(state.where("__value IS NOT NULL").select(*keys, "__rank", "__value"))
        left = state.where("__value IS NULL")
        small = left.where(F.col("__inside") <= few)
        cells = _inside(base, small, keys).groupBy(*keys, "__rank", "__below", "__v").agg(F.count(F.lit(1)).alias("__n"))
        names = ", ".join(f"`{c}`" for c in [*keys, "__rank"])
        upto = F.col("__below") + F.expr(f"sum(__n) OVER (PARTITION BY {names} ORDER BY __v)")  # at most `few` rows
        ordered = cells.withColumn("__upto", upto).where((F.col("__rank") < F.col("__upto")) & (F.col("__rank") >= F.col("__upto") - F.col("__n")))
        solved.append(staged(ordered.select(*keys, "__rank", F.col("__v").alias("__value")), "solved"))
        left = left.where(F.col("__inside") > few)
        if not left.limit(1).count():
            break
        state = _narrowed(base, left.drop("__value"), keys)
    found = reduce(DataFrame.unionByName, solved).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("__rank", "__value"))).alias("__at"))
    both = join_keys(sizes, found, keys, "inner")
    out = []
    for name, place in places.items():
        low, high = (F.col("__at")[f(place).cast("long")] for f in (F.floor, F.ceil))
        out.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return both.select(*keys, "n", *out)
