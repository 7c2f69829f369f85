"""Lookups in dimensions: entity resolution, defaults, retries and checked inserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.grouping import first_per_key
from ledgerloom.operators.joins import join_keys

EXTERNAL = "External"


def lookup(
    df: DataFrame, dim: DataFrame, on: str | dict[str, str], values: list[str] | dict[str, str],
    order: list[str], default: str | float | None = None,
) -> DataFrame:
    """Left lookup that never changes the row count.

    `on` maps fact columns to dimension columns; `values` maps dimension columns to output
    names. Null dimension keys are ignored; of duplicate keys the first by `order` counts.
    """
    on = {on: on} if isinstance(on, str) else on
    values = values if isinstance(values, dict) else {v: v for v in values}
    keys = list(on.values())
    unique = first_per_key(dim.na.drop(subset=keys), keys, order)
    slim = unique.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        *[F.col(v).alias(f"__v_{name}") for v, name in values.items()],
    )
    joined = join_keys(df, slim, {f: f"__k{i}" for i, f in enumerate(on)}, "left", null_safe=False)
    filled = {
        name: F.col(f"__v_{name}") if default is None else F.coalesce(F.col(f"__v_{name}"), F.lit(default))
        for name in values.values()
    }
    return joined.withColumns(filled).drop(*[f"__v_{n}" for n in values.values()])


def key_index(dim: DataFrame, keys: list[str], values: list[str], order: list[str]) -> DataFrame:
    """One row (key, values) per distinct key text over several key columns.

    A later key column overrides an earlier one unless its value is null, value by value;
    duplicates within a key column are settled by `order`.
    """
    long = dim.select(
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("rank"), F.col(k).cast("string").alias("key")) for i, k in enumerate(keys)
        ])).alias("k"),
        F.struct(*values).alias("value"), F.struct(*order).alias("ord"),
    ).select("k.*", "value", "ord").where(F.col("key").isNotNull())
    per_rank = long.groupBy("key").agg(*[
        F.min_by(F.when(F.col("rank") == i, F.col("value")), F.when(F.col("rank") == i, F.col("ord"))).alias(f"v{i}")
        for i in range(len(keys))
    ])
    return per_rank.select("key", *[
        F.coalesce(*[F.col(f"v{i}")[v] for i in reversed(range(len(keys)))]).alias(v) for v in values])


def lookup_multikey(
    df: DataFrame, col: str, dim: DataFrame, keys: list[str], values: str | dict[str, str], order: list[str],
    out: str | None = None, default: str = EXTERNAL,
) -> DataFrame:
    """Resolve a code that may be any of several identifiers of a dimension row.

    `values` is one column (named `out`) or a mapping of columns to output names. All
    identifiers and all values are folded into one index, so the facts are joined once.
    """
    names = {values: out or values} if isinstance(values, str) else values
    return lookup_index(df, col, key_index(dim, keys, list(names), order), names, default)


def lookup_index(df: DataFrame, col: str, index: DataFrame, names: dict[str, str], default: str = EXTERNAL,
                 key: str = "key") -> DataFrame:
    """Join an index holding one row per key; misses and nulls take the default."""
    slim = index.select(F.col(key).alias("__key"), *[F.col(v).alias(f"__v_{n}") for v, n in names.items()])
    joined = join_keys(df, slim, {col: "__key"}, "left", null_safe=False)
    return joined.withColumns({n: F.coalesce(f"__v_{n}", F.lit(default)) for n in names.values()}).drop(
        *[f"__v_{n}" for n in names.values()])


def lookup_name(df: DataFrame, col: str, mapping: DataFrame, name: str, code: str, order: list[str],
                out: str, default: str = EXTERNAL) -> DataFrame:
    """Company code by company name, with a default for unknown names."""
    return lookup(df, mapping, {col: name}, {code: out}, order, default)


def lookup_ignore_case(df: DataFrame, col: str, dim: DataFrame, name: str, how: str = "full") -> DataFrame:
    """Join on upper-cased text; the key comes out as `upper_key`."""
    left = df.withColumn("upper_key", F.upper(F.trim(col)))
    right = dim.withColumn("upper_key", F.upper(F.trim(name)))
    return join_keys(left, right, ["upper_key"], how)


def two_pass_lookup(
    df: DataFrame, dim: DataFrame, full_keys: list[str], short_keys: list[str], value: str, order: list[str],
    out: str,
) -> DataFrame:
    """Match on all keys, retry the leftovers on fewer keys; `match_level` is 1, 2 or 0."""
    first = lookup(df, dim, {k: k for k in full_keys}, {value: "__first"}, order)
    second = lookup(first, dim, {k: k for k in short_keys}, {value: "__second"}, order)
    level = F.when(F.col("__first").isNotNull(), 1).when(F.col("__second").isNotNull(), 2).otherwise(0)
    return second.withColumns({
        out: F.coalesce("__first", "__second"), "match_level": level,
    }).drop("__first", "__second")


def alternative_key_join(left: DataFrame, right: DataFrame, alternatives: dict[str, dict[str, str]]) -> DataFrame:
    """Union of inner joins, one per alternative key set, labelled with the key that matched.

    `alternatives` maps a label to {left column: right column}. Right columns must not clash
    with left ones except for the keys.
    """
    parts = [
        join_keys(left, right.withColumnsRenamed({r: f"__k_{r}" for r in on.values()}),
                  {l: f"__k_{r}" for l, r in on.items()}, "inner", null_safe=False)
        .withColumn("merge_on", F.lit(label))
        for label, on in alternatives.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def fill_missing(df: DataFrame, col: str, dim: DataFrame, on: dict[str, str], value: str, order: list[str]) -> DataFrame:
    """Fill a missing code from a dimension."""
    return lookup(df, dim, on, {value: "__fill"}, order).withColumn(
        col, F.coalesce(F.col(col), F.col("__fill"))).drop("__fill")


def append_checked(dim: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Dimension plus the new rows whose key it lacks, each row labelled
    'existing', 'added' or 'conflict' (a new row rejected because its key is taken)."""
    added = new.join(dim.select(key), key, "left_anti").withColumn("status", F.lit("added"))
    clash = new.join(dim.select(key), key, "left_semi").withColumn("status", F.lit("conflict"))
    return dim.withColumn("status", F.lit("existing")).unionByName(added).unionByName(clash)
