"""Distinct keys as bitmaps, kept per day, so that any span is counted and compared without reading the facts again.

Keys are numbered densely by a dictionary; the keys of a group and day become bitmaps of 32,768 bits. The distinct
keys of a span are the bits of its days put together: a hot key is one bit per day, however many rows it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import staged

PART = 100_000


def number_keys(df: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """(key, number): the distinct keys of a table, numbered from 0 almost without gaps; null is no key.

    Keys that `known` numbers keep them, and the others come after; numbers are given within parts of bounded size.
    """
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    first = 0
    if known is not None:
        keys = keys.join(known.select(key), key, "left_anti")
        first = (known.agg(F.max("number")).first()[0] or -1) + 1
    keys = staged(keys, "keys")
    parts = max(1, -(-keys.count() // PART))
    slot = F.expr(f"row_number() OVER (PARTITION BY __part ORDER BY `{key}`) - 1")
    placed = keys.withColumn("__part", F.pmod(F.xxhash64(key), F.lit(parts))).withColumn("__slot", slot)
    fresh = placed.select(key, (F.col("__slot") * parts + F.col("__part") + first).cast("long").alias("number"))
    return staged(fresh if known is None else known.select(key, "number").unionByName(fresh), "dictionary")


def day_bitmaps(df: DataFrame, groups: list[str], day: str, key: str, dictionary: DataFrame) -> DataFrame:
    """(groups..., day, bucket, bits): the numbered keys of each group and day; one grouped pass over the distinct ones."""
    seen = df.select(*groups, F.col(day).cast("date").alias("day"), key).distinct()
    numbered = seen.join(dictionary, key).withColumn("number", F.col("number") + 1)  # bits are counted from 1
    return numbered.groupBy(*groups, "day", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def span_counts(bitmaps: DataFrame, groups: list[str], start: str, end: str) -> DataFrame:
    """(groups..., keys): distinct keys of each group from one day to another, both included."""
    span = bitmaps.where(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    merged = span.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).alias("keys"))


def compare_spans(bitmaps: DataFrame, groups: list[str], old: tuple[str, str], new: tuple[str, str]) -> DataFrame:
    """(groups..., both, only_old, only_new, same): the key sets of two spans, by their sizes and that of their union.

    |old and new| = |old| + |new| - |old or new|, so one kind of merge answers equality and coverage both ways.
    """
    day = F.col("day")

    def within(span: tuple[str, str]):
        return day.between(F.lit(span[0]).cast("date"), F.lit(span[1]).cast("date"))

    merged = bitmaps.where(within(old) | within(new)).groupBy(*groups, "bucket").agg(
        F.bitmap_or_agg(F.when(within(old), F.col("bits"))).alias("o"), F.bitmap_or_agg(F.when(within(new), F.col("bits"))).alias("n"),
        F.bitmap_or_agg("bits").alias("u"))
    sums = merged.groupBy(*groups).agg(*(F.sum(F.bitmap_count(c)).alias(f"__{c}") for c in "onu"))
    o, n, u = F.col("__o"), F.col("__n"), F.col("__u")
    return sums.select(*groups, (o + n - u).alias("both"), (u - n).alias("only_old"), (u - o).alias("only_new"), ((o == u) & (n == u)).alias("same"))


def group_coverage(bitmaps: DataFrame, group: str, left: str, right: str) -> DataFrame:
    """(both, only_left, only_right): the keys of two groups over all days."""
    one = bitmaps.where(F.col(group).isin(left, right)).withColumn("day", F.when(F.col(group) == left, F.lit("2000-01-01")).otherwise(F.lit("2000-01-02")).cast("date"))
    found = compare_spans(one, [], ("2000-01-01", "2000-01-01"), ("2000-01-02", "2000-01-02"))
    return found.select("both", F.col("only_old").alias("only_left"), F.col("only_new").alias("only_right"))
