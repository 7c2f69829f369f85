"""Writing grouped outputs, named results, text files and run history."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.joins import join_keys
from ledgerloom.session import staged


def write_by(df: DataFrame, path: str, keys: list[str], max_records_per_file: int = 5_000_000) -> str:
    """One sub-folder per group, with about a file per `max_records_per_file` rows of it.

    Rows are dealt by group and a salt that is as wide as the group is large, so small groups
    do not get a file from every task and a hot group has many writers. The salt is a hash of the
    row, so a task that runs again deals its rows as before, in whatever order they come.
    """
    sizes = staged(df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / max_records_per_file).cast("int").alias("__files")), "sizes")
    row = F.xxhash64(*(F.to_json(F.struct(c)) if kind.startswith("map") else F.col(c) for c, kind in df.dtypes))
    salted = join_keys(df, sizes, keys, "left").withColumn("__salt", F.pmod(row, F.col("__files")))
    dealt = salted.repartition(*keys, "__salt").drop("__files", "__salt")
    dealt.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).partitionBy(*keys).parquet(path)
    return path


def write_named(results: dict[str, DataFrame], path: str) -> dict[str, str]:
    """A run directory with one dataset per named result."""
    paths = {}
    for name, df in results.items():
        paths[name] = os.path.join(path, name)
        df.write.mode("overwrite").parquet(paths[name])
    return paths


def append_history(df: DataFrame, path: str, run_date: str | Column) -> str:
    """Add a run summary to a history, stamped with its run date; a repeated run replaces the rows of its date."""
    stamp = F.lit(run_date).cast("date") if isinstance(run_date, str) else run_date
    stamped = df.withColumn("run_date", stamp)
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path)
    return path


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> str:
    df.write.mode("overwrite").csv(path, header=True, sep=sep)
    return path
