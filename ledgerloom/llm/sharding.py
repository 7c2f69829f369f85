"""Sharding by rendezvous hashing of stable keys over weighted shards, in built-in expressions only.

Every record key draws a number u in (0, 1) for every shard, from a hash of the key and the
shard's number; the record goes to the shard with the smallest -ln(u) / weight. So

- the key and the shards alone decide: neither other rows, nor their order, nor a random state;
- shards get records in proportion to their weights;
- a shard that is added takes records only into itself, a share of its weight in all weights;
  a shard that is removed gives up its own records only, and a weight that is raised or lowered
  moves records only to or from that shard.

`write_shards` writes one folder per shard. Rows are dealt by their shard with Spark's rebalancing,
which splits shards into tasks of a bounded size where one task wrote their rows' part of the
shuffle, so a key or a shard that holds most rows does not meet in one task; it needs adaptive
execution, which is on by default. `read_shards` reads the folders back and gives each row its
slot: the rows of the shard's earlier files, counted by a grouped count, and the row's index in its
own file. No row is ordered or shuffled for it. The slots of a written folder never change.

A null key is a key of its own; keys are hashed as text, so an id keeps its shard when its column
becomes wider. Rows of one key share a shard; repeated rows stay. Null, empty and very long texts are
payload like any other. An empty table gives empty shards. Columns named `shard` or `slot` are
replaced, whatever their case; all others are kept. Weights must be positive and finite.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import shared_dir, staged, table

SHARDS = 24
HASH_BITS = 52  # so that a hash and a half fit a double


def _checked(weights: dict[int, float]) -> dict[int, float]:
    if not weights or not all(w > 0 and math.isfinite(w) for w in weights.values()):
        raise ValueError("give at least one shard, and positive, finite weights")
    return weights


def _cost(hashed: Column, shard: Column, weight: Column) -> Column:
    drawn = F.shiftrightunsigned(F.xxhash64(hashed, shard), 64 - HASH_BITS).cast("double")
    return -F.log((drawn + 0.5) / float(1 << HASH_BITS)) / weight


def place(key: Column, weights: dict[int, float]) -> Column:
    """(cost, shard) of the shard that a key goes to; of equal costs the smallest shard."""
    shards = F.array(*(F.struct(F.lit(s).cast("int").alias("shard"), F.lit(float(w)).alias("weight"))
                       for s, w in sorted(_checked(weights).items())))
    hashed = F.xxhash64(key.cast("string"))
    return F.array_min(F.transform(shards, lambda s: F.struct(
        _cost(hashed, s["shard"], s["weight"]).alias("cost"), s["shard"].alias("shard"))))


def grown(key: Column, placed: Column, shard: int, weight: float = 1.0) -> Column:
    """The shard of a key that has been placed, once one more shard is there: its own, or the new one."""
    _checked({shard: weight})
    new = F.struct(_cost(F.xxhash64(key.cast("string")), F.lit(shard).cast("int"), F.lit(float(weight))).alias("cost"),
                   F.lit(shard).cast("int").alias("shard"))
    return F.least(placed, new)["shard"]


def _others(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c.lower() not in ("shard", "slot")]


def assign(docs: DataFrame, weights: dict[int, float], key: str = "doc_id") -> DataFrame:
    """The rows with their `shard`."""
    return docs.select(*(F.col(f"`{c}`") for c in _others(docs)), place(F.col(f"`{key}`"), weights)["shard"].alias("shard"))


def write_shards(docs: DataFrame, path: str, weights: dict[int, float], key: str = "doc_id") -> T.StructType:
    """Write the rows below a new folder, one folder per shard; the schema that `read_shards` needs."""
    placed = assign(docs, weights, key)
    placed.hint("rebalance", F.col("shard")).write.partitionBy("shard").parquet(path)
    return placed.schema


def read_shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a written folder with `shard` and `slot`, a number without gaps from 0 in each shard."""
    rows = spark.read.schema(schema).parquet(path)
    file = F.col("_metadata.file_name")
    files = rows.groupBy("shard", file.alias("file")).count()
    before = F.expr("sum(count) OVER (PARTITION BY shard ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    files = staged(files.select("shard", "file", F.coalesce(before, F.lit(0)).alias("slots_before")), "files")
    held = rows.select(F.struct(*(F.col(f"`{f.name}`") for f in schema)).alias("doc"), F.col("shard"),
                       file.alias("file"), F.col("_metadata.row_index").alias("at"))
    return held.join(files, ["shard", "file"]).select(
        *(F.col("doc").getField(f.name).alias(f.name) for f in schema), (F.col("slots_before") + F.col("at")).alias("slot"))


def op13_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Where each document is in 24 equal shards, read from the written shards, and where a 25th would put it."""
    docs = table(spark, folder, "documents")
    weights = {s: 1.0 for s in range(SHARDS)}
    path = shared_dir(spark, "shards")
    rows = read_shards(spark, path, write_shards(docs, path, weights))
    key = F.col("doc_id")
    return rows.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"), "shard", "slot",
        grown(key, place(key, weights), SHARDS).alias("grown_shard"))
