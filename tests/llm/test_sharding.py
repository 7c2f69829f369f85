from __future__ import annotations

import math
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm.sharding import assign, op13_sharding, place, read_shards, write_shards
from ledgerloom.session import shared_dir

SEED = 42


def to_signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def brute(key, weights):
    """The shard by the published formula, hashes by another library."""
    hashed = xxhash.xxh64_intdigest(str(key).encode(), SEED) if key is not None else SEED
    best = None
    for shard, weight in sorted(weights.items()):
        start = xxhash.xxh64_intdigest(hashed.to_bytes(8, "little"), SEED)
        drawn = xxhash.xxh64_intdigest(shard.to_bytes(4, "little"), start) >> 12
        cost = -math.log((drawn + 0.5) / 2 ** 52) / weight
        if best is None or cost < best[0]:
            best = cost, shard
    return best[1]


def shards_of(df, weights):
    return {r.doc_id: r.shard for r in assign(df, weights).select("doc_id", "shard").collect()}


def test_against_brute_force(spark):
    df = spark.range(3000).select((F.col("id") * 7919 - 5000).alias("doc_id"))
    for weights in ({s: 1.0 for s in range(24)}, {0: 1, 3: 2.5, 9: 0.25}):
        assert shards_of(df, weights) == {k: brute(k, weights) for k in shards_of(df, weights)}


def test_few_records_move(spark):
    df = spark.range(20000).select(F.col("id").alias("doc_id"))
    old = {s: 1.0 for s in range(24)}
    before, after = shards_of(df, old), shards_of(df, {**old, 24: 1.0})
    moved = [k for k in before if before[k] != after[k]]
    assert all(after[k] == 24 for k in moved)
    assert abs(len(moved) / 20000 - 1 / 25) < 0.01
    removed = shards_of(df, {s: w for s, w in old.items() if s != 5})
    assert all(before[k] == 5 for k in before if before[k] != removed[k])
    raised = shards_of(df, {**old, 7: 3.0})
    assert all(raised[k] == 7 for k in before if before[k] != raised[k])


def test_weights_are_shares(spark):
    df = spark.range(30000).select(F.col("id").alias("doc_id"))
    found = list(shards_of(df, {0: 1.0, 1: 2.0, 2: 3.0}).values())
    assert [abs(found.count(s) / 30000 - (s + 1) / 6) < 0.015 for s in range(3)] == [True] * 3


def test_wider_key_keeps_its_shard(spark):
    weights = {s: 1.0 for s in range(5)}
    df = spark.range(50).select(F.col("id").cast("int").alias("a"), F.col("id").alias("b"), F.col("id").cast("string").alias("c"))
    found = df.select(*(place(F.col(c), weights)["shard"].alias(c) for c in "abc")).collect()
    assert all(r.a == r.b == r.c for r in found)


def test_files_and_slots(spark, docs):
    rows = [(i % 40 if i % 3 else 5, [None, "", "é" * 9, "x" * 200000][i % 4]) for i in range(600)]
    df, path, weights = docs(rows + [(None, "n"), (None, "n")]).repartition(7), shared_dir(spark, "s"), {0: 1.0, 1: 1.0, 2: 0.5}
    schema = write_shards(df, path, weights)
    back = read_shards(spark, path, schema)
    found = back.collect()
    assert sorted((r.doc_id, r.text, r.lang) for r in found if r.doc_id is not None and r.text is not None) == sorted(
        (k, t, "en") for k, t in rows if t is not None)
    assert len(found) == 602
    for shard in weights:
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert {(r.doc_id, r.shard) for r in found} == {(k, brute(k, weights)) for k, _ in rows + [(None, "n")]}
    assert sorted(map(tuple, back.select("doc_id", "shard", "slot").collect()), key=repr) == sorted(
        ((r.doc_id, r.shard, r.slot) for r in found), key=repr)


def test_empty_table_clashing_columns_and_bad_weights(spark, docs):
    empty, path = docs([(1, "a")]).limit(0), shared_dir(spark, "s")
    schema = write_shards(empty, path, {0: 1.0})
    assert read_shards(spark, path, schema).count() == 0
    df = spark.createDataFrame([(1, "a", 77, 88, 9, "f")], "doc_id long, text string, SHARD int, slot long, count long, _file string")
    path = shared_dir(spark, "s")
    row = read_shards(spark, path, write_shards(df, path, {4: 1.0})).first()
    assert (row.doc_id, row.text, row["shard"], row.slot, row["count"], row["_file"]) == (1, "a", 4, 0, 9, "f")
    for weights in ({}, {0: 0.0}, {0: 1.0, 1: -1.0}, {0: math.inf}, {0: math.nan}):
        with pytest.raises(ValueError):
            assign(df, weights)


def test_query_on_a_small_table(spark):
    folder = "/root/testdata/sf0.001"
    found = op13_sharding(spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    weights = {s: 1.0 for s in range(24)}
    assert len(found) == len(texts)
    for r in found:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "key")
        assert (r.shard, r.grown_shard) == (brute(r.doc_id, weights), brute(r.doc_id, {**weights, 24: 1.0}))
    for shard in range(24):
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_no_python_in_the_plan(spark):
    plan = op13_sharding(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
