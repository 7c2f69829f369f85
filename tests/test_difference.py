from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import difference as D
from ledgerloom.session import shared_dir

SCHEMA = "k int, g string, a double, b string"
KEYS, VALUES = ["k", "g"], ["a", "b"]


def brute(old, new):
    o, n = Counter(old), Counter(new)
    rows = {r for r in o | n if o[r] != n[r]}
    out = set()
    for r in rows:
        own = [x for x in rows if x[:2] == r[:2]]
        lost, added = any(o[x] > n[x] for x in own), any(o[x] < n[x] for x in own)
        out.add((*r, o[r], n[r], "changed" if lost and added else "lost" if lost else "added"))
    return out


def found(df):
    rows = df.collect()
    assert len(rows) == len(set(map(tuple, rows)))
    return set(map(tuple, rows))


def sample(rng, n):
    return [(rng.choice([None, *range(40)]), rng.choice([None, "", "x"]), rng.choice([None, 0.0, 1.5]), rng.choice([None, "", "u"])) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_multisets(make, seed, monkeypatch):
    monkeypatch.setattr(D, "LEAF_ROWS", 3)
    rng = random.Random(seed)
    old = sample(rng, 200)
    new = [r if rng.random() < 0.9 else (*r[:2], 2.5, r[3]) for r in old if rng.random() < 0.9] + sample(rng, 10)
    got = found(D.difference(make(old, SCHEMA), make(new, SCHEMA), KEYS))
    assert got == brute(old, new)
    assert found(D.difference(make(old, SCHEMA), make(list(reversed(old)), SCHEMA).repartition(5), KEYS)) == set()


def test_null_and_empty_text_change_places(make):
    old, new = [(1, "x", None, ""), (2, None, 0.0, "y")], [(1, "x", 0.0, None), (2, "", 0.0, "y")]
    got = found(D.difference(make(old, SCHEMA), make(new, SCHEMA), KEYS))
    assert got == brute(old, new) and len(got) == 4


def test_empty_tables(make):
    none = make([], SCHEMA)
    some = [(1, "x", 1.0, "a"), (1, "x", 1.0, "a")]
    assert found(D.difference(none, none, KEYS)) == set()
    assert found(D.difference(make(some, SCHEMA), none, KEYS)) == {(1, "x", 1.0, "a", 2, 0, "lost")}
    assert found(D.difference(none, make(some, SCHEMA), KEYS)) == {(1, "x", 1.0, "a", 0, 2, "added")}


def table(spark, n, changed=()):
    price = F.when(F.col("id").isin(*changed), F.lit(-1.0)).otherwise(F.col("id") * 0.5) if changed else F.col("id") * 0.5
    return spark.range(n).select("id", price.alias("price"), (F.col("id") % 7).cast("string").alias("kind"))


def test_equal_buckets_do_not_reach_the_join(spark):
    """One row of 200,000: what is compared row by row is one bucket of each copy."""
    old, new = table(spark, 200_000), table(spark, 200_000, [123_456])
    depth = D.depth_for(200_000)
    trees = [D.digest_tree(df, ["id"], ["price", "kind"], depth) for df in (old, new)]
    buckets = D.differing_buckets(*trees)
    assert buckets.count() == 1
    assert D.rows_in(old, buckets, ["id"], depth).count() < 200_000 / 16 ** depth * 2
    got = found(D.difference(old, new, ["id"]))
    kind = str(123_456 % 7)
    assert got == {(123_456, 61728.0, kind, 1, 0, "changed"), (123_456, -1.0, kind, 0, 1, "changed")}


def test_one_row_of_a_written_copy_is_found_in_one_folder(spark):
    old, new = table(spark, 300_000), table(spark, 300_000, [77])
    paths = [D.write_copy(df, shared_dir(spark, "copy"), ["id"]) for df in (old, new)]
    schema = old.schema
    trees = [D.read_tree(spark, p) for p in paths]
    buckets = D.differing_buckets(*trees)
    few = [r.bucket for r in buckets.collect()]
    assert len(few) == 1
    read = D._rows_of_copy(D.read_copy(spark, paths[0], schema), trees[0].depth, trees[0].depth, buckets, few)
    assert 0 < read.count() < 1000
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__folder" in plan or "__folder" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "__bucket" in plan.split("PushedFilters:")[1].split("]")[0]
    assert found(D.copy_difference(spark, *paths, ["id"], schema)) == found(D.difference(old, new, ["id"]))


def test_copies_of_different_depth_and_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(D, "MOST_LITERALS", 3)
    changed = list(range(0, 20000, 40))
    old, new = table(spark, 20000), table(spark, 21000, changed)
    expected = found(D.difference(old, new, ["id"]))
    assert len(expected) == 1000 + 2 * len(changed)
    for depths in ((1, 3), (3, 1), (2, 2), (0, 2)):
        paths = [D.write_copy(df, shared_dir(spark, "copy"), ["id"], depth=d) for df, d in zip((old, new), depths)]
        assert found(D.copy_difference(spark, *paths, ["id"], old.schema)) == expected


def test_hot_key_is_grouped_first(make, spark):
    rows = spark.range(50_000).select(F.lit(1).alias("k"), F.lit("x").alias("g"), (F.col("id") % 3).cast("double").alias("a"), F.lit("b").alias("b"))
    more = rows.unionByName(make([(1, "x", 0.0, "b"), (1, "x", 9.0, "b")], SCHEMA))
    assert found(D.difference(rows, more, KEYS)) == {(1, "x", 0.0, "b", 16667, 16668, "added"), (1, "x", 9.0, "b", 0, 1, "added")}


def test_changed_columns(make):
    old = [(1, "x", 1.0, "a"), (2, "x", 1.0, "a"), (3, "x", 1.0, None), (4, "x", 1.0, "a"), (4, "x", 2.0, "a")]
    new = [(1, "x", 2.0, "a"), (2, "x", 2.0, "b"), (3, "x", 1.0, "q"), (4, "x", 3.0, "a"), (4, "x", 4.0, "a"), (5, "x", 1.0, "a")]
    diff = D.difference(make(old, SCHEMA), make(new, SCHEMA), KEYS)
    assert found(D.changed_columns(diff, KEYS, VALUES)) == {("a", 2), ("b", 2)}
