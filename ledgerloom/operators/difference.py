"""Row-level differences of two copies of a table, found by trees of digests.

Every row falls into a bucket by the leading bits of its key's hash. A bucket's digest does not
depend on the order of its rows: their number, the sum of their 64-bit hashes (kept in three parts,
so that it cannot overflow) and the exclusive or of a second hash. Buckets are rolled up level by
level to one root. Two trees are compared from the root down: only below buckets that differ the
next level is looked at, and only rows of leaf buckets that differ are compared with each other.

Keys may repeat: copies are compared as multisets of rows, grouped before anything is joined, so a
key that holds most rows meets itself only as its distinct rows. Nulls equal nulls.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.grouping import with_group_value
from ledgerloom.session import staged

FAN_BITS = 4
LEAF_ROWS = 1000
DEEPEST = 8
HASH_BITS = 63
PART_BITS = 22
MOST_LITERALS = 1000
DIGEST = ["rows", "s0", "s1", "s2", "x"]


@dataclass(frozen=True)
class DigestTree:
    """Digests by level (0 is the root) and bucket; `depth` is the level of the leaves."""

    table: DataFrame
    depth: int


def _hash(cols: list[str], seed: int) -> Column:
    """A hash in which a null has its place."""
    return F.xxhash64(F.lit(seed), *(x for c in cols for x in (F.col(c), F.col(c).isNull())))


def bucket_of(keys: list[str], depth: int) -> Column:
    """The leaf bucket of a row: the leading bits of its key's hash."""
    return F.shiftright(F.shiftrightunsigned(_hash(keys, 1), 64 - HASH_BITS), HASH_BITS - FAN_BITS * depth)


def depth_for(rows: int) -> int:
    """The level at which a bucket has about `LEAF_ROWS` rows."""
    depth = 0
    while depth < DEEPEST and rows > LEAF_ROWS << (FAN_BITS * depth):
        depth += 1
    return depth


def digest_tree(df: DataFrame, keys: list[str], values: list[str], depth: int) -> DigestTree:
    """The tree of a table, written once: one grouped pass over it, combined before the shuffle."""
    h, low = F.col("__h"), F.lit((1 << PART_BITS) - 1)
    rows = df.select(bucket_of(keys, depth).alias("bucket"), _hash(keys + values, 2).alias("__h"), _hash(keys + values, 3).alias("__x"))
    leaves = rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(h.bitwiseAND(low)).alias("s0"),
        F.sum(F.shiftright(h, PART_BITS).bitwiseAND(low)).alias("s1"), F.sum(F.shiftrightunsigned(h, 2 * PART_BITS)).alias("s2"),
        F.bit_xor("__x").alias("x"))
    levels = leaves.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    up = F.expr(f"shiftright(bucket, {FAN_BITS} * ({depth} - level))")
    rolled = levels.groupBy("level", up.alias("bucket")).agg(*(F.sum(c).alias(c) for c in DIGEST[:-1]), F.bit_xor("x").alias("x"))
    return DigestTree(staged(rolled, "tree"), depth)


def differing_buckets(old: DigestTree, new: DigestTree) -> DataFrame:
    """`bucket` of the leaves that differ, at the level of the shallower tree's leaves."""
    found = None
    for level in range(min(old.depth, new.depth) + 1):
        sides = [t.table.where(F.col("level") == level).select("bucket", *DIGEST) for t in (old, new)]
        if found is not None:
            above = found.withColumnRenamed("bucket", "__above")
            sides = [s.join(above, F.shiftright("bucket", FAN_BITS) == F.col("__above"), "left_semi") for s in sides]
        tagged = sides[0].unionByName(sides[1])
        # a bucket that is equal has two equal digests, one that differs two digests or one row
        same = F.count(F.lit(1)) == 2
        for c in DIGEST:
            same = same & (F.min(c) == F.max(c))
        found = tagged.groupBy("bucket").agg(same.alias("same")).where(~F.col("same")).select("bucket")
    return found


def differing_versions(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Rows that occur unequally often, with `copies_old`, `copies_new` and `change` of their key.

    `change` is lost when the key has only rows that the old copy has more of, added when only
    rows that the new one has more of, else changed.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    tagged = old.select(*keys, *values, one.alias("__o"), none.alias("__n")).unionByName(
        new.select(*keys, *values, none.alias("__o"), one.alias("__n")))
    versions = tagged.groupBy(*keys, *values).agg(F.sum("__o").alias("copies_old"), F.sum("__n").alias("copies_new"))
    versions = versions.where("copies_old <> copies_new")
    lost, added = F.col("copies_old") > F.col("copies_new"), F.col("copies_old") < F.col("copies_new")
    marked = with_group_value(versions, keys, __lost=F.max(lost), __added=F.max(added))
    change = F.when(F.col("__lost") & F.col("__added"), "changed").when(F.col("__lost"), "lost").otherwise("added")
    return marked.withColumn("change", change).drop("__lost", "__added")


def difference(old: DataFrame, new: DataFrame, keys: list[str], values: list[str] | None = None) -> DataFrame:
    """Rows of two tables that differ, as `differing_versions`; equal buckets are not shuffled.

    Both tables are read twice: for their digests, and for the rows of the buckets that differ.
    """
    values = [c for c in old.columns if c not in keys] if values is None else values
    depth = depth_for(max(old.count(), new.count()))
    trees = [digest_tree(df, keys, values, depth) for df in (old, new)]
    buckets = staged(differing_buckets(*trees), "buckets")
    return differing_versions(*(rows_in(df, buckets, keys, depth) for df in (old, new)), keys, values)


def rows_in(df: DataFrame, buckets: DataFrame, keys: list[str], depth: int) -> DataFrame:
    """The rows of the given buckets; Spark broadcasts the buckets if their written size allows it."""
    wanted = buckets.withColumnRenamed("bucket", "__wanted")
    return df.join(wanted, bucket_of(keys, depth) == F.col("__wanted"), "left_semi")


def _folder_level(depth: int) -> int:
    return min(2, (depth + 1) // 2)


def write_copy(df: DataFrame, path: str, keys: list[str], values: list[str] | None = None, depth: int | None = None) -> str:
    """Write a table below a new folder so that single buckets can be read, beside its tree.

    Rows are in folders by the leading levels of their bucket and sorted by it inside their
    files; Spark's rebalancing splits folders that are too large for one task.
    """
    values = [c for c in df.columns if c not in keys] if values is None else values
    depth = depth_for(df.count()) if depth is None else depth
    bucket = bucket_of(keys, depth)
    folder = F.shiftright(F.col("__bucket"), FAN_BITS * (depth - _folder_level(depth)))
    placed = df.select(*keys, *values, bucket.alias("__bucket")).withColumn("__folder", folder)
    placed = placed.hint("rebalance", F.col("__folder")).sortWithinPartitions("__folder", "__bucket")
    placed.write.partitionBy("__folder").parquet(f"{path}/rows")
    tree = digest_tree(df, keys, values, depth)
    tree.table.withColumn("depth", F.lit(depth)).write.partitionBy("level").parquet(f"{path}/tree")
    return path


TREE = "bucket long, rows long, s0 long, s1 long, s2 long, x long, depth int, level int"


def read_tree(spark: SparkSession, path: str) -> DigestTree:
    table = spark.read.schema(TREE).parquet(f"{path}/tree")
    return DigestTree(table, table.agg(F.max("depth")).first()[0] or 0)


def read_copy(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A written table with its `__bucket` and `__folder`; `schema` is that of the table."""
    held = T.StructType([*schema.fields, T.StructField("__bucket", T.LongType()), T.StructField("__folder", T.LongType())])
    return spark.read.schema(held).parquet(f"{path}/rows")


def _rows_of_copy(copy: DataFrame, own_depth: int, depth: int, buckets: DataFrame, few: list[int] | None) -> DataFrame:
    """The rows of buckets of a level: by constants that reach folders and files, or by a join if they are many."""
    bucket = F.shiftright("__bucket", FAN_BITS * (own_depth - depth)) if own_depth > depth else F.col("__bucket")
    if few is None:
        return copy.join(buckets.withColumnRenamed("bucket", "__wanted"), bucket == F.col("__wanted"), "left_semi")
    level = _folder_level(own_depth)
    if level <= depth:
        copy = copy.where(F.col("__folder").isin(sorted({b >> (FAN_BITS * (depth - level)) for b in few})))
    return copy.where(bucket.isin(few))


def copy_difference(spark: SparkSession, old: str, new: str, keys: list[str], schema: T.StructType) -> DataFrame:
    """Rows that differ between two written copies, as `differing_versions`; other buckets are not read.

    `schema` has the columns as written: keys, then values.
    """
    trees = [read_tree(spark, p) for p in (old, new)]
    depth = min(t.depth for t in trees)
    buckets = staged(differing_buckets(*trees), "buckets")
    first = [r.bucket for r in buckets.limit(MOST_LITERALS + 1).collect()]
    few = first if len(first) <= MOST_LITERALS else None
    sides = [_rows_of_copy(read_copy(spark, p, schema), t.depth, depth, buckets, few) for p, t in zip((old, new), trees)]
    return differing_versions(*sides, keys, [f.name for f in schema if f.name not in keys])


def changed_columns(versions: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Per column, how many keys changed it: (column, keys). Keys with one old and one new row only."""
    row, lost = F.struct(*values), F.col("copies_old") > F.col("copies_new")
    both = versions.where("change = 'changed'").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), F.max(F.when(lost, row)).alias("__o"), F.max(F.when(~lost, row)).alias("__w"))
    both = both.where((F.col("__n") == 2) & F.col("__o").isNotNull() & F.col("__w").isNotNull())
    changes = F.array_compact(F.array(*(F.when(~F.col(f"__o.{c}").eqNullSafe(F.col(f"__w.{c}")), F.lit(c)) for c in values)))
    return both.select(F.explode(changes).alias("column")).groupBy("column").agg(F.count(F.lit(1)).alias("keys"))
