"""Connected components of a link table, by star contractions with union-find inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import lean, staged

MAX_ROUNDS = 60
LINKS = 1 << 20  # that a task takes in before it contracts them


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of the same components in which every node but the smallest is linked with the smallest.

    Roots are hooked onto smaller ones along all links at once, then paths are halved until they are flat.
    """
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = place[:len(a)], place[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        hooked = root.copy()
        np.minimum.at(hooked, root[u], low)
        np.minimum.at(hooked, root[v], low)
        while (flat := hooked[hooked]).tobytes() != hooked.tobytes():
            hooked = flat
        if (hooked == root).all():
            break
        root = hooked
    inner = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[inner], nodes[root[inner]]


@lean
def contract(batches):
    """The links of a task as stars; it holds the nodes it has seen and a bounded number of links."""
    a, b, more, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0
    for batch in batches:
        more.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size >= max(LINKS, len(a)):
            a, b = stars(*(np.concatenate([own, *(m[i] for m in more)]) for i, own in enumerate((a, b))))
            more, size = [], 0
    if more:
        a, b = stars(*(np.concatenate([own, *(m[i] for m in more)]) for i, own in enumerate((a, b))))
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _settled(links: DataFrame) -> bool:
    """Whether every node has one leader, and no leader has another."""
    none = F.lit(None).cast("long")
    ends = links.select(F.col("a").alias("node"), F.col("b").alias("to"), F.lit(False).alias("leads")).union(
        links.select("b", none, F.lit(True)))
    nodes = ends.groupBy("node").agg(F.min("to").alias("low"), F.max("to").alias("high"), F.max("leads").alias("leads"))
    return not nodes.where("low <> high OR (leads AND low IS NOT NULL)").limit(1).count()


def components(links: DataFrame, a: str = "a", b: str = "b", contracted: bool = False) -> DataFrame:
    """(node, component) of every node in a link; the component is its smallest node.

    Links may be repeated, in either direction or loops; nulls are ignored; nodes are longs. Links are
    kept as (larger, smaller). A round leads the larger end of every link to the smallest
    neighbour of the smaller end, found by minima that are combined before the shuffle; then the
    links of a larger end meet in one task, where union-find contracts whatever has come together. A node
    that most links lead to is only ever the key of a join, which Spark splits. Each round is written to the
    shared folder, so lineage stays short. `contracted` says that the tasks that make the links have contracted
    them already, so that no second Python worker runs beside theirs.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    links = links.where(x.isNotNull() & y.isNotNull() & (x != y)).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
    links = staged(links if contracted else links.mapInArrow(contract, "a long, b long"), "links")
    for _ in range(MAX_ROUNDS):
        if _settled(links):
            break
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        led = links.join(least, F.col("b") == F.col("node")).select("a", F.least("b", "m").alias("b"))
        links = staged(led.repartition("a").mapInArrow(contract, "a long, b long"), "links")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    found = links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")))
    return found.distinct()
