"""Pairwise-complete correlations of thousands of series.

`grouping.correlations` has one aggregate per pair of columns, which suits tens of columns. Here series are
rows in long form. They are dealt to blocks; the values of a block at one point (a date) become one
vector. Every pair of blocks meets once: for its points, matrix products give for all pairs of
series at once the number of common points and the sums of x, y, x*x, y*y and x*y over them, with
a mask for missing values. Values are taken relative to their series' mean, so the sums lose no
digits to large levels.

With many points a task holds the sums of one pair of blocks, and a few hundred points at a time. With
few points (`POINTS` a group) it holds the points instead and goes through the pairs tile by tile, so blocks
may be wide, which sends every vector to fewer tasks, and a pair that is too weak never leaves its task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import staged

BLOCK = 256
POINTS = 256
POINTS_A_TASK = 100_000
BLOCKS = 32  # of very many series at few points, as long as a block's points stay below `CELLS` and `WIDEST`
CELLS = 1 << 20
WIDEST = 8192
TILE = 512
SLACK = 1e-6  # tasks drop pairs by a rough bound, the exact one follows
SUMS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def _products(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """n, sx, sy, sxx, syy and sxy of all pairs, over matrices of points by series in which a missing value is NaN."""
    mx, my = (~np.isnan(x)).astype(float), (~np.isnan(y)).astype(float)
    x, y = np.nan_to_num(x), np.nan_to_num(y)
    return [a.T @ b for a, b in [(mx, my), (x, my), (mx, y), (x * x, my), (mx, y * y), (x, y)]]


class _Sums:
    """The sums of one pair of blocks and one group, added up over its points."""

    def __init__(self, width: int):
        self.left, self.right = [], []
        self.sums = np.zeros((len(SUMS), width, width))

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        self.left.append(left)
        self.right.append(right)
        if len(self.left) == POINTS:
            self.flush()

    def flush(self) -> None:
        if not self.left:
            return
        x, y = np.stack(self.left), np.stack(self.right)
        self.left, self.right = [], []
        for k, found in enumerate(_products(x, y)):
            self.sums[k] += found

    def parts(self, same: bool) -> Iterator[tuple[int, int, list[np.ndarray], np.ndarray]]:
        """(first slot left, first slot right, sums, which of them count)."""
        self.flush()
        wanted = self.sums[0] > 0
        yield 0, 0, list(self.sums), np.triu(wanted) if same else wanted


class _Tiles:
    """The points of one pair of blocks and one group; their sums are made tile by tile and only those that can pass are kept."""

    def __init__(self, least: int, low: float | None):
        self.least, self.low = least, low
        self.left, self.right = [], []

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        self.left.append(left)
        self.right.append(right)

    def parts(self, same: bool) -> Iterator[tuple[int, int, list[np.ndarray], np.ndarray]]:
        if not self.left:
            return
        x, y = np.stack(self.left), np.stack(self.right)
        for a in range(0, x.shape[1], TILE):
            for b in range(a if same else 0, y.shape[1], TILE):
                sums = _products(x[:, a:a + TILE], y[:, b:b + TILE])
                wanted = sums[0] >= max(1, self.least)
                if self.low is not None:
                    n, sx, sy, sxx, syy, sxy = sums
                    with np.errstate(all="ignore"):
                        rough = (n * sxy - sx * sy) / np.sqrt(n * sxx - sx * sx) / np.sqrt(n * syy - sy * sy)
                        wanted &= np.abs(rough) > self.low - SLACK
                yield a, b, sums, np.triu(wanted) if same and a == b else wanted


def _gram(width: int, few: bool, least: int, low: float | None):
    def vector(slots: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.full(width, np.nan)
        out[slots] = values
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group, sums, point, waiting = None, None, None, None, None

        def done() -> Iterator[pa.RecordBatch]:
            for first_a, first_b, found, wanted in sums.parts(key[0] == key[1]):
                a, b = np.nonzero(wanted)
                if len(a):
                    fixed = [pa.array(np.full(len(a), k, np.int32)) for k in key[:2]]
                    cells = [pa.array((c + first).astype(np.int32)) for c, first in ((a, first_a), (b, first_b))] + [pa.array(f[a, b]) for f in found]
                    yield pa.RecordBatch.from_arrays([group.take(pa.array(np.zeros(len(a), np.int64)))] + fixed + cells, ["grp", "i", "j", "a", "b", *SUMS])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("i", "j", "salt", "grp", "at", "block")]
            slots, values = (batch.column(c).values.to_numpy(zero_copy_only=False) for c in ("slots", "vals"))
            ends, starts = (batch.column(c).offsets.to_numpy() for c in ("slots", "vals"))
            for row, (i, j, salt, grp, at, block) in enumerate(zip(*columns)):
                if key != (i, j, salt, grp):
                    if sums is not None:
                        yield from done()
                    key, group, sums, point = (i, j, salt, grp), batch.column("grp").slice(row, 1), _Tiles(least, low) if few else _Sums(width), None
                own = vector(slots[ends[row]:ends[row + 1]], values[starts[row]:starts[row + 1]])
                if i == j:
                    sums.add(own, own)
                elif point == (at,) and block == j:
                    sums.add(waiting, own)
                else:
                    point, waiting = (at,), own
        if sums is not None:
            yield from done()

    return run


def series_correlations(df: DataFrame, series: str, at: list[str], value: str, by: list[str] | None = None, block: int = BLOCK,
                        least: int = 1, low: float | None = None) -> DataFrame:
    """(by..., series_a, series_b, n, corr) of all pairs a <= b of series that share a point, per group.

    Several values of a series at one point count as their mean. Null and NaN values are missing. `corr` is
    null where a series does not vary over the common points. Only pairs with at least `least` common points
    and, if given, a magnitude of `corr` above `low` are returned.
    """
    by = by or []
    rows = df.select(F.struct(*(by or [F.lit(0).alias("none")])).alias("grp"), F.struct(*at).alias("at"), F.col(series).alias("series"),
                     F.col(value).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v) AND series IS NOT NULL")
    means = staged(rows.groupBy("series").agg(F.avg("v").alias("mean")), "means")
    count, few = means.count(), False
    if low is not None or count > BLOCKS * block:
        points = rows.groupBy("grp").agg(F.approx_count_distinct("at").alias("n")).agg(F.max("n")).first()[0] or 1
        if few := points <= POINTS:
            block = max(block, min(-(-count // BLOCKS), CELLS // points, WIDEST))
    blocks = max(1, -(-count // block))
    slot = F.expr("row_number() OVER (PARTITION BY block ORDER BY series) - 1")  # a block's series only
    names = staged(means.withColumn("block", F.pmod(F.xxhash64("series"), F.lit(blocks)).cast("int")).withColumn("slot", slot.cast("int")), "names")
    size = names.agg(F.max("slot")).first()[0]
    placed = rows.join(names, "series").select("grp", "at", "block", "slot", (F.col("v") - F.col("mean")).alias("v"))
    cells = placed.groupBy("grp", "at", "block", "slot").agg(F.avg("v").alias("v"))
    vectors = cells.groupBy("grp", "at", "block").agg(F.sort_array(F.collect_list(F.struct("slot", "v"))).alias("cells"))  # at most a block
    vectors = staged(vectors, "vectors")
    salts = max(1, -(-vectors.count() // (blocks * POINTS_A_TASK)))
    pairs = blocks * (blocks + 1) // 2
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    sent = vectors.select("grp", "at", "block", "cells", other).select(
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), F.pmod(F.xxhash64("grp" if few else "at"), F.lit(salts)).cast("int").alias("salt"),
        "grp", "at", "block", F.col("cells.slot").alias("slots"), F.col("cells.v").alias("vals"))
    dealt = sent.repartition(min(4096, max(1, pairs * salts)), "i", "j", "salt").sortWithinPartitions("i", "j", "salt", "grp", "at", "block")
    kind = vectors.schema["grp"].dataType.simpleString()
    schema = f"grp {kind}, i int, j int, a int, b int, " + ", ".join(f"{c} double" for c in SUMS)
    sums = dealt.mapInArrow(_gram((size or 0) + 1, few, least, low), schema)
    if not few:
        sums = sums.groupBy("grp", "i", "j", "a", "b").agg(*(F.sum(c).alias(c) for c in SUMS))
    sums = sums.where(F.col("n") >= least)
    for side, number, place in (("a", "i", "a"), ("b", "j", "b")):
        own = names.select(F.col("series").alias(f"series_{side}"), F.col("block").alias(number), F.col("slot").alias(place))
        sums = sums.join(own, [number, place])
    swap = F.col("series_a") > F.col("series_b")  # blocks are in another order than names
    ends = [F.when(swap, F.col(f"series_{b}")).otherwise(F.col(f"series_{a}")).alias(f"series_{a}") for a, b in (("a", "b"), ("b", "a"))]

    def spread(total: str, squares: str):
        own = F.col("n") * F.col(squares) - F.col(total) * F.col(total)
        return F.when(own > 1e-12 * F.col("n") * F.col(squares), own)

    corr = (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / F.sqrt(spread("sx", "sxx")) / F.sqrt(spread("sy", "syy"))
    found = sums.select(*(F.col("grp").getField(c).alias(c) for c in by), *ends, F.col("n").cast("long").alias("n"),
                        F.when(corr.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), corr))).alias("corr"))
    return found if low is None else found.where(F.abs("corr") > low)


def strong(correlations: DataFrame, low: float, high: float = 1.0) -> DataFrame:
    """Pairs of different series whose correlation lies between two magnitudes."""
    size = F.abs("corr")
    return correlations.where((F.col("series_a") != F.col("series_b")) & (size > low) & (size < high))
