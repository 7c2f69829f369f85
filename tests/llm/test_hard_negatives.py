from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import hard_negatives as H
from ledgerloom.llm.hard_negatives import hard_negatives, hilbert_keys, op12_hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, anchor, positives=5, negatives=5, low=80, high=100, scale=256.0):
    held = []
    for i, (key, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x * scale) for x in vector):
            continue
        held.append((i, key, [int(math.floor(x * scale)) for x in vector], label))
    out = []
    for i, key, v, label in held:
        if key is None or not anchor(key):
            continue
        score = {j: sum(a * b for a, b in zip(v, w)) for j, _, w, _ in held}
        order = sorted((x for x in held if x[0] != i), key=lambda x: (-score[x[0]], x[1] is None, x[1] or 0))
        for p in [x for x in order if x[3] == label][:positives]:
            s = score[p[0]]
            fits = [x for x in order if x[3] != label and low * s <= 100 * score[x[0]] <= high * s][:negatives]
            out += [(key, p[1], r, n[1], s, score[n[0]]) for r, n in enumerate(fits, 1)]
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def mined(spark, rows, schema=SCHEMA, **more):
    return result(hard_negatives(spark.createDataFrame(rows, schema), F.col("vec_id") % 5 == 0, **more))


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 16)
    monkeypatch.setattr(H, "SEGMENT_BLOCKS", 2)
    monkeypatch.setattr(H, "GROUP", 3)
    monkeypatch.setattr(H, "CHUNK", 7)


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 3), (3, 2), (4, 1), (2, 1)])
def test_curve_visits_neighbours(dims, bits):
    """Successive places of the curve are grid points one step apart."""
    grid = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = hilbert_keys(grid, bits)
    assert len(set(keys)) == len(grid)
    order = grid[sorted(range(len(grid)), key=keys.__getitem__)]
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_bounds_enclose_all_scores():
    rng = np.random.default_rng(1)
    for size in (1.0, 1e9, 1e150, 1e307):
        b = rng.normal(size=(50, 6)) * size
        a = rng.normal(size=(9, 6)) * 100
        least, most = H._bounds(a, b.min(axis=0)[None], b.max(axis=0)[None])
        with np.errstate(over="ignore", invalid="ignore"):
            scores = np.nan_to_num(a @ b.T, posinf=0, neginf=0)
        assert (least <= scores).all() and (scores <= most).all()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed, small_blocks):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = []
    for key in range(260):
        c = rng.choice(centres)
        spread = rng.choice([0.0, 0.05, 0.4])  # equal vectors and ties too
        rows.append((key, [x + rng.gauss(0, spread) if spread else x for x in c], rng.randrange(4)))
    rng.shuffle(rows)
    assert mined(spark, rows) == brute(rows, lambda k: k % 5 == 0)
    more = {"positives": 2, "negatives": 7, "low": 50, "high": 120, "scale": 10.0}
    assert mined(spark, rows, **more) == brute(rows, lambda k: k % 5 == 0, **more)


def test_zone_maps_spare_blocks(spark, small_blocks, monkeypatch):
    """Tight, well separated clusters: an anchor is sent to few segments, once its own block has enough of its label."""
    monkeypatch.setattr(H, "BLOCK", 32)
    rng = random.Random(7)
    centres = [[20.0 * s if d == c else 0.0 for d in range(3)] for c in range(3) for s in (-1, 1)]
    rows = [(k, [x + rng.gauss(0, 0.01) for x in centres[k % 6]], (k // 6) % 2) for k in range(1920)]
    data = spark.createDataFrame(rows, "id long, vector array<double>, label long").withColumn("anchor", F.col("id") % 5 == 0)
    blocks = H.build_blocks(data.select("id", "label", "anchor", "vector"), 3, 256.0)
    segments = blocks.select("segment").distinct().count()
    mine = blocks.where(F.size("anchors") > 0).mapInArrow(H._own_best(3, 5), H._ANCHORS)
    routed = H._route(mine, blocks, segments, 4, lambda rows, own, least, most, labels:
                      H._has_label(own, labels) & (most >= H._limits([r["reached"] for r in rows])[:, None]), 3)
    assert routed.count() < 0.4 * mine.count() * segments
    assert mined(spark, rows) == brute(rows, lambda k: k % 5 == 0)


def test_nulls_infinities_ragged_and_missing(spark, small_blocks):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (5, None, 1), (10, [nan, 1.0], 1), (15, [1.0, inf], 1), (20, [1.0, None], 1), (25, [1.0, 2.0], None),
            (30, [], 2), (35, [1.0], 1), (40, [1.0, 2.0, -3.0], 2), (None, [1.0, 1.9], 2), (None, [1.0, 2.0], 1), (3, [0.9, 1.9], 3), (4, [1.0, 2.0], 2)]
    assert mined(spark, rows) == brute(rows, lambda k: k % 5 == 0)
    assert any(r[3] is None for r in mined(spark, rows))


def test_huge_components_are_exact(spark, small_blocks):
    rng = random.Random(9)
    for size in (3000.0, 2.0 ** 26):
        rows = [(k, [rng.random() * size for _ in range(3)], rng.randrange(2)) for k in range(60)]
        assert mined(spark, rows, scale=1.0) == brute(rows, lambda k: k % 5 == 0, scale=1.0)
    rows = [(k, [2.0 ** 29 + rng.randrange(50), 2.0 ** 29 + rng.randrange(50)], rng.randrange(2)) for k in range(60)]  # sums above 2**53
    assert mined(spark, rows, scale=1.0) == brute(rows, lambda k: k % 5 == 0, scale=1.0)
    assert mined(spark, [(0, [1e300], 1), (1, [1e300], 1), (2, [1e300], 2)])[0][4:] == (2 ** 63 - 1, 2 ** 63 - 1)


def test_repeated_rows_empty_table_and_clashing_columns(spark, small_blocks):
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [1.0, 0.4], 2), (1, [1.0, 0.4], 2)]
    assert mined(spark, rows) == brute(rows, lambda k: k % 5 == 0)
    assert mined(spark, rows[:1]) == mined(spark, rows[2:]) == mined(spark, rows[:2]) == []
    empty = spark.createDataFrame(rows, SCHEMA).limit(0)
    assert result(hard_negatives(empty, F.col("vec_id") % 5 == 0)) == []
    clash = spark.createDataFrame([(*r, 7, 8, "x", "y") for r in rows], SCHEMA + ", id long, anchor int, vector string, segment string")
    assert result(hard_negatives(clash, F.col("vec_id") % 5 == 0)) == brute(rows, lambda k: k % 5 == 0)


def test_one_vector_many_times(spark, small_blocks):
    rows = [(k, [0.25, -0.5], k % 3) for k in range(200)] + [(200 + k, [0.1 * k, 0.3], k % 3) for k in range(30)]
    assert mined(spark, rows) == brute(rows, lambda k: k % 5 == 0)


def test_query_on_a_small_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in
            spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert result(op12_hard_negatives(spark, folder)) == brute(rows, lambda k: k % 100 == 0)
