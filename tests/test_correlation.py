from __future__ import annotations

import math
import random

import numpy as np
import pytest

from ledgerloom.operators import correlation as C


def brute(rows):
    """rows of (group, at, series, value)."""
    cells = {}
    for g, t, s, v in rows:
        if v is not None and not math.isnan(v) and s is not None:
            cells.setdefault((g, t, s), []).append(v)
    cells = {k: sum(v) / len(v) for k, v in cells.items()}
    out = {}
    for g in {k[0] for k in cells}:
        names = sorted({k[2] for k in cells if k[0] == g})
        for i, a in enumerate(names):
            for b in names[i:]:
                at = [t for t in sorted({k[1] for k in cells if k[0] == g}) if (g, t, a) in cells and (g, t, b) in cells]
                if at:
                    x, y = (np.array([cells[g, t, s] for t in at]) for s in (a, b))
                    varies = len(at) > 1 and np.ptp(x) > 0 and np.ptp(y) > 0
                    out[g, a, b] = (len(at), float(np.corrcoef(x, y)[0, 1]) if varies else None)
    return out


def sample(seed, n_series, n_points, level=0.0):
    rng = random.Random(seed)
    rows = []
    for g in ("p", None):
        for t in range(n_points):
            base = rng.gauss(0, 1)
            for s in range(n_series):
                if rng.random() < 0.8:
                    rows.append((g, t, f"s{s}", level + base * (s % 3) + rng.gauss(0, 1) if s != 1 else 5.0))
                if rng.random() < 0.05:
                    rows.append((g, t, f"s{s}", rng.choice([None, float("nan"), level + 1.0])))
    return rows


def check(make, rows, **more):
    df = make(rows, "g string, t int, s string, v double")
    got = {(r.g, r.series_a, r.series_b): (r.n, r["corr"]) for r in C.series_correlations(df, "s", ["t"], "v", ["g"], **more).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    for k, (n, r) in want.items():
        assert got[k][0] == n and (got[k][1] is None if r is None else got[k][1] == pytest.approx(r, abs=1e-9)), (k, got[k], n, r)


@pytest.mark.parametrize("block", [1, 4, 256])
def test_against_numpy(make, block):
    check(make, sample(1, 11, 40), block=block)


def test_many_points_salts_and_large_levels(make, monkeypatch):
    monkeypatch.setattr(C, "POINTS", 7)
    monkeypatch.setattr(C, "POINTS_A_TASK", 10)
    check(make, sample(2, 6, 60, level=1e7), block=3)


def test_empty_single_and_constant(make):
    schema = "g string, t int, s string, v double"
    assert C.series_correlations(make([], schema), "s", ["t"], "v").count() == 0
    found = C.series_correlations(make([("x", 1, "a", 2.0), ("x", 2, "a", 2.0), ("x", 1, "b", 1.0)], schema), "s", ["t"], "v").collect()
    assert {(r.series_a, r.series_b, r.n, r["corr"]) for r in found} == {("a", "a", 2, None), ("b", "b", 1, None), ("a", "b", 1, None)}


@pytest.mark.parametrize("points,wide", [(60, 1), (60, 1000), (4, 1)])  # held points, narrow and wide, and added sums
def test_weak_pairs_are_dropped_in_their_task(make, monkeypatch, points, wide):
    rows = sample(3, 13, 40)
    monkeypatch.setattr(C, "POINTS", points)
    monkeypatch.setattr(C, "BLOCKS", wide)
    monkeypatch.setattr(C, "TILE", 3)
    df = make(rows, "g string, t int, s string, v double")
    got = {(r.g, r.series_a, r.series_b): (r.n, r["corr"]) for r in C.series_correlations(
        df, "s", ["t"], "v", ["g"], block=4, least=25, low=0.3).collect()}
    want = {k: v for k, v in brute(rows).items() if v[0] >= 25 and v[1] is not None and abs(v[1]) > 0.3}
    assert set(got) == set(want) and 0 < len(want) < len(brute(rows))
    assert all(got[k][0] == n and got[k][1] == pytest.approx(r, abs=1e-9) for k, (n, r) in want.items())


def test_tasks_give_out_only_pairs_that_can_pass():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    x = rng.normal(size=(84, 1500))
    x[:, 7] = x[:, 1400] + 0.1 * rng.normal(size=84)
    held = [(0, 0, 0, {"none": 0}, {"t": t}, 0, list(range(1500)), x[t].tolist()) for t in range(84)]
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("salt", pa.int32()), ("grp", pa.struct([("none", pa.int32())])),
                        ("at", pa.struct([("t", pa.int32())])), ("block", pa.int32()), ("slots", pa.list_(pa.int32())), ("vals", pa.list_(pa.float64()))])
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
    parts = [batch.slice(0, 30), batch.slice(30)]
    found = pa.Table.from_batches(C._gram(1500, True, 12, 0.8)(iter(parts))).to_pylist()
    assert {(r["a"], r["b"]) for r in found if r["a"] != r["b"]} == {(7, 1400)} and len(found) == 1501


def test_thousand_series_stay_one_small_plan(spark, make):
    from pyspark.sql import functions as F

    df = spark.range(1000 * 12).select((F.col("id") % 1000).alias("s"), F.floor(F.col("id") / 1000).alias("t"), F.sin(F.col("id") * 0.37).alias("v"))
    found = C.series_correlations(df, "s", ["t"], "v")
    assert len(found._jdf.queryExecution().analyzed().toString()) < 40_000
    assert found.count() == 1000 * 1001 // 2
    x = np.sin(np.arange(12_000) * 0.37).reshape(12, 1000)
    row = found.where("series_a = 17 AND series_b = 905").first()
    assert row["corr"] == pytest.approx(np.corrcoef(x[:, 17], x[:, 905])[0, 1], abs=1e-9)


def test_strong(make):
    rows = [("a", "a", 1.0), ("a", "b", 0.9), ("a", "c", -0.95), ("b", "c", 0.2), ("b", "d", None)]
    df = make(rows, "series_a string, series_b string, corr double")
    assert {(r.series_a, r.series_b) for r in C.strong(df, 0.87).collect()} == {("a", "b"), ("a", "c")}
