"""Exact ranks, bitmaps of distinct keys, keyword dictionaries."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import bitmaps as B
from ledgerloom.operators import keywords as K
from ledgerloom.operators.ranking import rank_lines, with_rank
from tests.conftest import rows


def brute_ranks(data, way):
    keys = sorted({k for k, _ in data if k is not None}, reverse=way == "desc") + ([None] if any(k is None for k, _ in data) else [])
    out, before, running, whole = {}, 0, 0.0, sum(v or 0 for _, v in data)
    for i, k in enumerate(keys, 1):
        own = [v for x, v in data if x == k]
        running += sum(v or 0 for v in own)
        out[k] = (before + 1, i, running, running / whole if whole else None)
        before += len(own)
    return out


@pytest.mark.parametrize("way", ["asc", "desc"])
@pytest.mark.parametrize("lines", [7, 10 ** 6])
def test_ranks_against_a_sorted_list(make, way, lines):
    rng = random.Random(3)
    data = [(rng.choice([None, *range(60)]), rng.choice([None, 1.0, 2.5])) for _ in range(400)] + [(5, 1.0)] * 300
    got = with_rank(make(data, "k int, v double"), {"k": way}, "v", lines).collect()
    want = brute_ranks(data, way)
    assert len(got) == len(data)
    for r in got:
        assert (r.rank, r.dense_rank, r.running, r.share) == pytest.approx(want[r.k]), r


def test_ranks_by_several_columns_and_of_nothing(make):
    df = make([("a", 2), ("a", 1), ("b", 1), ("a", 2)], "g string, k int")
    got = rank_lines(df, {"g": "desc", "k": "asc"}, lines=1)
    assert rows(got.select("g", "k", "rows", "rank", "dense_rank")) == {("b", 1, 1, 1, 1), ("a", 1, 1, 2, 2), ("a", 2, 2, 3, 3)}
    assert with_rank(df.limit(0), {"k": "asc"}).count() == 0
    with pytest.raises(ValueError):
        rank_lines(df, {"k": "down"})


def test_bitmaps_against_sets(make, monkeypatch):
    monkeypatch.setattr(B, "PART", 17)
    rng = random.Random(5)
    days = [f"2024-01-{d:02d}" for d in range(1, 11)]
    data = [(rng.choice("xyz"), rng.choice(days), rng.choice([None, *(f"k{i}" for i in range(200))])) for _ in range(3000)]
    df = make(data, "g string, d string, k string")
    words = B.number_keys(df, "k")
    numbers = [r.number for r in words.collect()]
    assert len(numbers) == len(set(numbers)) == 200
    maps = B.day_bitmaps(df, ["g"], "d", "k", words)

    def keys(g, a, b):
        return {k for x, d, k in data if x == g and a <= d <= b and k is not None}

    spans = (days[0], days[3]), (days[2], days[9])
    assert rows(B.span_counts(maps, ["g"], *spans[0])) == {(g, len(keys(g, *spans[0]))) for g in "xyz"}
    want = set()
    for g in "xyz":
        a, b = keys(g, *spans[0]), keys(g, *spans[1])
        want.add((g, len(a & b), len(a - b), len(b - a), a == b))
    assert rows(B.compare_spans(maps, ["g"], *spans)) == want
    a, b = keys("x", days[0], days[9]), keys("y", days[0], days[9])
    assert rows(B.group_coverage(maps, "g", "x", "y")) == {(len(a & b), len(a - b), len(b - a))}


def test_numbers_stay_when_keys_are_added(make):
    first = B.number_keys(make([("a",), ("b",), (None,)], "k string"), "k")
    second = B.number_keys(make([("b",), ("c",), ("d",)], "k string"), "k", first)
    old = {r.k: r.number for r in first.collect()}
    new = {r.k: r.number for r in second.collect()}
    assert {k: new[k] for k in old} == old and len(set(new.values())) == 4


def test_large_numbers_take_several_buckets(spark):
    df = spark.range(100_000).select(F.lit("g").alias("g"), F.lit("2024-01-01").alias("d"), F.col("id").alias("k"))
    maps = B.day_bitmaps(df, ["g"], "d", "k", B.number_keys(df, "k"))
    assert maps.count() >= 4 and rows(B.span_counts(maps, ["g"], "2024-01-01", "2024-01-01")) == {("g", 100_000)}


@pytest.mark.parametrize("seed", [1, 2])
def test_keywords_against_search(make, seed, monkeypatch):
    rng = random.Random(seed)
    letters = "abcé "
    words = ["".join(rng.choices(letters, k=rng.choice([1, 2, 3, 4, 9]))) for _ in range(60)] + ["", None, "ABC"]
    rules = [(w, i) for i, w in enumerate(words)]
    texts = ["".join(rng.choices(letters + "xyzABC", k=rng.choice([0, 1, 2, 5, 30, 200]))) for _ in range(300)] + [None, ""]
    df = make([(i, t) for i, t in enumerate(texts)], "id int, t string")
    table = make(rules, "keyword string, rule_no int")
    want = {i: max((n for w, n in rules if w and t and w.lower() in t.lower()), default=None) for i, t in enumerate(texts)}
    for size in (10 ** 6, 25):
        monkeypatch.setattr(K, "KEYWORDS", size)
        assert {r.id: r.rule_no for r in K.last_rule(df, "t", table).collect()} == want


@pytest.mark.parametrize("piece", [1, 2, 7, 64])
def test_keywords_across_pieces(piece, monkeypatch):
    import numpy as np

    rng = random.Random(piece)
    words = [bytes(rng.choices(b"ab", k=k)) for k in (1, 2, 3, 5, 9, 9)] + [b"q"]
    texts = [bytes(rng.choices(b"abcc", k=rng.choice([0, 1, 4, 40]))) for _ in range(60)]
    monkeypatch.setattr(K, "PIECE", piece)
    found = K.Dictionary(words, list(range(len(words)))).last_rules(
        np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    assert found.tolist() == [max((i for i, w in enumerate(words) if w in t), default=-1) for t in texts]


def test_keywords_take_bounded_memory(monkeypatch):
    import tracemalloc

    import numpy as np

    data = np.frombuffer(b"some words of a long text, keyword among them. " * 400_000, np.uint8)
    held = K.Dictionary([b"keyword", b"words of", b"never"], [1, 2, 3])
    tracemalloc.start()
    try:
        assert held.last_rules(data, np.array([0, 30, len(data)])).tolist() == [2, 2]
        assert tracemalloc.get_traced_memory()[1] < 3 * len(data)
    finally:
        tracemalloc.stop()


def test_twenty_thousand_keywords(spark, small):
    texts = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    words = [f"w{i}q{i * 7 % 1000}" for i in range(19_990)] + ["the ", "ing", "Tion", "und", "les ", "est", "ähn", "zzzz", "on the", "."]
    table = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "keyword string, rule_no int")
    held = {r.doc_id: r.text for r in texts.collect()}
    few = [(w.lower(), i) for i, w in enumerate(words) if i >= 19_990]
    want = {k: max((n for w, n in few if w in (t or "").lower()), default=None) for k, t in held.items()}
    found = K.last_rule(texts, "text", table)
    assert {r.doc_id: r.rule_no for r in found.collect()} == want
    assert len(found._jdf.queryExecution().analyzed().toString()) < 5_000


@pytest.mark.parametrize("few,steps", [(30, 50), (60, 4), (10_000, 50)])
def test_quantiles_of_adversarial_values(make, few, steps, monkeypatch):
    import numpy as np

    from ledgerloom.operators import selection as S

    rng = np.random.default_rng(2)
    data = {
        "normal": rng.normal(size=700).tolist(), "wide": (10.0 ** rng.uniform(-300, 300, 400)).tolist(), "ties": [1.0] * 500 + [2.0] * 3,
        "one": [4.0], "two": [1.0, 2.0], "close": [1.0 + i * 2.0 ** -52 for i in range(300)], None: [0.0, -0.0, 5.0], "signs": [-1e308, 1e308, 0.0, -5.0] * 20,
    }
    df = make([(k, float(v)) for k, vs in data.items() for v in vs] + [("one", None), ("none", None)], "k string, v double")
    qs = {"a": 0.0, "b": 0.3, "c": 0.5, "e": 1.0}
    monkeypatch.setattr(S, "STEPS", steps)  # a poor sketch as well
    got = {r.k: r for r in S.select_quantiles(df, ["k"], "v", qs, few).collect()}
    assert set(got) == set(data)
    for k, vs in data.items():
        assert got[k].n == len(vs)
        own = sorted(vs)
        for name, q in qs.items():
            at = (len(vs) - 1) * q
            low, high = own[int(at // 1)], own[-int(-at // 1)]
            assert got[k][name] == pytest.approx(low + (high - low) * (at - at // 1), rel=1e-12, abs=0), (k, name)


def test_quantiles_without_keys_and_of_nothing(make):
    from ledgerloom.operators.selection import select_quantiles

    df = make([("a", 3.0), ("b", 1.0), ("c", 2.0)], "k string, v double")
    assert rows(select_quantiles(df, [], "v", {"m": 0.5})) == {(3, 2.0)}
    assert select_quantiles(df.limit(0), ["k"], "v", {"m": 0.5}).count() == 0
