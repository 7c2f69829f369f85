from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.mixing import bisect_exponent, mix, source_weights


def shares(spark, tokens):
    total = sum(tokens.values())
    return spark.createDataFrame([(k, v, v / total) for k, v in tokens.items()], "g string, tokens long, p double")


TOKENS = {"a": 5000, "b": 1200, "c": 300, "d": 40}


def entropy(tokens, e):
    q = [(v / sum(tokens.values())) ** e for v in tokens.values()]
    return -sum(x / sum(q) * math.log(x / sum(q)) for x in q)


def test_exponent_meets_the_repetition(spark):
    e = bisect_exponent(shares(spark, TOKENS), repetition=3.0)
    assert e == pytest.approx(1 - math.log(3) / math.log(5000 / 40), abs=1e-9)
    assert bisect_exponent(shares(spark, TOKENS), repetition=1000.0) == 0
    assert bisect_exponent(shares(spark, TOKENS), repetition=1.0) == pytest.approx(1)


def test_exponent_meets_the_entropy(spark):
    e = bisect_exponent(shares(spark, TOKENS), entropy=1.1)
    assert entropy(TOKENS, e) == pytest.approx(1.1, abs=1e-9) and 0 < e < 1
    assert bisect_exponent(shares(spark, TOKENS), entropy=5.0) == 0
    assert bisect_exponent(shares(spark, TOKENS), entropy=0.0) == 1


def test_weights_of_one_or_no_source(spark):
    one = source_weights(spark.createDataFrame([("a", 10)], "g string, tokens long")).collect()
    assert [r.weight for r in one] == [1.0]
    none = source_weights(spark.createDataFrame([("a", 0)], "g string, tokens long")).collect()
    assert [r.weight for r in none] == [0.0]


def corpus(docs, sizes):
    rows, key = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((key, "w " * (key % 7 + 1), "en", source))
            key += 1
    return rows, docs(rows)


def test_cover_keeps_every_document_and_meets_the_weights(docs):
    rows, df = corpus(docs, {"a": 2000, "b": 300, None: 150})
    mixed, weights = mix(df, repetition=2.0)
    got = mixed.select("doc_id", "source", "pass").collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows}
    assert len({(r.doc_id, r["pass"]) for r in got}) == len(got)
    tokens = Counter()
    for r in got:
        tokens[r.source] += r.doc_id % 7 + 1
    own = {r.source: r for r in weights.collect()}
    assert sum(r.weight for r in own.values()) == pytest.approx(1)
    budget = max(r.tokens / r.weight for r in own.values())
    for source, r in own.items():
        assert budget * r.weight - 8 < tokens[source] <= budget * r.weight + 1e-6
    assert tokens["a"] == own["a"].tokens  # the largest source exactly once


def test_budget_below_and_above_the_corpus(docs):
    _, df = corpus(docs, {"a": 900, "b": 100})
    for budget in (500, 1234, 20_000):
        mixed, weights = mix(df, budget=budget, repetition=1.5, seed=3)
        tokens, passes = Counter(), Counter()
        for r in mixed.collect():
            tokens[r.source] += r.doc_id % 7 + 1
            passes[r.source, r.doc_id] += 1
        for r in weights.collect():
            assert budget * r.weight - 8 < tokens[r.source] <= budget * r.weight + 1e-6
            own = [n for (s, _), n in passes.items() if s == r.source]
            assert max(own) - min(own) <= 1  # passes are whole but for the last


def test_the_choice_depends_on_keys_only(docs):
    rows, df = corpus(docs, {"a": 500, "b": 60})
    first = sorted(map(tuple, mix(df)[0].select("doc_id", "pass").collect()))
    again = sorted(map(tuple, mix(docs(rows[::-1]).repartition(7))[0].select("doc_id", "pass").collect()))
    assert first == again


def test_given_counts_nulls_repeated_rows_and_clashing_columns(spark, docs):
    df = docs([(1, None, "en", "a"), (2, "", "en", "a"), (3, "x y", "en", "b"), (3, "x y", "en", "b"), (None, "z", "en", None), (7, "q " * 50_000, "en", "b")])
    df = df.withColumn("g", F.lit("g")).withColumn("t", F.lit(1)).withColumn("pass", F.lit("old"))
    mixed, _ = mix(df, blocks=4)
    assert mixed.columns == [c for c in df.columns if c != "pass"] + ["pass"]
    assert Counter(r.doc_id for r in mixed.where(F.col("pass") == 1).collect()) == Counter([1, 2, 3, 3, None, 7])
    assert mix(df, tokens=F.lit(-5))[0].count() == 6
    assert mix(df.limit(0))[0].count() == 0


def test_passes_are_different_permutations_of_the_same_blocks(docs):
    _, df = corpus(docs, {"a": 900, "b": 100, None: 60})
    mixed, weights = mix(df, budget=24_000, repetition=1.5, seed=3, blocks=8, position=("rank", "place"))
    got = mixed.collect()
    plain = mix(df, budget=24_000, repetition=1.5, seed=3, blocks=8)[0].select("doc_id", "pass").collect()
    assert sorted((r.doc_id, r["pass"]) for r in got) == sorted(map(tuple, plain))
    for w in weights.collect():
        own = [r for r in got if r.source == w.source]
        last = max(r["pass"] for r in own)
        assert last > 3
        orders = []
        for n in range(1, last + 1):
            blocks = {}
            for r in sorted((r for r in own if r["pass"] == n), key=lambda r: (r.rank, r.place)):
                blocks.setdefault(r.rank, []).append(r.doc_id)
            assert sorted(blocks) == list(range(1, len(blocks) + 1))  # the unfinished pass takes the first blocks
            orders.append([tuple(blocks[k]) for k in sorted(blocks)])
        assert all(set(o) == set(orders[0]) for o in orders[:-1])
        assert len({tuple(o) for o in orders[:-1]}) == last - 1
        *begun, cut = orders[-1]
        assert set(begun) <= set(orders[0]) and any(block[:len(cut)] == cut for block in orders[0])


def test_dealing_against_brute_force(spark, docs):
    """Every document's passes, block ranks and places, dealt again in Python from the sources' weights."""
    import math

    import xxhash

    from ledgerloom.llm import mixing as M

    def chain(*values):
        seed = 42
        for v in values:
            data = v.encode() if isinstance(v, str) else v.to_bytes(4 if isinstance(v, Small) else 8, "little", signed=True)
            seed = xxhash.xxh64_intdigest(data, seed)
        return seed - (1 << 64) if seed >= 1 << 63 else seed

    class Small(int):
        """A 32-bit number."""

    rng = random.Random(3)
    rows = [(i, " ".join("w" for _ in range(rng.choice([1, 3, 10, 40]))), "en", rng.choice(["a", "a", "a", "a", "b", "c", None])) for i in range(400)]
    mixed, weights = M.mix(docs(rows), position=("rank", "place"), repetition=1.6, blocks=8)
    got = sorted((r.doc_id, r["pass"], r["rank"], r.place) for r in mixed.collect())
    sources = {r.source: (r.tokens, r.weight) for r in weights.collect()}
    budget = max(t / w for t, w in sources.values() if w)
    want = []
    for source, (tokens, weight) in sources.items():
        g = "0" if source is None else "1" + source
        own = [(k, len(t.split())) for k, t, _, s in rows if s == source]
        block = {k: chain(Small(0), g, k) % 8 for k, _ in own}
        place = {k: chain(Small(0), "cut", k) for k, _ in own}
        assert sum(n for _, n in own) == tokens
        share = math.floor(budget * weight * (1 + 1e-12) + 1e-6)
        full, rest = divmod(share, tokens)

        def order(turn):
            return sorted(set(block.values()), key=lambda b: (chain(Small(0), Small(turn - 1), g, Small(b)), b))

        for turn in range(1, full + 2):
            line = order(turn)
            left = rest
            for rank, b in enumerate(line, 1):
                members = sorted((k for k, _ in own if block[k] == b), key=place.get)
                for k in members:
                    n = dict(own)[k]
                    if turn <= full or n <= left:
                        want.append((k, turn, rank, place[k]))
                        left -= n if turn > full else 0
                    elif turn > full:
                        left = 0
                        break
                if turn > full and left <= 0:
                    break
    assert got == sorted(want)
