from __future__ import annotations

import math
import random
import re
from collections import Counter

from ledgerloom.llm import bm25


def brute(rows, queries, k):
    words = [(key, re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())) for key, text in rows]
    n, mean = len(words), sum(len(w) for _, w in words) / len(words)
    df = Counter(t for _, w in words for t in set(w))
    idf = {t: math.log(1 + (n - f + 0.5) / (f + 0.5)) for t, f in df.items()}
    out = {}
    for key, text in queries:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
        scores = []
        for i, w in words:
            count = Counter(w)
            total = sum(math.floor(1e6 * (idf[t] * (count[t] * 2.2 / (count[t] + 1.2 * (0.25 + 0.75 * len(w) / mean)))) + 0.5)
                        for t in set(own) if count[t])
            if total:
                scores.append((-total, i))
        out[key] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query, r.rank)):
        out.setdefault(r.query, []).append((r.id, r.score))
    return out


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 40)))) for i in range(n)]


def test_against_brute_force(docs, monkeypatch):
    rows = corpus(300, 1) + [(300, None), (301, ""), (302, "w1 " * 500)]
    monkeypatch.setattr(bm25, "SHARD_BYTES", 2000)
    monkeypatch.setattr(bm25, "BLOCK", 4)
    asked = [r for r in rows if r[0] % 10 == 0]
    for queries, shards in ((500, 4), (7, 1)):
        monkeypatch.setattr(bm25, "QUERIES", queries)
        monkeypatch.setattr(bm25, "SHARDS", shards)
        got = found(bm25.top_k(docs(rows).repartition(5), docs(asked), k=5))
        assert got == {q: hits for q, hits in brute(rows, asked, 5).items() if hits}


def test_pruning_is_exact_over_many_blocks(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(2)
    terms, p = np.arange(1, 9, dtype=np.uint64), [.4, .3, .1, .1, .05, .03, .01, .01]
    weights = np.array([0.1, 0.2, 1.0, 1.1, 2.0, 2.5, 4.0, 4.2])
    for block in (1, 8, 64, 10_000):
        monkeypatch.setattr(bm25, "BLOCK", block)
        best, full = [], Counter()
        for shard in range(3):
            lengths = rng.integers(1, 30, 2000)
            built = bm25.build_shard(np.arange(2000) * 3 + shard, rng.choice(terms, lengths.sum(), p=p), lengths)
            lists = bm25.Lists(built, terms, weights, 15.0)
            for d, x in zip(built["ids"][lists.docs].tolist(), lists.parts.tolist()):
                full[d] += x
            best = bm25.search(lists, np.arange(8), best, 10)
        assert best == sorted((-s, d) for d, s in full.items())[:10]


def test_few_blocks_are_scored():
    """A rare heavy term: documents in blocks without it are not looked at."""
    import numpy as np

    lengths = np.full(20_000, 10)
    hashes = np.ones(200_000, np.uint64)
    hashes[:4000:100] = 2
    lists = bm25.Lists(bm25.build_shard(np.arange(20_000), hashes, lengths), np.array([1, 2], np.uint64), np.array([0.001, 9.0]), 10.0)
    best = bm25.search(lists, np.arange(2), [], 10)
    assert [d for _, d in best] == list(range(0, 100, 10))
    seen, ranges = [], bm25._ranges
    try:
        bm25._ranges = lambda a, b: seen.append((b - a).sum()) or ranges(a, b)
        bm25.search(lists, np.arange(2), best, 10)
    finally:
        bm25._ranges = ranges
    assert seen[-1] < 2000  # postings of the blocks that were scored, of 20,040


def test_ties_repeated_rows_and_extra_columns(spark):
    rows = [(5, "a b", 1), (3, "a b", 2), (9, "a b", 3), (3, "a b", 4), (None, "a b", 5), (1, "c", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score long")
    got = found(bm25.top_k(df, df.where("doc_id = 5"), k=10))
    assert [i for i, _ in got[5]] == [3, 3, 5, 9, None]
    assert bm25.top_k(df.limit(0), df.limit(0)).count() == 0


def test_queries_of_one_id_are_one(docs):
    rows = [(1, "a b"), (2, "b c"), (3, "q")]
    got = found(bm25.top_k(docs(rows), docs([(7, "a"), (7, "c a"), (None, "q")]), k=5))
    assert set(got) == {7} and {i for i, _ in got[7]} == {1, 2}
    assert got == brute(rows, [(7, "a c")], 5)


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", "x", 2, "y")], "doc_id long, text string, path string, query long, term string")
    assert [r.id for r in bm25.top_k(df, df).collect()] == [1]


def test_all_terms_of_a_text_count(docs):
    asked = [(1, " ".join(f"rare{i}" for i in range(20)) + " plain")]
    # `plain` is in most documents, so it is the lightest of the 21 terms
    rows = asked + [(2, "plain alone")] + [(i, f"plain w{i}") for i in range(3, 30)]
    got = found(bm25.top_k(docs(rows), docs(asked), k=40))
    assert got == brute(rows, asked, 40) and len(got[1]) == len(rows)


def full_sums(shards, terms, weights, mean, own):
    import numpy as np

    out = [Counter() for _ in own]
    for shard in shards:
        first = np.r_[0, np.cumsum(shard["frequency"])]
        where = {t: i for i, t in enumerate(shard["terms"].tolist())}
        for total, asked in zip(out, own):
            for t in asked.tolist():
                i = where.get(int(terms[t]))
                for p in range(first[i], first[i + 1]) if i is not None else ():
                    d, count = shard["docs"][p], int(shard["counts"][p])
                    total[int(shard["ids"][d])] += math.floor(1e6 * (weights[t] * (count * 2.2 / (count + 1.2 * (0.25 + 0.75 * shard["lengths"][d] / mean)))) + 0.5)
    return out


def zipf_shards(rng, docs, words, sizes):
    """Shards of documents of common and rare words, some of them copies of others with a word changed."""
    import numpy as np

    p = 1 / np.arange(1, words + 1)
    shards, ids = [], 0
    for size in sizes:
        texts = [rng.choice(np.arange(1, words + 1, dtype=np.uint64), rng.integers(0, docs), p=p / p.sum()) for _ in range(size)]
        for i in range(0, size - 1, 7):
            texts[i + 1] = texts[i].copy()
            texts[i + 1][:1] = words
        lengths = np.array([len(t) for t in texts])
        shards.append(bm25.build_shard(np.arange(ids, ids + size), np.concatenate(texts), lengths))
        ids += size
    return shards


def test_queries_together_are_exact(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(5)
    shards = zipf_shards(rng, 60, 400, (300, 1, 90, 200))
    terms = np.arange(1, 403, dtype=np.uint64)
    weights = rng.uniform(0.001, 17, len(terms))  # parts beyond the whole numbers of single precision
    own = [np.sort(rng.choice(len(terms), n, replace=False)) for n in (0, 1, 3, 9, 10, 60, 60, 200, 402)]
    sums = full_sums(shards, terms, weights, 20.0, own)
    for block, dense, most, together, cells in ((64, 0.005, 4096, 512, 1 << 23), (1, 0, 4096, 3, 1 << 23), (7, 0.05, 3, 2, 1 << 23), (1000, 1, 9, 512, 600)):
        for name, value in (("BLOCK", block), ("DENSE", dense), ("HEAVY", most), ("TOGETHER", together), ("CELLS", cells)):
            monkeypatch.setattr(bm25, name, value)
        for k in (1, 10, 1000):
            for parts in (([0, 1], [2, 3]), ([0], [1], [2], [3]), ([0, 1, 2, 3],)):
                best = [[] for _ in own]
                for part in parts:
                    lists = bm25.Lists([shards[i] for i in part], terms, weights, 20.0)
                    best = bm25.search_all(lists, [lists.number[o[lists.known[o]]] for o in own], best, k)
                assert best == [sorted((-s, d) for d, s in total.items() if s)[:k] for total in sums]


def test_shards_put_together_are_one():
    import numpy as np

    shards = zipf_shards(np.random.default_rng(6), 30, 100, (40, 25))
    terms, weights = np.array([1, 2, 50, 99, 1000], np.uint64), np.array([0.2, 0.4, 3.0, 4.0, 9.0])
    apart, both = [bm25.Lists(s, terms, weights, 15.0) for s in shards], bm25.Lists(shards, terms, weights, 15.0)
    assert both.known.tolist() == (apart[0].known | apart[1].known).tolist() and both.ids.tolist() == list(range(65))
    for t in np.flatnonzero(both.known).tolist():
        want = []
        for x, offset in zip(apart, (0, 40)):
            if x.known[t]:
                a, b = x.at[x.number[t]], x.at[x.number[t] + 1]
                want += list(zip((x.docs[a:b] + offset).tolist(), x.parts[a:b].tolist()))
        a, b = both.at[both.number[t]], both.at[both.number[t] + 1]
        assert list(zip(both.docs[a:b].tolist(), both.parts[a:b].tolist())) == want


def test_common_lists_are_not_read_query_by_query(monkeypatch):
    """The work of long queries: few of their pairs of a query and a posting are summed one query at a time."""
    import numpy as np

    rng = np.random.default_rng(7)
    shards = zipf_shards(rng, 300, 3000, (1500,))
    terms, weights = np.arange(1, 3001, dtype=np.uint64), np.log(1 + np.arange(1, 3001) / 3)
    lists = bm25.Lists(shards, terms, weights, 150.0)
    p = 1 / np.arange(1, 3001)
    own = [np.unique(rng.choice(3000, 400, p=p / p.sum())) for _ in range(200)]
    own = [lists.number[o[lists.known[o]]] for o in own]
    seen, light = [], bm25._light_sums
    monkeypatch.setattr(bm25, "_light_sums", lambda x, term, *rest: seen.append(x.sizes[term].sum()) or light(x, term, *rest))
    best = bm25.search_all(lists, own, [[] for _ in own], 10)
    assert sum(seen) < sum(lists.sizes[o].sum() for o in own) / 10
    assert best[:5] == [bm25.search(lists, o, [], 10) for o in own[:5]]


def test_blocks_that_reach_no_limit_stay_out_of_the_product(monkeypatch):
    import numpy as np

    half = [np.tile(np.arange(a, a + 20, dtype=np.uint64), 640) for a in (1, 101)]
    shard = bm25.build_shard(np.arange(1280), np.concatenate(half), np.full(1280, 20))
    terms = np.r_[1:21, 101:121].astype(np.uint64)
    lists = bm25.Lists(shard, terms, np.ones(40), 20.0)
    own, taken, where = [np.arange(20)] * 4, [], np.repeat
    monkeypatch.setattr(np, "repeat", lambda a, n, *rest: taken.append(a) or where(a, n, *rest))
    best = bm25.search_all(lists, own, [[] for _ in own], 10)
    assert [[d for _, d in b] for b in best] == [list(range(10))] * 4
    wanted = next(a for a in taken if getattr(a, "dtype", None) == bool)
    assert wanted.tolist() == [True] * 10 + [False] * 10  # blocks of 64


def test_likeness_puts_common_terms_side_by_side():
    import numpy as np

    rng = np.random.default_rng(8)
    kinds = [i % 2 for i in range(60)]
    own = [rng.choice(100, 20, replace=False) + 100 * kind for kind in kinds] + [np.zeros(0, np.int64)]
    order = bm25.likeness(np.array([len(o) for o in own]), np.concatenate(own))
    assert sorted(order.tolist()) == list(range(61))
    found = [kinds[i] for i in order.tolist() if i < 60]
    assert sum(a != b for a, b in zip(found, found[1:])) < 20
    assert bm25.likeness(np.array([3]), np.array([0, 1, 2])).tolist() == [0]


def test_many_copies_and_long_queries(docs):
    words = " ".join(f"t{i}" for i in range(30))
    rows = [(i, words) for i in range(200, 0, -1)] + [(900 + i, f"{words} x{i}") for i in range(50)] + [(None, words)]
    got = found(bm25.top_k(docs(rows).repartition(3), docs([(1, words), (2, "t1 x7")]), k=12))
    assert [i for i, _ in got[1]] == list(range(1, 13)) and got[2][0][0] == 907
    assert got[2] == brute([(1 << 60 if i is None else i, t) for i, t in rows], [(2, "t1 x7")], 12)[2]


def test_stable_order_of_hashes():
    import numpy as np

    rng = np.random.default_rng(9)
    for hashes in (rng.integers(0, 1 << 63, 2000, dtype=np.uint64)[rng.integers(0, 2000, 5000)], rng.integers(0, 9, 500, dtype=np.uint64),
                   np.array([1 << 63, 7, (1 << 64) - 1, 7, 3, 0], np.uint64), np.zeros(0, np.uint64)):
        assert bm25._stable_order(hashes).tolist() == np.argsort(hashes, kind="stable").tolist()
