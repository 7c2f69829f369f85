from __future__ import annotations

import random
import re

import numpy as np
import pytest

from ledgerloom.llm import ngram_jaccard as J


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + 3]) for i in range(len(words) - 2)} if len(words) >= 3 else {tuple(words)} if words else set()


def brute(rows, percent=90):
    sets = [(key, shingles(text)) for key, text in rows]
    parent = {key: key for key, _ in sets if key is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and a is not None and b is not None and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return sorted(((key, len(s), None if key is None else find(key)) for key, s in sets), key=str)


def near_copies(rng, base, n, edits):
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        yield " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(14):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.choice([3, 8, 20, 60, 150, 400]))]
        texts += near_copies(rng, base, rng.randint(1, 8), max(1, len(base) // 40))
    texts += ["", "one", "one two", "ONE  two", None, "a\tb\nc", "a b c", "x" * 3000]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(docs, seed):
    rows = corpus(seed)
    assert sorted(map(tuple, J.link_components(docs(rows)).collect()), key=str) == brute(rows)


def test_large_groups_are_searched_in_blocks(docs):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = list(enumerate(near_copies(rng, base, 60, 5)))
    expected = brute(rows)
    assert len({c for _, _, c in expected}) > 2  # some are too far from all others
    for group, block in ((10, 4), (10, 7)):
        assert sorted(map(tuple, J.link_components(docs(rows), group=group, block=block, wide=2 * block).collect()), key=str) == expected


def test_sets_of_unlike_sizes_do_not_meet(docs, spark, monkeypatch):
    rng = random.Random(4)
    words = [[f"w{i}" for i in rng.sample(range(3000), 900)] for _ in range(4)]
    rows = [(i, " ".join(words[i % 4][:n])) for i, n in enumerate([3, 9, 28, 29, 31, 95, 100, 104, 300, 330, 800, 880] * 4)]
    rows += [(500, rows[20][1]), (500, rows[45][1]), (None, rows[3][1])]  # one id with two sets
    met = []
    plain = J._search_groups
    monkeypatch.setattr(J, "_search_groups", lambda groups, *more: met.append(groups.count()) or plain(groups, *more))
    ids = [i for i, _ in rows if i is not None]
    one = spark.createDataFrame([(i, min(ids)) for i in ids], "node long, component long").distinct()
    whole = J.components
    monkeypatch.setattr(J, "components", lambda links, *a, **more: one if more.get("contracted") else whole(links, *a, **more))
    found = J.link_components(docs(rows), group=8, block=4, wide=4)
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)
    assert len(met) == 2 and met[1] < 50  # 66 rows if sets of all sizes met


def test_chains_and_borders_of_the_threshold(docs):
    # 19 shingles against 19 with 18 shared: 18 / 20 is exactly 0.9
    words = [f"w{i}" for i in range(21)]
    rows = [(4, " ".join(words)), (2, " ".join(words[:-1] + ["x"])), (9, " ".join(words[:-1] + ["x", "y"])), (1, " ".join(words[:-2]))]
    assert sorted(map(tuple, J.link_components(docs(rows)).collect()), key=str) == brute(rows)


def test_repeated_rows_and_ids(docs):
    rows = [(5, "a b c d"), (5, "a b c d"), (7, "a b c d"), (None, "a b c d"), (9, "q"), (9, "q")]
    got = sorted(map(tuple, J.link_components(docs(rows)).collect()), key=str)
    assert got == sorted([(5, 2, 5), (5, 2, 5), (7, 2, 5), (None, 2, None), (9, 1, 9), (9, 1, 9)], key=str)
    both = [(5, "a b c d"), (5, "q r s"), (3, "q r s"), (8, "A b c d")]  # rows of one id are connected
    assert {r.id: r.component_id for r in J.link_components(docs(both)).collect()} == {5: 3, 3: 3, 8: 3}


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "a b c", 1, 2), (2, "a b c", 3, 4)], "doc_id long, text string, id long, component long")
    assert sorted(map(tuple, J.link_components(df).collect())) == [(1, 1, 1), (2, 1, 1)]
    assert J.link_components(df.limit(0)).count() == 0


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    overlap = J.Overlap(percent)
    for _ in range(400):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        keep = a[rng.random(len(a)) > rng.random() * 0.12]
        b = np.unique(np.r_[keep, rng.integers(0, 1 << 63, int(rng.integers(0, 1 + n // 15)), dtype=np.uint64)])
        shared = len(np.intersect1d(a, b))
        if len(b) and 100 * shared >= percent * (len(a) + len(b) - shared):
            assert np.intersect1d(J.signatures(a, overlap), J.signatures(b, overlap)).size, (len(a), len(b), shared)


def groups_of(links):
    """Smallest node by node of any link."""
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("few", [1, 2, 8])
def test_leads_hold_all_links(docs, few):
    rng = random.Random(few)
    base = [f"w{i}" for i in range(90)]
    rows = [*corpus(7), *enumerate([*near_copies(rng, base, 40, 4), *near_copies(rng, base[:50], 5, 1)], 1000)]
    group = groups_of(map(tuple, J.block_leads(docs(rows).repartition(5), "doc_id", "text", 3, 90, few).collect()))
    for key, _, component in brute(rows):
        assert group.get(key, key) == group.get(component, component)


def test_shared_passages_lead_no_unlike_sets_together(docs):
    rng = random.Random(3)
    passages = [[f"p{k}x{i}" for i in range(20)] for k in range(8)]
    rows = []
    for i in range(96):  # every passage stands in many texts, each in a chain with the next
        own = [f"d{i}x{k}" for k in range(100)]
        rows.append((i, " ".join([*own[:50], *passages[i % 8], *own[50:], *passages[(i + 1) % 8]])))
    rows += [(1000 + i, text) for i, text in enumerate(near_copies(rng, rows[5][1].split(), 6, 3))]
    group = groups_of(map(tuple, J.block_leads(docs(rows).repartition(4), "doc_id", "text", 5, 80).collect()))
    assert {x for x in group if x < 1000} <= {5}
    assert {group[x] for x in group} == {5}


def test_near_copies_of_a_batch_are_led_once(docs, spark):
    rng = random.Random(6)
    rows = list(enumerate(near_copies(rng, [f"w{i}" for i in range(200)], 400, 6)))
    slots = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        leads = [tuple(r) for r in J.block_leads(docs(rows).repartition(4), "doc_id", "text", 5, 80).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", slots)
    assert set(groups_of(leads).values()) == {0} and len(leads) < 2 * len(rows)
