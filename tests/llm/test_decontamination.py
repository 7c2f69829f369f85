from __future__ import annotations

import hashlib
import random
import re

from ledgerloom.llm import decontamination as D
from ledgerloom.llm.common import staged

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text):
    return re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, width):
    out = []
    for key, text in docs:
        own, hit, found = words_of(text), set(), set()
        for item, phrase in items:
            term = words_of(phrase)
            size = min(width, len(term))
            for a in range(len(term) - size + 1 if size else 0):
                for i in range(len(own) - size + 1):
                    if own[i:i + size] == term[a:a + size]:
                        hit.update(range(i, i + size))
                        found.add("null" if item is None else str(item))
        out.append((key, len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def random_case(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "c1", "é", "Über", "the"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n"]) for _ in range(rng.randint(0, n)))
    docs = [(i, text(60)) for i in range(60)] + [(60, None), (61, ""), (62, "..."), (3, "the the the the the"), (None, "a b a b a b")]
    items = [(i, text(9)) for i in range(12)] + [(12, None), (13, ""), (2, "the the the the the"), (None, "a b a")]
    return docs, items


def test_against_brute_force(spark, docs):
    for seed in (1, 2):
        rows, items = random_case(seed)
        bench = spark.createDataFrame(items, "item_id long, text string")
        for block in (10, 1 << 20):  # many blocks of items, and one
            got = D.contamination(docs(rows), bench, width=4, segment_bytes=300, block_words=block)
            assert sorted(map(tuple, got.collect()), key=str) == brute(rows, items, 4)


def test_candidates_are_worked_off_in_parts(spark, docs, monkeypatch):
    monkeypatch.setattr(D, "CANDIDATES", 7)
    index = D.Postings(D._segment("x", [1], D.scan_words(*D.text_buffer(__import__("pyarrow").array(["a b " * 50])), D.VALUES)[1], __import__("numpy").array([100])))
    words = index.terms
    import numpy as np

    block = D.Windows([("i", np.array([words[0], words[1]])), ("j", np.array([words[1], words[0]]))], 2)
    block.rank(np.array([50, 50]))
    assert sum(len(p) for p, _, _ in D._find(index, block, 0)) == 99


def test_proximity(spark, docs):
    index = staged(D.build_index(docs([(1, "alpha x beta gamma"), (2, "beta y alpha gamma"), (3, "alpha beta gamma"), (4, "alpha beta")])), "t")
    items = spark.createDataFrame([("i", "alpha beta gamma")], "item_id string, text string")
    exact = {r.id for r in D.match(index, items).where("size(items) > 0").collect()}
    near = {r.id for r in D.match(index, items, slack=1).where("size(items) > 0").collect()}
    assert exact == {3} and near == {1, 3}


def test_empty_tables_long_texts_and_extra_columns(spark, docs):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven", "x")], "item_id long, text string, terms string")
    rows = [(1, "w " * 100_000 + "ONE two three four five six seven eight nine ten. eleven")]
    assert [(r.n_words, r.n_hit, r.contaminated) for r in D.contamination(docs(rows), bench).collect()] == [(100_011, 11, True)]
    assert [(r.n_hit, r.contaminated) for r in D.contamination(docs(rows), bench.limit(0)).collect()] == [(0, False)]
    assert D.contamination(docs(rows).limit(0), bench).count() == 0
