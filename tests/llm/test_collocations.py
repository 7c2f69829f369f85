from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import collocations as C
from ledgerloom.llm.collocations import collocations, dictionary


def pieces(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", lower)]


def brute(rows, least, best=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    found = []
    for (lang, w), a in f.items():
        if len(w) < 2 or a < least:
            continue
        longer = [x for (o, x), c in f.items() if o == lang and len(x) > len(w) and c >= least and c >= a]
        if any(x[i:i + len(w)] == w for x in longer for i in range(len(x) - len(w) + 1)):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        found.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    out = []
    for lang in n:
        own = sorted((x for x in found if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        out += [(lang, i, *x[1:]) for i, x in enumerate(own[:best], 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def result(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, monkeypatch):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(9)] + ["É", "é", "A", "a", " x", "ŷ"]
    rows = []
    for _ in range(60):
        passage = " ".join(rng.choice(words) + rng.choice(["", "", "", ".", ", ", "\n", "\t"]) for _ in range(rng.choice([0, 1, 5, 30, 90])))
        rows += [(rng.choice(["en", "de", None]), passage)] * rng.choice([1, 1, 3])
    for least, best in ((3, 2000), (12, 5)):
        assert result(collocations(table(spark, rows), least=least, best=best)) == brute(rows, least, best)


def test_any_cuts_give_the_same_counts():
    """The parse covers every phrase exactly once, whatever triggers and forced cuts."""
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abc") for _ in range(n)) for n in (0, 1, 4, 5, 6, 300)] + ["x " * 500, "a b. c  d\te", "  ", "."]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    wanted = Counter(tuple(w[i:i + k]) for t in texts for w in pieces(t) for k in range(1, 6) for i in range(len(w) - k + 1))
    for trigger, longest in ((32, 1024), (1, 1024), (2, 7), (10 ** 9, 1), (10 ** 9, 10 ** 6)):
        C.TRIGGER, C.LONGEST, old = trigger, longest, (C.TRIGGER, C.LONGEST)
        try:
            chunks, sizes, row = C._chunks_of(data, offsets)
        finally:
            C.TRIGGER, C.LONGEST = old
        found = Counter()
        for chunk, size in zip(chunks.to_pylist(), sizes):
            w = chunk.split(" ")
            found.update(tuple(w[i:i + k]) for k in range(1, 6) for i in range(min(size, len(w) - k + 1)))
        assert found == wanted
        assert all(pieces(chunk) == [chunk.split(" ")] for chunk in chunks.to_pylist())
        assert [texts[r] for r in row] == sorted((texts[r] for r in row), key=texts.index)


def test_copies_share_chunks(spark):
    rng = random.Random(5)
    passage = " ".join(f"w{rng.randrange(500)}" for _ in range(3000))
    rows = [("en", f"start{i} {passage} end{i}") for i in range(30)]
    found = dictionary(table(spark, rows)).collect()
    shared = [r for r in found if r.times == 30]
    assert sum(r.starts for r in shared) > 2800 and len(found) < len(shared) + 2 * 30 + 5


def test_products_beyond_64_bits(spark):
    rows = spark.createDataFrame([("en", "a", 4 * 10 ** 12, 1), ("en", "b", 5 * 10 ** 12, 2)], "lang string, phrase string, f long, h long")
    pairs = spark.createDataFrame([("en", "a b", 3 * 10 ** 12 + 1, 3)], "lang string, phrase string, f long, h long")
    sizes = spark.createDataFrame([("en", 10 ** 14)], "lang string, n long")
    a, n = 3 * 10 ** 12 + 1, 10 ** 14
    assert C._scored([rows, pairs], sizes).first().score == 1000 * a * n // (4 * 10 ** 12 * 5 * 10 ** 12)


def test_nulls_empty_tables_long_texts_and_other_columns(spark):
    assert result(collocations(table(spark, [(None, None), ("en", ""), ("de", " . ")]))) == []
    assert result(collocations(table(spark, [("en", "a b")]).limit(0))) == []
    rows = [(None, "x y " * 60000), ("en", "q" * 300000 + " q" * 120)]
    assert result(collocations(table(spark, rows))) == brute(rows, 100)
    df = spark.createDataFrame([("en", "a b " * 50, 1, "z", 3)] * 4, "lang string, text string, f long, phrase string, chunk long")
    assert result(collocations(df)) == brute([("en", "a b " * 50)] * 4, 100)


def test_other_column_names(spark):
    df = spark.createDataFrame([("en", "de", "a b")] * 3, "text string, `my.lang` string, body string")
    assert [r.lang for r in collocations(df, "body", "my.lang", least=3).collect()] == ["de"]
