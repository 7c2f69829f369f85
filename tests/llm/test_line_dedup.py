from __future__ import annotations

import random

from ledgerloom.llm.line_dedup import LEAST_WORDS, dedup_lines


def distance_at_most_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = (a, b) if len(a) > len(b) else (b, a)
    return any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(rows):
    """Kept lines of each document: a line goes if an earlier one equals it or is within the bound."""
    seen, out = [], {}
    for key, text in sorted((r for r in rows if r[1] is not None), key=lambda r: r[0]):
        kept = []
        for line in text.split("\n"):
            words = line.split(" ")
            near = any(line == o or (min(len(words), len(w)) >= LEAST_WORDS and distance_at_most_one(words, w)) for o, w in seen)
            if line.strip(" ") == "" or not near:
                kept.append(line)
            if line.strip(" ") != "":
                seen.append((line, words))
        out[key] = "\n".join(kept)
    return out


def result(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_against_brute_force(docs):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(12)]
    lines = [[rng.choice(words) for _ in range(rng.choice([1, 3, 7, 8, 9, 9, 10, 20]))] for _ in range(25)]
    rows = []
    for key in range(40):
        own = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(lines))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                place, kind = rng.randrange(len(line)), rng.choice("idr")
                if kind == "i":
                    line.insert(place, rng.choice(words))
                elif kind == "d" and len(line) > 1:
                    del line[place]
                else:
                    line[place] = rng.choice(words)
            own.append(" ".join(line))
        rows.append((key, "\n".join(own)))
    assert result(dedup_lines(docs(rows))) == brute(rows)


def test_nulls_empty_blank_and_long(docs):
    long = " ".join(str(i) for i in range(3000))
    rows = [(1, None), (2, ""), (3, "a\n\n  \na"), (4, long), (5, long + " x\nb"), (6, "é è\nÉ è")]
    found = dedup_lines(docs(rows)).collect()
    assert {r.doc_id: r.text for r in found} == {1: None, 2: "", 3: "a\n\n  ", 4: long, 5: "b", 6: "é è\nÉ è"}
    assert {r.doc_id: (r.n_lines, r.n_kept) for r in found}[3] == (4, 3)
    assert {r.doc_id: (r.n_lines, r.n_kept) for r in found}[1] == (0, 0)


def test_repeated_rows_and_null_ids(docs):
    rows = [(2, "same line\nother"), (2, "same line\nother"), (None, "same line"), (3, "other")]
    found = sorted(dedup_lines(docs(rows)).collect(), key=lambda r: (r.doc_id or 0, r.text))
    assert [(r.doc_id, r.text) for r in found] == [(None, "same line"), (2, "other"), (2, "other"), (3, "")]


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "x\nx", 7, "q")], "doc_id long, text string, n_kept long, h1 string")
    row = dedup_lines(df).first()
    assert (row.text, row.n_kept, row.h1) == ("x", 1, "q")
    assert dedup_lines(df.limit(0)).count() == 0


def test_many_lines_share_a_variant(docs):
    rows = [(i, f"one two three four five six seven {i} nine") for i in range(300)]
    kept = result(dedup_lines(docs(rows)))
    assert kept[0] and not any(kept[i] for i in range(1, 300))
