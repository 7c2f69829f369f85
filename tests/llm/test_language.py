from __future__ import annotations

import random

from pyspark.sql import functions as F

from ledgerloom.llm.language import identify

SYLLABLES = {"de": "schung keit der ein auf ver gen", "en": "the ing tion and wh ould ness", "es": "cion que los ado mente ez ar",
             "fr": "eau ment les oux que ait aire"}


def sentence(rng, language, n):
    return " ".join("".join(rng.choices(SYLLABLES[language].split(), k=rng.randint(1, 3))) for _ in range(n))


def corpus(seed, n, known=True):
    rng = random.Random(seed)
    return [(i, sentence(rng, x := rng.choice("de en es fr".split()), 12), x if known else None, f"s{i % 3}", x) for i in range(n)]


def build(spark, rows):
    return spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, source string")


def test_held_out_texts_without_a_declared_language(spark):
    train, held = corpus(1, 300), [(1000 + r[0], *r[1:]) for r in corpus(2, 200, known=False)]
    got = {r.doc_id: r for r in identify(build(spark, train + held)).collect()}
    right = sum(got[r[0]].language == r[4] for r in held)
    assert right >= 0.95 * len(held)
    assert all(got[r[0]].accepted for r in train)


def test_a_wrong_declared_language_yields_to_long_text(spark):
    rows = corpus(1, 300) + [(999, sentence(random.Random(5), "de", 200), "fr", "s0", "de")]
    got = {r.doc_id: r for r in identify(build(spark, rows)).collect()}
    assert (got[999].declared, got[999].language) == ("fr", "de")


def test_host_prior_and_suffix_decide_without_other_evidence(spark):
    rng = random.Random(4)
    rows = [(i, sentence(rng, "en", 20), "en", "a.example.com") for i in range(100)]
    rows += [(100 + i, sentence(rng, "fr", 20), "fr", "b.example.org") for i in range(100)]
    rows += [(900, "zz", None, "b.example.org"), (901, "zz", None, "a.example.com")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.language for r in identify(df, suffix=F.substring_index("source", ".", -1)).collect()}
    assert got[900] == "fr" and got[901] == "en"


def test_texts_without_letters_are_rejected(spark):
    rows = corpus(1, 50) + [(90, None, "en", "s0", ""), (91, "", "en", None, ""), (92, "12 34 ...", "en", "s0", ""),
                            (93, sentence(random.Random(1), "en", 30_000), "en", "s0", "")]
    got = {r.doc_id: r for r in identify(build(spark, rows)).collect()}
    for key in (90, 91, 92):
        assert not got[key].accepted and got[key].language is None
    assert got[93].accepted


def test_unknown_values_repeated_rows_and_empty_table(spark):
    rows = corpus(1, 60) + [(70, "the ing and", "xx", None, ""), (70, "the ing and", "xx", None, ""), (None, "the and", "EN-us", "", "")]
    got = identify(build(spark, rows)).collect()
    assert len(got) == 63
    assert {r.declared for r in got if r.doc_id == 70} == {"other"}
    assert [r.declared for r in got if r.doc_id is None] == ["en"]
    assert identify(build(spark, rows).limit(0)).count() == 0


def test_clashing_columns(spark):
    df = build(spark, corpus(1, 30)).withColumn("s", F.lit(1)).withColumn("host", F.lit("x")).withColumn("p", F.lit(2))
    assert identify(df).count() == 30


def brute(rows, suffixes=None):
    """rows of (id, text, lang, host): (language, confidence) of each, by the formulas, in dictionaries."""
    import math
    from collections import Counter, defaultdict

    from ledgerloom.llm import language as L

    languages, classes = list(L.LANGUAGES), [*L.LANGUAGES, L.NONE]

    def kind(b):
        return b - 0x60 if 0x61 <= b <= 0x7A else b - 0x40 if 0x41 <= b <= 0x5A else 27 + b - 0x80 if b >= 0x80 else 0

    def letters(text):
        return [0, *map(kind, (text or "").encode()), 0]

    def said_of(lang):
        x = (lang or "").split("-")[0].lower()
        return x if x in languages else "other" if x else "none"

    def land_of(i):
        return "none" if suffixes is None else L.SUFFIX_LANGUAGE.get(suffixes[i], "generic")

    grams, single = {x: Counter() for x in languages}, Counter()
    for _, text, lang, _ in rows:
        if said_of(lang) in languages:
            own = letters(text)
            single.update(own)
            grams[said_of(lang)].update(g for g in zip(own, own[1:], own[2:]) if any(g))
    seen = set().union(*grams.values())
    lone = {c: math.log((single[c] + L.SMOOTH) / (sum(single.values()) + L.SMOOTH * L.LETTERS)) for c in range(L.LETTERS)}
    start = {x: L.PRIOR_NONE if x == L.NONE else (1 - L.PRIOR_NONE) / len(languages) for x in classes}
    texts, soft = [], []
    for _, text, _, _ in rows:
        own = [g for g in zip(letters(text), letters(text)[1:], letters(text)[2:]) if any(g)]
        t = {x: sum(math.log((grams[x][g] + L.SMOOTH) / (grams[x].total() + L.SMOOTH * (len(seen) + 1))) for g in own) / 3 for x in languages}
        t[L.NONE] = sum(lone[c] for g in own for c in g) / 3
        texts.append((len(own), t))
        top = max(t[x] + math.log(start[x]) for x in classes)
        e = {x: math.exp(t[x] + math.log(start[x]) - top) for x in classes}
        soft.append({x: e[x] / sum(e.values()) for x in classes} if own else None)

    def likelihood(values, of):
        n = defaultdict(float)
        for i, p in enumerate(soft):
            for x in classes if p else ():
                n[of(i), x] += p[x]
        known = [v for v in values if v != "none"]
        return {(v, x): 0.0 if v == "none" else math.log((n[v, x] + 1) / (sum(n[w, x] for w in known) + len(known))) for v in values for x in classes}

    by_said = likelihood([*languages, "other", "none"], lambda i: said_of(rows[i][2]))
    by_land = likelihood([*sorted(set(L.SUFFIX_LANGUAGE.values())), "generic", "none"], land_of)

    def level(key, parent):
        n, out = defaultdict(lambda: [0, Counter()]), {}
        for (_, _, _, host), p in zip(rows, soft):
            if p and host is not None:
                n[key(host)][0] += 1
                for x in classes:
                    n[key(host)][1][x] += p[x]
        for k, (total, sums) in n.items():
            out[k] = {x: (sums[x] + L.HOST_WEIGHT * parent(k)[x]) / (total + L.HOST_WEIGHT) for x in classes}
        return out

    whole = level(lambda h: "", lambda k: start)

    def suffix(h):
        return h.split(".")[-1] if "." in h else ""

    by_suffix = level(suffix, lambda k: whole[""])
    by_domain = level(lambda h: ".".join(h.split(".")[-2:]), lambda k: by_suffix[suffix(k)])
    by_host = level(lambda h: h, lambda k: by_domain[".".join(k.split(".")[-2:])])
    out = []
    for i, ((_, _, lang, host), (n, t)) in enumerate(zip(rows, texts)):
        prior = by_host.get(host, start)
        s = {x: t[x] + math.log(prior[x]) + by_said[said_of(lang), x] + by_land[land_of(i), x] for x in classes}
        best = max(classes, key=lambda x: s[x])
        p = 1 / sum(math.exp(v - s[best]) for v in s.values())
        out.append((None if not n or best == L.NONE else best, p if n else None))
    return out


def test_against_brute_force(spark):
    rng = random.Random(12)
    rows = []
    for i in range(150):
        language = rng.choice("de en es fr".split())
        text = rng.choice([sentence(rng, language, rng.choice([1, 2, 5, 20])), sentence(rng, language, 3) + " çãé ß", "qzx" * rng.randint(1, 4), "12", None])
        host = rng.choice([None, "plain", "a.example.com", "b.example.com", "c.other.fr", "x.y.z.es", "de"])
        rows.append((i, text, rng.choice([language, language, "EN-gb", "xx", "", None]), host))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    suffixes = [None if h is None else h.split(".")[-1] for *_, h in rows]
    for own, want in ((None, brute(rows)), (F.substring_index("source", ".", -1), brute(rows, suffixes))):
        got = {r.doc_id: r for r in identify(df, suffix=own).collect()}
        for (key, *_), (language, p) in zip(rows, want):
            assert (got[key].confidence is None) == (p is None)
            if p is not None:
                assert abs(got[key].confidence - p) < 2e-3, (key, got[key], language, p)
                assert got[key].language == language or p < 0.51, (key, got[key], language, p)
