from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import url_filter as U


def parts(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c.group().lower(), m.group(1)), m.group(2)) if m else ("", "")


def rule_of(host, path, rules):
    best = None
    for kind, site, start in rules:
        if (host == site or host.endswith("." + site)) and path.startswith(start):
            if best is None or len(site + start) > len(best[1] + best[2]):
                best = (kind, site, start)
    return (best[1] + best[2], best[0]) if best else (None, None)


URLS = ["http://www.example.com/en/1", "https://Example.COM/en/x?q=/fr/", "http://m.www.example.com/en/", "http://a.example.com/de/", "com://com/",
        "http://notexample.com/en/", "http://x.net/es/", "http://net/fr/a#b", "http://x.net/en/", "ftp://org", "no scheme", "", None,
        "http://", "http:///path", "http://x.com", "http://x.com?y/", "http://É.com/é", "x\ny://Z.net/fr/\nq", "a://b://c.com/"]


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    for r in U.filter_urls(df).collect():
        host, path = parts(URLS[r.id])
        name, kind = rule_of(host, path, U.RULES)
        assert (r.host, r.path, r.rule) == (host, path, name), URLS[r.id]
        assert r.verdict == kind if kind else r.verdict in ("allow", "block")


def test_the_models_tell_classes_apart(spark):
    good = [f"https://garden-news.org/{w}-story/{i}" for i in range(60) for w in ("tulip", "rose", "lily")]
    bad = [f"http://cheap-pills{i}.biz/buy?id={i * 7}" for i in range(180)]
    rules = (("allow", "garden-news.org", "/"), ) + tuple(("block", f"cheap-pills{i}.biz", "/") for i in range(100))
    asked = ["https://other-news.org/tulip-story/77", "http://cheap-pills500.biz/buy?id=3"]
    rows = list(enumerate([*good, *bad, *asked]))
    got = {r.id: r for r in U.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), rules=rules).collect()}
    n = len(good) + len(bad)
    assert (got[n].verdict, got[n + 1].verdict) == ("allow", "block")
    ruled = [got[i] for i in range(len(good) + 100, n)]  # blocked hosts beyond the rules
    assert sum(r.verdict == "block" for r in ruled) >= 0.95 * len(ruled)


@pytest.mark.parametrize("urls, verdict", [(["http://a.com/", "http://b.org/"], "allow"), (["http://a.net/fr/", "http://b.org/"], "block"),
                                           (["http://b.org/"], "allow")])
def test_one_class_or_none(spark, urls, verdict):
    rows = [(i, u) for i, u in enumerate(urls * 20)]
    got = U.filter_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert {r.verdict for r in got if r.rule is None} == {verdict}


def test_repeated_rows_long_urls_extra_columns_and_empty_table(spark):
    rows = [(1, "http://q.org/" + "a" * 100_000, "x", 1), (1, "http://q.org/" + "a" * 100_000, "x", 1), (None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, score long")
    got = U.filter_urls(df).collect()
    assert len(got) == 3 and len({(r.verdict, r.score) for r in got if r.id == 1}) == 1
    assert U.filter_urls(df.limit(0)).count() == 0


def test_scores_are_those_of_real_contexts(spark):
    rng = random.Random(5)
    hosts = ["a.com", "b.net"]
    urls = [f"http://{hosts[i % 2]}/{'fr/' if i % 2 else ''}" + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=60)) for i in range(5000)]
    urls += ["http://c.org/" + urls[i][20:50] for i in range(50)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    fold = dict(map(tuple, df.select("page_id", F.pmod(F.xxhash64("url"), F.lit(U.FOLDS))).collect()))
    joint, context = (Counter(), Counter()), (Counter(), Counter())

    def grams(url):
        text = [0] * U.ORDER + [c + 1 for c in url.encode()] + [257]
        for i in range(U.ORDER, len(text)):
            yield [tuple(text[i - k:i]) for k in range(U.ORDER + 1)], text[i]

    for i, u in enumerate(urls[:5000]):
        if fold[i]:
            for contexts, c in grams(u):
                for x in contexts:
                    joint[1 - i % 2][x, c] += 1
                    context[1 - i % 2][x] += 1
    assert len(context[0]) + len(context[1]) > 400_000
    got = {r.id: r.score for r in U.filter_urls(df).collect()}
    for i in [*range(0, 5000, 100), *range(5000, 5050)]:
        total, n = 0.0, 0
        for contexts, c in grams(urls[i]):
            p = [1 / 257, 1 / 257]
            for x in contexts:
                p = [(joint[k][x, c] + U.STRENGTH * p[k]) / (context[k][x] + U.STRENGTH) for k in (0, 1)]
            total, n = total + math.log(p[1] / p[0]), n + 1
        assert got[i] == pytest.approx(total / n, abs=2e-6)
