from __future__ import annotations

import random

import numpy as np
import pytest

from ledgerloom.llm import components as C


def brute(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def result(spark, links, parts=5):
    found = C.components(spark.createDataFrame(links, "a long, b long").repartition(parts)).collect()
    assert len(found) == len({r.node for r in found})
    return {r.node: r.component for r in found}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs(spark, seed, monkeypatch):
    monkeypatch.setattr(C, "LINKS", 3)
    rng = random.Random(seed)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(None, 3), (4, None), (5, 5)] + [(7, 8)] * 5
    assert result(spark, links) == brute(links)


def test_long_chain_hub_and_nothing(spark):
    rng = random.Random(3)
    names = rng.sample(range(10_000), 600)
    chain = list(zip(names, names[1:]))
    assert result(spark, chain) == brute(chain)
    hub = [(i, 0) for i in range(1, 3000)] + [(5000, i) for i in range(2000, 2500)]
    assert result(spark, hub) == brute(hub)
    assert result(spark, [(1, 1), (None, None)]) == {}


def test_stars_in_memory():
    rng = np.random.default_rng(4)
    for n in (0, 1, 5, 400):
        a, b = rng.integers(-200, 200, n), rng.integers(-200, 200, n)
        u, v = C.stars(a, b)
        want = brute([(int(x), int(y)) for x, y in zip(a, b)])
        assert dict(zip(u.tolist(), v.tolist())) == {k: r for k, r in want.items() if k != r}
