from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators.grouping import (
    collect_chunks, correlations, describe, exact_quantiles, first_per_key, group_sum, latest_one, latest_version, subtotals, top_k,
    with_group_value, without_outliers,
)
from tests.conftest import rows

QS = {"q10": 0.1, "q50": 0.5, "q90": 0.9, "q0": 0.0, "q100": 1.0}


def check_quantiles(df, keys, data, accuracy):
    out = {tuple(r[k] for k in keys): r for r in exact_quantiles(df, keys, "v", QS, accuracy).collect()}
    assert set(out) == set(data)
    for key, values in data.items():
        assert out[key]["n"] == len(values)
        for name, q in QS.items():
            assert out[key][name] == pytest.approx(np.quantile(values, q), rel=1e-12, abs=1e-12), (key, name)


@pytest.mark.parametrize("accuracy", [20, 100, 100_000])
def test_exact_quantiles_match_numpy(make, accuracy):
    rng = np.random.default_rng(7)
    data = {
        ("hot",): rng.normal(size=6000).tolist(), ("ties",): rng.integers(0, 5, size=2000).astype(float).tolist(),
        ("skewed",): np.exp(rng.normal(scale=6, size=1500)).tolist(), ("one",): [3.5], ("two",): [1.0, 2.0], ("odd",): [5.0, 1.0, 4.0],
        (None,): [9.0, 7.0, 8.0, 1.0],
    }
    df = make([(k[0], float(v)) for k, vs in data.items() for v in vs] + [("hot", None)], "k string, v double")
    check_quantiles(df, ["k"], data, accuracy)
    check_quantiles(df, [], {(): [v for vs in data.values() for v in vs]}, accuracy)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60))
def test_exact_quantiles_property(make, values):
    check_quantiles(make([(v,) for v in values], "v double"), [], {(): values}, 30)


def test_null_keys_and_null_groups(make):
    df = make([("a", 1.0), (None, 2.0), (None, 3.0), ("b", None)], "k string, v double")
    assert rows(group_sum(df, ["k"], ["v"], "keep")) == {("a", 1.0), (None, 5.0), ("b", 0.0)}
    assert rows(group_sum(df, ["k"], ["v"], "drop")) == {("a", 1.0), ("b", 0.0)}
    assert rows(with_group_value(df, ["k"], n=F.count("v"))) == {("a", 1.0, 1), (None, 2.0, 2), (None, 3.0, 2), ("b", None, 0)}


def test_latest_rows(make):
    df = make([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 5, "n")], "k string, ver int, t string")
    assert rows(latest_version(df, ["k"], "ver")) == {("a", 2, "y"), ("a", 2, "z"), (None, 5, "n")}
    assert rows(latest_one(df, ["k"], ["ver", "t"])) == {("a", 2, "z"), (None, 5, "n")}
    assert rows(first_per_key(df, ["k"], ["ver", "t"])) == {("a", 1, "x"), (None, 5, "n")}
    assert rows(top_k(df, ["k"], [F.desc("ver"), F.asc("t")], 1)) == {("a", 2, "y", 1), (None, 5, "n", 1)}


def test_subtotals_equal_the_detail(make):
    df = make([("ru", "b1", 1.0), ("ru", "b1", 2.0), ("ru", "b2", 3.0), (None, "b3", 4.0)], "country string, bank string, v double")
    out = rows(subtotals(df, ["country", "bank"], ["v"]))
    assert out == {("ru", "b1", 3.0, 0), ("ru", "b2", 3.0, 0), (None, "b3", 4.0, 0), ("ru", "Total", 6.0, 1), (None, "Total", 4.0, 1),
                   ("Total", "Total", 10.0, 2)}


def test_chunks_bound_the_arrays(make):
    df = make([("k", i) for i in range(250)] * 2, "k string, id bigint")
    out = collect_chunks(df, ["k"], "id", 100).collect()
    assert sorted(len(r.members) for r in out) == [50, 100, 100]
    assert sorted(m for r in out for m in r.members) == list(range(250))


def test_correlations_are_pairwise_complete(make):
    data = [(1.0, 2.0, 1.0), (2.0, 4.0, None), (3.0, 6.0, 5.0), (4.0, 8.5, 2.0)]
    got = {(r.col_a, r.col_b): r["corr"] for r in correlations(make(data, "a double, b double, c double"), ["a", "b", "c"]).collect()}
    assert got[("a", "b")] == pytest.approx(np.corrcoef([1, 2, 3, 4], [2, 4, 6, 8.5])[0, 1])
    assert got[("a", "c")] == got[("c", "a")] == pytest.approx(np.corrcoef([1, 3, 4], [1, 5, 2])[0, 1])
    assert got[("a", "a")] == 1.0


def test_outliers_and_description(make):
    df = make([(float(i), 1.0) for i in range(20)] + [(1000.0, 1.0), (None, 1.0)], "v double, w double")
    assert without_outliers(df, ["v", "w"]).count() == 20
    d = {r["column"]: r for r in describe(df, ["v", "w"]).collect()}
    assert (d["v"]["count"], d["v"]["min"], d["v"]["max"], d["v"]["q50"]) == (21, 0.0, 1000.0, 10.0)
    assert d["w"]["std"] == 0.0
