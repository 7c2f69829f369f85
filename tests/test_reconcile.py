from __future__ import annotations

import pytest

from ledgerloom.operators.reconcile import (
    agreement, column_values, coverage, difference_profile, drop_mirrored, mirror_pairs, period_diff, reconcile, reporting_grid, version_pairs,
)
from ledgerloom.operators.rules import rule_diff
from ledgerloom.plans.reconciliations import treasury_amounts
from tests.conftest import rows


def test_reconcile_matches_null_keys_and_sums_first(make):
    a = make([("x", None, 10.0), ("x", None, 5.0), ("y", 1, 1.0)], "k string, j int, a double")
    b = make([("x", None, -15.0), ("z", 2, 3.0), (None, None, 4.0)], "k string, j int, b double")
    assert rows(reconcile(a, b, ["k", "j"], "a", "b")) == {
        ("x", None, 15.0, -15.0, False), ("y", 1, 1.0, 0.0, True), ("z", 2, 0.0, 3.0, True), (None, None, 0.0, 4.0, True)}


def test_mirror_pairs(make):
    pairs = make([("A", "B", "USD", 1.0), ("B", "A", "USD", 2.0), ("A", "A", "USD", 3.0), ("A", "C", "USD", 4.0), ("C", "A", "EUR", 5.0),
                  (None, "A", "USD", 6.0), ("A", None, "USD", 7.0), ("D", "A", None, 8.0), ("A", "D", None, 9.0), ("E", "A", "USD", None), ("A", "E", "USD", 1.5)],
                 "a string, b string, ccy string, v double")
    assert rows(mirror_pairs(pairs, "a", "b", ["ccy"], ["v"])) == {
        ("A", "B", "USD", 1.0, 2.0), ("B", "A", "USD", 2.0, 1.0), ("A", "A", "USD", 3.0, 3.0), ("A", "C", "USD", 4.0, None), ("C", "A", "EUR", 5.0, None),
        (None, "A", "USD", 6.0, None), ("A", None, "USD", 7.0, None), ("D", "A", None, 8.0, None), ("A", "D", None, 9.0, None),
        ("E", "A", "USD", None, 1.5), ("A", "E", "USD", 1.5, None)}


def test_drop_mirrored_only_touches_flagged_rows(make):
    df = make([("A", "B", 1, False), ("B", "A", 1, True), ("C", "D", 1, True), ("D", "C", 2, False)], "a string, b string, k int, only boolean")
    assert rows(drop_mirrored(df, "a", "b", ["k"], "only")) == {("A", "B", 1, False), ("C", "D", 1, True), ("D", "C", 2, False)}


def test_treasury_amounts_ignores_doubles_and_mirrors(make):
    own = make([(1, "A", "B", 10.0), (2, "A", "B", 10.0), (3, "A", "B", 10.0)], "deal int, e string, p string, amount double")
    unified = make([(1, "A", "B", 10.0), (1, "B", "A", -10.0), (2, "A", "B", 20.0), (3, "A", "B", 30.0), (4, "A", "B", 5.0)],
                   "deal int, e string, p string, amount double")
    out = treasury_amounts(own, unified, ["deal"], "e", "p")
    assert rows(out.select("deal", "e", "p", "amount", "amount_unified", "differs")) == {
        (1, "A", "B", 10.0, 10.0, False), (2, "A", "B", 10.0, 20.0, False), (3, "A", "B", 10.0, 30.0, True), (4, "A", "B", 0.0, 5.0, True)}


def test_period_diff(make):
    old = make([("a", 0.0), ("b", -10.0), ("c", 5.0), ("e", None)], "k string, v double")
    new = make([("a", 5.0), ("b", 5.0), ("d", 7.0), ("e", 1.0)], "k string, v double")
    assert rows(period_diff(old, new, ["k"], "v")) == {
        ("a", 0.0, 5.0, 5.0, 0.0), ("b", -10.0, 5.0, 15.0, 1.5), ("c", 5.0, 0.0, -5.0, -1.0), ("d", 0.0, 7.0, 7.0, 0.0), ("e", 0.0, 1.0, 1.0, 0.0)}


def test_sides_and_agreement(make):
    a = make([("x",), ("x",), ("y",), (None,)], "k string")
    b = make([("x",), ("z",), (None,)], "k string")
    assert rows(coverage(a, b, ["k"])) == {("x", "both"), (None, "both"), ("y", "left_only"), ("z", "right_only")}
    assert rows(rule_diff(a, b, ["k"])) == {("y", "only_old"), ("z", "only_new")}
    left = make([(1, "h", "s"), (2, "h", None)], "k int, holding string, segment string")
    right = make([(1, "h", "t"), (3, "h", "s")], "k int, holding2 string, segment2 string")
    out = agreement(left, right, ["k"], {"holding": "holding2", "segment": "segment2"})
    assert rows(out.select("k", "holding_equal", "segment_equal")) == {(1, True, False), (2, False, False), (3, False, False)}


def test_version_pairs_and_profiles(make):
    df = make([("a", 1), ("a", 3), ("a", 3), ("a", 7), ("b", 2)], "k string, day int")
    assert rows(version_pairs(df, ["k"], "day")) == {("a", 3, 1), ("a", 7, 3)}
    assert rows(difference_profile(df, ["k", "day"])) == {("k", 5, 2), ("day", 5, 4)}
    assert ("k", "a", 4) in rows(column_values(df, ["k", "day"]))


def test_reporting_grid_is_whole(make):
    df = make([("h", "s1"), ("h", "s2"), ("h", "s2"), ("g", "s3"), ("h", None)], "holding string, segment string")
    assert rows(reporting_grid(df, "holding", "segment")) == {
        ("h", "s1", "s1"), ("h", "s1", "s2"), ("h", "s2", "s1"), ("h", "s2", "s2"), ("g", "s3", "s3")}
    many = make([("h", f"s{i}") for i in range(1100)], "holding string, segment string")
    assert reporting_grid(many, "holding", "segment").count() == 1100 ** 2


def test_treasury_derivatives_sums_both_sides_in_bounded_tasks(make, monkeypatch):
    from ledgerloom.plans import reconciliations as R

    schema = "deal int, leg string, ccy string, amount double"
    own = [(1, "pay", "A", 10.0), (1, "pay", "A", 5.0), (1, "pay", None, 1.0), (2, "pay", "A", None), (3, "pay", "A", 7.0), (None, "pay", "A", 2.0)]
    other = [(1, "pay", "A", 30.0), (1, "pay", None, 1.0), (2, "pay", "A", 4.0), (4, "receive", "A", 8.0), (None, "pay", "A", 2.0)]
    monkeypatch.setattr(R, "ROWS_A_TASK", 4)
    found = R.treasury_derivatives(make(own, schema), make(other, schema), make([(1,), (1,), (None,)], "deal int"), ["deal", "leg", "ccy"], "deal")
    assert sorted(map(tuple, found.collect()), key=str) == sorted([
        (1, "pay", "A", 15.0, 30.0, True, True), (1, "pay", None, 1.0, 1.0, True, False), (2, "pay", "A", None, 4.0, False, True),
        (3, "pay", "A", 7.0, None, False, True), (4, "receive", "A", None, 8.0, False, True), (None, "pay", "A", 2.0, 2.0, False, False)], key=str)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and "hashpartitioning(deal" in plan and ", 3), REPARTITION_BY_NUM" in plan
