from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators.quality import (
    alerts, compare_profiles, count_differences, drop_empty_rows, empty_columns, expectations, last_seen, last_two_days, profile, repeated_keys,
    snapshot_changes,
)
from ledgerloom.operators.reshape import melt_pairs, pivot_sum, stack_halves, transpose
from ledgerloom.plans import positions
from tests.conftest import rows

D = [dt.date(2024, 1, d) for d in (1, 2, 3)]


def test_profile(make):
    df = make([(1, 0.0, "x"), (None, 2.5, "4"), (0, 0.0, "0")], "a bigint, b double, c string")
    assert rows(profile(df)) == {("a", "bigint", 3, 1, 1.0, 3, 1), ("b", "double", 3, 0, 2.5, 3, 1), ("c", "string", 3, 0, 4.0, 3, 1)}


def test_compare_profiles_flags(make):
    old = profile(make([(1.0, "a"), (2.0, "b")], "v double, t string"))
    new = profile(make([(10.0, None), (2.0, None)], "v double, w string"))
    got = {r["column"]: r for r in compare_profiles(old, new).collect()}
    assert not got["v"].sum_equal and got["v"].rows_equal and got["v"].type_equal
    assert not got["t"].type_equal and not got["w"].type_equal and got["w"].nulls_new == 2


def test_empty_rows_and_columns(make):
    df = make([(0.0, "0", None), (None, None, None), (1.0, "0", None)], "a double, b string, c string")
    assert drop_empty_rows(df, ["a", "b", "c"]).count() == 1
    assert rows(empty_columns(df, ["a", "b", "c"])) == {("a", False), ("b", True), ("c", True)}


def balances(make):
    return make([(D[0], "gone", 1.0), (D[1], "gone", 2.0), (D[1], "stay", 3.0), (D[2], "stay", 4.0), (D[2], "back", 5.0), (D[0], "back", 6.0),
                 (D[2], "new", 7.0), (D[2], "new", 8.0), (D[2], None, 9.0)], "day date, account string, amount double")


def test_snapshot_changes_and_last_seen(make):
    df = balances(make)
    assert rows(last_two_days(df, "day")) == {(D[2], 1), (D[1], 2)}
    changes = snapshot_changes(df, "day", ["account"], "amount")
    assert rows(changes) == {("missing", "gone", 1, 2.0), ("new", "back", 1, 5.0), ("new", "new", 2, 15.0), ("new", None, 1, 9.0)}
    seen = last_seen(df, "day", ["account"], changes.where("status = 'new'").select("account"), F.lit(D[2]))
    assert rows(seen) == {("back", "2024-01-01"), ("new", "never"), (None, "never")}


def test_every_alert_is_judged_on_its_own(make):
    df = balances(make)
    out = alerts(df, {"a": (F.col("amount"), 45.0), "b": (F.col("amount"), 46.0), "c": (F.when(F.lit(False), F.col("amount")), 1.0)})
    assert rows(out.select("alert", "level")) == {("a", "CRITICAL"), ("b", "ALERT"), ("c", "OK")}
    report = positions.liquidity_qc(df, "day", ["account"], "amount", {"missing": 2.0, "new": 1000.0})
    assert rows(report.select("account", "last_seen", "level")) == {
        ("gone", None, "CRITICAL"), ("back", "2024-01-01", "ALERT"), ("new", "never", "ALERT"), (None, "never", "ALERT")}


def test_checks(make):
    df = make([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    out = expectations(df, {"rows": (F.count(F.lit(1)), F.lit(3)), "distinct": (F.count_distinct("k"), F.lit(3))})
    assert rows(out) == {("rows", 3.0, 3.0, True), ("distinct", 2.0, 3.0, False)}
    assert rows(repeated_keys(df, ["k"])) == {("a", 2)}
    assert rows(count_differences(df, make([("a",), ("c",)], "k string"), "k")) == {("a", 2, 1), ("b", 1, 0), ("c", 0, 1)}


def test_reshapes(make):
    df = make([("k", "x", 1.0), ("k", "x", 2.0), ("k", "z", 9.0), ("m", "y", 3.0)], "k string, c string, v double")
    assert rows(pivot_sum(df, ["k"], "c", ["x", "y"], "v")) == {("k", 3.0, None), ("m", None, 3.0)}
    assert rows(pivot_sum(df, ["k"], "c", ["x", "y"], "v", 0.0)) == {("k", 3.0, 0.0), ("m", 0.0, 3.0)}
    small = make([("r1", 1.0, 2.0), ("r2", 3.0, 4.0)], "name string, a double, b double")
    assert rows(transpose(small, "name", ["r1", "r2"], ["a", "b"])) == {("a", 1.0, 3.0), ("b", 2.0, 4.0)}
    wide = make([(1, "u", "d1", "w", "d2")], "id int, fa string, fd string, ga string, gd string")
    assert rows(melt_pairs(wide, ["id"], {"F": ("fa", "fd"), "G": ("ga", "gd")})) == {(1, "F", "u", "d1"), (1, "G", "w", "d2")}
    assert rows(stack_halves(wide, {"fa": "name", "fd": "value"}, {"ga": "name", "gd": "value"}, ("Assets", "Equity"))) == {
        (1, "Assets", "u", "d1"), (1, "Equity", "w", "d2")}


def test_outputs_of_one_run_are_listed(make):
    from ledgerloom.plans.monitoring import archive_compare

    df = make([(1,)], "a int")
    found = archive_compare({"x": df, "y": df}, {"y": df, "z": df})
    assert rows(found["unpaired"]) == {("x", "only_old"), ("z", "only_new")} and found["columns"].count() == 1
    assert rows(archive_compare({"x": df}, {"z": df})["unpaired"]) == {("x", "only_old"), ("z", "only_new")}


def test_checklist_counts(make):
    from ledgerloom.operators.quality import checklist

    df = make([(1, float(v), "5") for v in range(20)] + [(2, 1000.0, "x"), (3, None, None)], "k int, v double, t string")
    assert rows(checklist(df, ["k"], ["v"], ["t"])) == {
        ("null", "k", 0), ("null", "v", 1), ("null", "t", 1), ("no number", "t", 1), ("repeated", "k", 19), ("outlier", "v", 1)}


def test_decimal_zero_is_empty(make):
    from ledgerloom.functions.columns import is_empty_value

    df = make([("0.00",), ("0",), ("x",), (None,), ("1",)], "t string").withColumn("d", F.col("t").try_cast("decimal(10,2)"))
    assert [tuple(r) for r in df.select(is_empty_value("t"), is_empty_value("d")).collect()] == [
        (True, True), (True, True), (False, True), (True, True), (False, False)]
