from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.measures import (
    days_to, deal_signs, differs, limit_breach, maturity_bucket, mostly_equal, outside_band, ratio_above, safe_ratio,
    second_best, signed_pct, week_label,
)
from ledgerloom.functions.text import (
    clean_list, concat_key, cut_suffix, extract, keyword_tag, name_value, remap, split_part, to_number,
)

DAY = dt.date(2024, 6, 30)
BUCKETS = [(-5, "<1M"), (None, "<1M"), (29, "<1M"), (30, "1M-3M"), (90, "1M-3M"), (91, "3M-6M"), (181, "3M-6M"),
           (182, "6M-1Y"), (364, "6M-1Y"), (365, "1Y-2Y"), (729, "1Y-2Y"), (730, "2Y+")]


def test_maturity_bucket_edges(make):
    df = make([(n, None if n is None else DAY + dt.timedelta(days=n)) for n, _ in BUCKETS], "n int, due date")
    got = df.select("n", days_to("due", F.lit(DAY)).alias("days"), maturity_bucket("due", F.lit(DAY)).alias("b")).collect()
    assert [(r.n, r.b) for r in got] == BUCKETS
    assert all(r.days == (r.n or 0) for r in got)


@pytest.mark.parametrize("a, b, expected", [
    (100.0, 100.0, False), (100.0, -100.0, False), (100.0, 60.0, True), (100.0, 60.1, False), (0.0, 0.0, False),
    (None, 5.0, False), (5.0, None, False), (0.0, 5.0, True), (-10.0, -100.0, True),
])
def test_differs(make, a, b, expected):
    df = make([(a, b)], "a double, b double")
    assert df.select(differs("a", "b", 0.4)).first()[0] is expected
    assert df.select(differs("b", "a", 0.4)).first()[0] is expected


def test_mostly_equal_keeps_the_sign(make):
    df = make([(100.0, -100.0), (100.0, 61.0), (0.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(mostly_equal("a", "b")).collect()] == [False, True, True]


def test_outside_band(make):
    df = make([(7.0, 10.0), (6.9, 10.0), (13.1, 10.0), (-10.0, 10.0), (1.0, 0.0), (0.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(outside_band("a", "b")).collect()] == [False, True, True, False, True, None]


def test_signed_pct(make):
    df = make([(0.0, 5.0), (10.0, 15.0), (-10.0, 5.0), (10.0, 10.0), (10.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(signed_pct("a", "b")).collect()] == [0.0, 0.5, 1.5, 0.0, -1.0]


def test_ratios(make):
    df = make([(10.0, 0.0), (10.0, 4.0), (None, 4.0), (1.0, 3.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_ratio("a", "b", 100.0)).collect()][:3] == [0.0, 250.0, 0.0]
    assert [r[0] for r in df.select(ratio_above("a", "b", 2.0)).collect()] == [False, True, False, True]


@pytest.mark.parametrize("used, limit, expected", [
    (90.0, 100.0, "ok"), (105.0, 100.0, "insignificant"), (110.0, 100.0, "insignificant"), (110.5, 100.0, "significant"),
    (1011.0, 1000.0, "significant"), (1010.0, 1000.0, "insignificant"), (0.5, 0.0, "significant"), (5.0, None, "ok"),
])
def test_limit_breach(make, used, limit, expected):
    assert make([(used, limit)], "u double, l double").select(limit_breach("u", "l")).first()[0] == expected


@pytest.mark.parametrize("values, expected", [
    ((7.0, 9.0, 8.0), (8.0, "G")), ((9.0, 9.0, 1.0), (9.0, "B")), ((0.0, 9.0, 8.0), (8.0, "G")), ((0.0, 9.0, 0.0), (9.0, "B")),
    ((0.0, 0.0, 0.0), (None, None)), ((None, None, None), (None, None)), ((None, 3.0, 5.0), (3.0, "B")),
])
def test_second_best(make, values, expected):
    df = make([values], "a double, b double, g double")
    value, source = second_best({"A": F.col("a"), "B": F.col("b"), "G": F.col("g")})
    assert tuple(df.select(value, source).first()) == expected


def test_deal_signs(make):
    df = make([("buy", -3.0, 5.0), ("sell", 3.0, -5.0), ("other", -1.0, 2.0)], "k string, q double, m double")
    q, m = deal_signs("k", "q", "m", "buy", "sell")
    assert [tuple(r) for r in df.select(q, m).collect()] == [(3.0, -5.0), (-3.0, 5.0), (-1.0, 2.0)]


def test_week_label_pairs_iso_week_with_calendar_year(make):
    df = make([(dt.date(2024, 12, 30),), (dt.date(2023, 1, 1),)], "d date")
    assert [tuple(r) for r in df.select(week_label("d"), week_label("d", iso_year=True)).collect()] == [
        ("1.2024", "1.2025"), ("52.2023", "52.2022")]


def test_text_functions(make):
    df = make([("MOP G 12:40 $283", "Some Bank (EC)", "RUE", "UREA gran, an nan")], "line string, party string, ccy string, words string")
    name, value = name_value("line")
    row = df.select(
        name, value, cut_suffix("party", r" \(EC\)"), cut_suffix("ccy", r" \(EC\)"), remap("ccy", {"RUE": "EUR"}), remap("party", {"x": "y"}),
        keyword_tag("words", ["AN", "UREA"]), keyword_tag("words", ["UREA", "AN"]), split_part("line", " ", -1), split_part("line", "#", 2),
        extract("line", r"(\d+):"), extract("line", "(zzz)"), to_number("ccy"), clean_list(F.lit("nan, a,, b ,nan")),
        concat_key(["ccy", "nothing"]) if "nothing" in df.columns else F.lit("-"),
    ).first()
    assert tuple(row) == ("MOP G 12:40", "283", "Some Bank", "RUE", "EUR", "Some Bank (EC)", "UREA", "AN", "$283", None, "12", None, None,
                          "a,b", "-")


def test_concat_key_writes_nulls_as_text(make):
    assert make([("a", None, 3)], "x string, y string, z int").select(concat_key(["x", "y", "z"])).first()[0] == "a_nan_3"
