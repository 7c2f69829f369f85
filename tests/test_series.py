from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.series import (
    backward_fill, cross_rate, forward_fill, pct_change, rolling_mean, rolling_std, section_slice, to_series, volatility,
)
from tests.conftest import rows

D = dt.date(2024, 1, 1)


def series(make, values, key="p", step=1):
    return make([(key, D + dt.timedelta(days=step * i), v) for i, v in enumerate(values)], "product string, period date, value double")


@pytest.mark.parametrize("n", [1, 13, 14, 15])
def test_rolling_mean_windows(make, n):
    values = [float(i * i) for i in range(n)]
    df = series(make, values, step=3)
    got = [tuple(r) for r in df.select(
        "period", rolling_mean(df, ["product"], "period", "value", 14), rolling_mean(df, ["product"], "period", "value", 14, full_window=True),
        rolling_std(df, ["product"], "period", "value", 2)).orderBy("period").collect()]
    for i, (_, short, full, std) in enumerate(got):
        assert short == pytest.approx(np.mean(values[max(0, i - 13):i + 1]))
        assert full == (pytest.approx(np.mean(values[i - 13:i + 1])) if i >= 13 else None)
        assert std == (pytest.approx(np.std(values[i - 1:i + 1], ddof=1)) if i >= 1 else None)


def test_pct_change_orders_by_period(make):
    df = make([("p", D + dt.timedelta(days=i), v) for i, v in ((2, 4.0), (0, 1.0), (1, 2.0), (3, 0.0), (4, 5.0))],
              "product string, period date, value double")
    got = [r[1] for r in df.select("period", pct_change(["product"], "period", "value")).orderBy("period").collect()]
    assert got == [None, 1.0, 1.0, -1.0, None]


def std_of(values):
    return float(np.std(values, ddof=1)) * 100 if len(values) > 1 else None


def test_volatility_horizons(make):
    values = [1.0, 2.0, 3.0, 2.0, 5.0, 4.0]
    changes = [0.0] + [b / a - 1 for a, b in zip(values, values[1:])]
    out = volatility(series(make, values), ["product"], "period", "value", {"v3": 3, "v99": 99, "all": None}).first()
    assert out.v3 == pytest.approx(std_of(changes[-3:])) and out.v99 == out["all"] == pytest.approx(std_of(changes))
    one = volatility(series(make, [1.0]), ["product"], "period", "value", {"v3": 3, "all": None}).first()
    assert one.v3 is None and one["all"] is None


def test_volatility_strict_needs_the_rows(make):
    values = [1.0, 2.0, 3.0, 2.0, 5.0]
    changes = [b / a - 1 for a, b in zip(values, values[1:])]
    out = volatility(series(make, values), ["product"], "period", "value", {"v5": 5, "v6": 6, "v4": 4, "all": None}, strict=True).first()
    assert out.v5 == pytest.approx(std_of(changes)) and out.v6 is None and out.v4 == pytest.approx(std_of(changes[-3:]))
    assert out["all"] == pytest.approx(std_of(changes))


def test_cross_rate_on_shared_days(make):
    df = make([("A", D, 2.0), ("B", D, 8.0), ("A", D + dt.timedelta(days=1), 4.0)], "pair string, period date, value double")
    assert ("A/B", D, 4.0) in rows(cross_rate(df, "pair", "period", "value", "A", "B", "A/B"))
    assert cross_rate(df, "pair", "period", "value", "A", "B", "A/B").count() == 4


def test_to_series_means_per_day(make):
    df = make([("a", dt.datetime(2024, 1, 1, 5), 1.0), ("a", dt.datetime(2024, 1, 1, 9), 3.0)], "p string, ts timestamp_ntz, v double")
    assert rows(to_series(df, ["p"], "ts", "v")) == {("a", D, 2.0)}


@pytest.mark.parametrize("chunk", [1, 3, 7, 100_000])
def test_fills_match_a_plain_loop(make, chunk):
    rnd = random.Random(5)
    data = [(f, i, rnd.choice([None, None, "x", "y"]), rnd.choice([None, float(i)])) for f in ("f1", "f2", None) for i in range(40)]
    df = make(data, "file string, row_no bigint, a string, b double")

    def expected(reverse):
        out = set()
        for f in ("f1", "f2", None):
            a = b = None
            part = sorted((r for r in data if r[0] == f), key=lambda r: r[1], reverse=reverse)
            for _, i, x, y in part:
                a, b = x if x is not None else a, y if y is not None else b
                out.add((f, i, a, b))
        return out

    assert rows(forward_fill(df, ["file"], "row_no", ["a", "b"], chunk)) == expected(False)
    assert rows(backward_fill(df, ["file"], "row_no", ["a", "b"], chunk)) == expected(True)


def test_section_slice(make):
    names = {"f1": ["top", "Start", "a", "End", "b"], "f2": ["End", "Start", "c"], "f3": ["a", "End"], "f4": ["Start", "Start", "d", "End", "End"]}
    df = make([(f, i, n) for f, ns in names.items() for i, n in enumerate(ns)], "file string, row_no int, name string")
    start, end = F.col("name") == "Start", F.col("name") == "End"
    got = {f: [r.name for r in section_slice(df, ["file"], "row_no", start, end).where(F.col("file") == f).orderBy("row_no").collect()] for f in names}
    assert got == {"f1": ["Start", "a", "End"], "f2": ["Start", "c"], "f3": [], "f4": ["Start", "Start", "d", "End"]}
    assert section_slice(df, ["file"], "row_no", start, end, include_end=False).where("file = 'f1'").count() == 2
