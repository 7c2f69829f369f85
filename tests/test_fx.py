from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators.fx import convert, iso_code, rates_to, split_pair, unwrap_virtual
from tests.conftest import rows

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
QUOTES = [(D1, "EUR", "USD", 1.25), (D1, "USD", "RUB", 80.0), (D1, "GBP", "USD", 1.5), (D1, "USD", "GBP", 0.5), (D1, "CNY", "USD", None),
          (D1, "EUR", "CHF", 0.9), (D1, "EUR", "USD", 1.5), (D2, "USD", "RUB", 100.0)]
SCHEMA = "period date, ccy_from string, ccy_to string, rate double"


def test_rates_prefer_the_inverse_and_settle_repeats(make):
    got = {(d, c): k for d, c, k in rows(rates_to(make(QUOTES, SCHEMA), "USD"))}
    assert got == {(D1, "EUR"): 1.25, (D1, "RUB"): 1 / 80, (D1, "GBP"): 2.0, (D1, "CNY"): None, (D2, "RUB"): 0.01}


def test_convert_by_date(make):
    facts = make([(1, D1, "EUR", 10.0), (2, D1, "RUB", 80.0), (3, D1, "USD", 7.0), (4, D1, "CHF", 9.0), (5, D2, "EUR", 10.0), (6, D1, "RUE2", 4.0),
                  (7, D1, "CNY", 3.0), (8, D1, None, 3.0), (9, None, "USD", 2.0)], "id int, day date, ccy string, v double")
    out = convert(facts, make(QUOTES, SCHEMA), "USD", "ccy", "v", "day")
    assert out.columns == ["id", "day", "ccy", "v", "coef_to_USD", "v_in_USD"]
    assert {r.id: r.v_in_USD for r in out.collect()} == {1: 12.5, 2: 1.0, 3: 7.0, 4: None, 5: None, 6: 5.0, 7: None, 8: None, 9: 2.0}


def test_convert_as_of_one_day_keeps_every_row(make):
    facts = make([(i, "RUB", 100.0) for i in range(50)], "id int, ccy string, v double")
    out = convert(facts, make(QUOTES, SCHEMA), "USD", "ccy", "v", F.lit(D2))
    assert out.count() == 50 and rows(out.select("v_in_USD").distinct()) == {(1.0,)}


def test_codes(make):
    df = make([("USD/INR", "RUY5"), ("RUB/INR", "EUR")], "pair string, code string")
    assert [tuple(r) for r in df.select(*split_pair("pair"), iso_code("code")).collect()] == [("USD", "INR", "CNY"), ("RUB", "INR", "EUR")]


def test_virtual_currency(make):
    cur = make([("VAA", "USD", 1.5)], "code string, base string, multiplier double")
    out = unwrap_virtual(make([("VAA", 2.0), ("EUR", 3.0)], "ccy string, v double"), cur, "ccy", "v")
    assert rows(out) == {("VAA", 2.0, "USD", 3.0), ("EUR", 3.0, "EUR", 3.0)}
