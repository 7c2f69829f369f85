from __future__ import annotations

from pyspark.sql import functions as F

import datetime as dt

from ledgerloom.operators.treasury import control_totals, effective_params, legs, minimum_of_versions, net_bonds
from tests.conftest import rows

BOND_SCHEMA = "deal_set string, owner string, entity string, grp string, party string, amount double, usd double, ccy string"
BONDS = [
    ("one", "ISSUED", "E1", "g", "P1", 100.0, 10.0, "EUR"), ("one", "TRADED", "E2", "g2", "P2", -30.0, -3.0, "USD"),
    ("two", "ISSUED", "E1", "g", "P1", 50.0, 5.0, "EUR"), ("two", "ISSUED", "E1", "g", "P1", 60.0, 6.0, "USD"), ("two", "TRADED", "E3", "g3", "P9", -10.0, -1.0, "USD"),
    ("none", "TRADED", "E4", "g", "P1", 5.0, 1.0, "USD"),
    ("alone", "ISSUED", "E5", None, None, 7.0, 0.7, "USD"),
    ("mixed", "ISSUED", "E1", "g", "P1", 1.0, 1.0, "USD"), ("mixed", "ISSUED", "E2", "g", "P1", 1.0, 1.0, "USD"),
]


def test_bond_netting(make):
    out = net_bonds(make(BONDS, BOND_SCHEMA), ["deal_set"], "owner", "ISSUED", "TRADED", ["entity", "grp"], "party", ["amount", "usd"], carry=["ccy"])
    assert rows(out) == {
        ("one", "ISSUED", "E1", "g", "P1", 70.0, 7.0, "EUR"), ("one", "TRADED", "E2", "g2", "E1", -30.0, -3.0, "USD"),
        ("two", "ISSUED", "E1", "g", "P1", 100.0, 10.0, "EUR"), ("two", "TRADED", "E3", "g3", "E1", -10.0, -1.0, "USD"),
        ("alone", "ISSUED", "E5", None, None, 7.0, 0.7, "USD")}


def test_netting_keeps_the_set_total_of_issued_plus_traded(make):
    df = make(BONDS, BOND_SCHEMA)
    out = net_bonds(df, ["deal_set"], "owner", "ISSUED", "TRADED", ["entity", "grp"], "party", ["amount", "usd"])
    issued = {r.deal_set: r.amount for r in out.where("owner = 'ISSUED'").collect()}
    assert issued == {"one": 70.0, "two": 100.0, "alone": 7.0}


def test_legs(make):
    df = make([(1, "USD", 10.0, "EUR", 9.0)], "deal int, pc string, p double, rc string, r double")
    assert rows(legs(df, ["deal"], "pc", "p", "rc", "r")) == {(1, "pay", "USD", -10.0), (1, "receive", "EUR", 9.0)}


def test_effective_params(make):
    params = make([("h", dt.date(2020, 1, 1), dt.date(2024, 7, 1), 1.0), ("h", dt.date(2024, 7, 1), None, 2.0)],
                  "holding string, valid_from date, valid_to date, threshold double")
    facts = make([("h", dt.date(2024, 6, 30)), ("h", dt.date(2024, 7, 1)), ("h", dt.date(2019, 1, 1)), ("x", dt.date(2024, 1, 1))], "holding string, day date")
    assert rows(effective_params(facts, params, "holding", "day", ["threshold"])) == {
        ("h", dt.date(2024, 6, 30), 1.0), ("h", dt.date(2024, 7, 1), 2.0), ("h", dt.date(2019, 1, 1), None), ("x", dt.date(2024, 1, 1), None)}


def test_minimum_of_versions(make):
    df = make([("c1", "H1", "035", 5.0), ("c1", "H1", "045", 3.0), ("c2", "H1", "035", 5.0), ("c3", "H2", "045", 9.0), ("c3", "H2", "075", 8.0), ("c4", "H1", "035", -5.0)],
              "company string, holding string, version string, v double")
    out = minimum_of_versions(df, ["company"], "holding", "version", "v", {"H1": ("035", "045"), "H2": ("045", "075")})
    # a missing version is 0: it is the lower one unless the other is negative
    assert rows(out.select("company", "amount")) == {("c1", 3.0), ("c3", 8.0), ("c4", -5.0)}


def test_control_totals(make):
    df = make([("a", 50.0), ("a", 50.5), ("b", 10.0)], "k string, v double")
    stated = make([("a", 100.0), ("b", 11.0)], "k string, stated double")
    assert rows(control_totals(df, stated, ["k"], "v", "stated")) == {("a", 100.0, 100.5, True), ("b", 11.0, 10.0, False)}


def test_every_line_is_a_derivative_or_a_debt_deal(make):
    import types

    from ledgerloom.catalog.reports import deriv_inputs

    lines = [(1, 10, 100, 5.0, 10.0, "A", "F"), (1, 10, 100, 45.0, 10.0, "R", "F"), (2, 10, 100, 46.0, 10.0, "R", "O"), (2, 10, 100, 3.0, 10.0, "N", "O"),
             (3, 10, 100, None, 10.0, "R", "F"), (4, 10, 100, 50.0, 10.0, "N", "F")]
    df = make(lines, "l_orderkey bigint, l_suppkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string")
    df = df.withColumn("l_shipdate", F.lit("1998-07-01").cast("timestamp_ntz"))
    forwards, swaps, debt = deriv_inputs(types.SimpleNamespace(lineitem=df))
    numbers = [sorted(r.deal_no for r in d.select("deal_no").collect()) for d in (forwards, swaps, debt)]
    assert numbers == [[1], [1, 2, 3, 4], [2]]
