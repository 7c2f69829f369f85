from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from ledgerloom.operators.rules import (
    Rule, classify, classify_by_prefix, classify_by_table, condition_filter, drop_excluded, mapping_gaps, rule_overlaps, rule_table,
)
from tests.conftest import rows

RULES = [
    Rule("exact", ("S1",), "AR", accounts=("100", "200")),
    Rule("prefix", ("S1", "S2"), "AR", prefixes=("10", "62")),
    Rule("mixed", ("S1",), "AP", accounts=("6200",), prefixes=("620",)),
    Rule("late", ("S1", "S2"), "AP", accounts=("6200", "1")),
]


def facts(make):
    accounts = ["100", "1001", "10", "200", "62", "6200", "6299", "1", "", None]
    return make([(s, r, a, "c") for s, r, a in itertools.product(["S1", "S2", "S3"], ["AR", "AP"], accounts)],
                "source string, report_type string, account string, code string")


def test_first_rule_wins_and_prefixes_match(make):
    out = facts(make).select("source", "report_type", "account", classify(RULES, "source", "report_type", "code", "account", "Unknown").alias("p"))
    got = {(r.source, r.report_type, r.account): r.p for r in out.collect()}
    assert got[("S1", "AR", "100")] == "exact" and got[("S1", "AR", "1001")] == "prefix" and got[("S2", "AR", "100")] == "prefix"
    assert got[("S1", "AP", "6200")] == "mixed" and got[("S2", "AP", "6200")] == "late" and got[("S1", "AP", "1")] == "late"
    assert got[("S3", "AR", "100")] == got[("S1", "AR", None)] == got[("S1", "AR", "")] == "Unknown"


def test_rule_list_and_rule_table_agree(make, spark):
    df = facts(make)
    by_list = rows(df.select("source", "report_type", "account", classify(RULES, "source", "report_type", "code", "account").alias("p")))
    out = classify_by_table(df, rule_table(spark, RULES), ["source", "report_type", "code"], "account")
    assert out.count() == df.count()
    assert rows(out.select("source", "report_type", "account", "purpose")) == by_list


def test_codes_restrict_rules(make):
    rules = [Rule("coded", ("S",), "AR", codes=("B1",)), Rule("any", ("S",), "AR")]
    df = make([("S", "AR", "B1", None), ("S", "AR", "B2", None), ("S", "AR", None, None)], "s string, r string, c string, a string")
    assert [r[0] for r in df.select(classify(rules, "s", "r", "c", "a")).collect()] == ["coded", "any", "any"]


def test_prefix_labels(make):
    df = make([("58100",), ("66",), ("5",), (None,)], "a string")
    assert [r[0] for r in df.select(classify_by_prefix("a", {"x": ["58"], "y": ["5", "66"]}, "-")).collect()] == ["x", "y", "y", "-"]


def test_conditions_keep_multiplicity(make):
    df = make([("f", "x"), ("g", "x"), ("g", None)], "a string, b string")
    assert sorted(tuple(r) for r in condition_filter(df, [{"a": "f", "b": "x"}, {"b": "x"}]).collect()) == [("f", "x", 0), ("f", "x", 1), ("g", "x", 1)]


def test_exclusions_overlaps_and_gaps(make):
    lines = make([("p1", "a", 1), ("p2", "a", 2), ("p1", "b", 1)], "purpose string, account string, priority int")
    assert rows(drop_excluded(lines, make([("p1", "b")], "purpose string, account string"), ["purpose", "account"]).select("purpose", "account")) == {
        ("p1", "a"), ("p2", "a")}
    assert rows(rule_overlaps(lines, ["account"])) == {("a", 2, 1)}
    df = make([("n1", "External", True), ("n1", "External", True), ("n2", "s", True), ("n3", "External", False)], "name string, seg string, internal boolean")
    gaps = mapping_gaps(df, {"party": (F.col("internal") & (F.col("seg") == "External"), ["name", "seg"])})
    assert rows(gaps) == {("party", "n1", "External")}


def test_rule_table_equals_rule_list_with_wildcards_and_any_prefix(make, spark):
    rules = [
        Rule("coded", codes=("C1", "C2"), prefixes=("1234567890", "9")), Rule("any source", report_type="AR", accounts=("5",)),
        Rule("any type", ("S1",), prefixes=("77", "7")), Rule("no account", ("S2",), codes=("C3",)), Rule("long", ("S3",), "AP", prefixes=("a" * 200,)),
    ]
    accounts = ["1234567890x", "123456789", "9", "5", "77", "7", "8", None, "", "a" * 200 + "b", "a" * 199]
    facts = [(s, r, c, a) for s in ("S1", "S2", "S3", None) for r in ("AR", "AP", None) for c in ("C1", "C3", None) for a in accounts]
    df = make(facts + facts[:7], "source string, report_type string, code string, account string")
    by_list = df.select("*", classify(rules, "source", "report_type", "code", "account").alias("p")).collect()
    by_table = classify_by_table(df, rule_table(spark, rules), ["source", "report_type", "code"], "account", "p")
    assert sorted(map(repr, by_list)) == sorted(map(repr, by_table.select("source", "report_type", "code", "account", "p").collect()))
    nothing = classify_by_table(df, rule_table(spark, []), ["source", "report_type", "code"], "account", "p")
    assert nothing.where("p IS NOT NULL").count() == 0 and nothing.count() == df.count()
