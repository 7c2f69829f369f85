from __future__ import annotations

from ledgerloom.operators.dimensions import (
    alternative_key_join, append_checked, fill_missing, lookup, lookup_ignore_case, lookup_multikey, lookup_name, two_pass_lookup,
)
from ledgerloom.plans.entities import Entities
from tests.conftest import rows

UNITS = [(1, "A", "S1", "P1", "seg-a", "h1"), (2, "B", "A", "P2", "seg-b", "h1"), (3, "C", "S3", "P1", "seg-c", "h2"), (4, "D", None, "B", None, "h2"),
         (5, "A", "S5", None, "seg-dup", "h3"), (6, None, "S6", "P6", "seg-6", "h3")]
UNIT_SCHEMA = "unit_key int, id string, short_code string, plant_code string, segment string, holding string"


def test_multikey_lookup(make):
    units = make(UNITS, UNIT_SCHEMA)
    facts = make([("A",), ("B",), ("S3",), ("P1",), ("D",), ("zzz",), (None,), ("S6",)], "code string")
    out = lookup_multikey(facts, "code", units, ["id", "short_code", "plant_code"], "segment", ["unit_key"], "segment")
    # A: id of 1 (not 5) but the short code of 2 overrides; B: id of 2, the plant code of 4 has no value;
    # P1: first of two plants; D and misses are external
    assert rows(out) == {("A", "seg-b"), ("B", "seg-b"), ("S3", "seg-c"), ("P1", "seg-a"), ("D", "External"), ("zzz", "External"),
                         (None, "External"), ("S6", "seg-6")}


def test_lookup_never_changes_the_row_count(make):
    dim = make([("k", "v2"), ("k", "v1"), (None, "vn"), ("m", None)], "k string, v string")
    facts = make([("k",), ("k",), (None,), ("m",), ("x",)], "k string")
    out = lookup(facts, dim, "k", {"v": "v"}, ["v"], "none")
    assert sorted((r.k or "", r.v) for r in out.collect()) == [("", "none"), ("k", "v1"), ("k", "v1"), ("m", "none"), ("x", "none")]


def test_lookup_name(make):
    names = make([("Acme", "A1"), ("Acme", "A0"), (None, "N")], "name string, code string")
    out = lookup_name(make([("Acme",), ("Other",), (None,)], "company string"), "company", names, "name", "code", ["code"], "code_found")
    assert rows(out) == {("Acme", "A0"), ("Other", "External"), (None, "External")}


def test_two_pass_lookup(make):
    dim = make([("1", "x", "both"), ("9", "y", "name-only")], "code string, name string, text string")
    out = two_pass_lookup(make([("1", "x"), ("2", "y"), ("3", "z")], "code string, name string"), dim, ["code", "name"], ["name"], "text", ["code"], "t")
    assert rows(out) == {("1", "x", "both", 1), ("2", "y", "name-only", 2), ("3", "z", None, 0)}


def test_alternative_keys_label_the_match(make):
    left = make([(1, "a"), (2, "b")], "x int, y string")
    right = make([(1, "b", "r1"), (3, "b", "r2")], "rx int, ry string, text string")
    out = alternative_key_join(left, right, {"x": {"x": "rx"}, "y": {"y": "ry"}}).select("x", "y", "text", "merge_on")
    assert rows(out) == {(1, "a", "r1", "x"), (2, "b", "r1", "y"), (2, "b", "r2", "y")}


def test_case_insensitive_full_join(make):
    out = lookup_ignore_case(make([("Abc",), ("x",)], "a string"), "a", make([("aBC ",), ("y",)], "b string"), "b")
    assert rows(out.select("upper_key", "a", "b")) == {("ABC", "Abc", "aBC "), ("X", "x", None), ("Y", None, "y")}


def test_fill_and_append(make):
    dim = make([("a", "1"), ("b", "2")], "name string, code string")
    out = fill_missing(make([("a", None), ("b", "own"), ("c", None)], "name string, code string"), "code", dim, {"name": "name"}, "code", ["code"])
    assert rows(out) == {("a", "1"), ("b", "own"), ("c", None)}
    added = append_checked(dim, make([("b", "9"), ("d", "4")], "name string, code string"), "name")
    assert rows(added) == {("a", "1", "existing"), ("b", "2", "existing"), ("d", "4", "added"), ("b", "9", "conflict")}


def test_entities_resolve_names_and_codes(make):
    entities = Entities(make(UNITS, UNIT_SCHEMA), make([("Acme", "S3"), ("Beta", "nowhere")], "name string, code string"))
    out = entities.by_name(make([("Acme",), ("Beta",), ("Gamma",)], "company string"), "company", code="code", segment="segment", holding="holding")
    assert rows(out) == {("Acme", "S3", "seg-c", "h2"), ("Beta", "nowhere", "External", "External"), ("Gamma", "External", "External", "External")}
    assert rows(entities.by_code(make([("D",)], "c string"), "c", segment="s", holding="h")) == {("D", "External", "h2")}
