from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.session import shared_dir
from ledgerloom.sources import publish as P
from ledgerloom.sources.sinks import append_history
from ledgerloom.sources.tables import read_checked
from tests.conftest import rows


def test_all_results_appear_at_once_or_not_at_all(spark, make):
    path = shared_dir(spark, "p")
    one = make([(1,)], "a int")
    assert P.current(spark, path) == P.Version(0, 0, {})
    P.publish(spark, path, {"x": one, "y": one})
    broken = one.select(F.raise_error(F.lit("stop")).cast("int").alias("a"))
    with pytest.raises(Exception, match="stop"):
        P.publish(spark, path, {"x": make([(2,)], "a int"), "y": broken})
    assert P.current(spark, path).number == 1 and rows(P.read_published(spark, path, "x")) == {(1,)}
    P.publish(spark, path, {"x": make([(2,)], "a int")})
    assert rows(P.read_published(spark, path, "x")) == {(2,)} and rows(P.read_published(spark, path, "y")) == {(1,)}
    P.publish(spark, path, {"z": one}, keep=False)
    assert set(P.current(spark, path).results) == {"z"}


def test_the_second_of_two_writers_is_refused(spark, make):
    path = shared_dir(spark, "p")
    P.publish(spark, path, {"x": make([(1,)], "a int")})
    base = P.current(spark, path)
    P.publish(spark, path, {"x": make([(2,)], "a int")}, base)
    with pytest.raises(P.Refused):
        P.publish(spark, path, {"x": make([(3,)], "a int")}, base)
    assert rows(P.read_published(spark, path, "x")) == {(2,)}


def test_a_version_that_was_not_written_whole_is_passed_over(spark, make):
    path = shared_dir(spark, "p")
    P.publish(spark, path, {"x": make([(1,)], "a int")})
    system, place = P._file_system(spark, f"{path}/versions/{2:012d}.json")
    out = system.create(place, False)
    out.write(bytearray(b'{"results": {"x": '))
    out.close()
    assert P.current(spark, path).number == 1 and P.current(spark, path).last == 2
    P.publish(spark, path, {"y": make([(5,)], "a int")})
    assert P.current(spark, path).number == 3 and rows(P.read_published(spark, path, "x")) == {(1,)}


def test_a_repeated_run_replaces_its_date(spark, make):
    path = shared_dir(spark, "h")
    assert P.read_history(spark, path).count() == 0
    P.publish_history(make([("a", 1)], "k string, v int"), path, "2024-01-31")
    for v in (7, 8):
        P.publish_history(make([("a", v), ("b", v)], "k string, v int"), path, "2024-02-29")
    got = P.read_history(spark, path).select("k", "v", F.col("run_date").cast("string"))
    assert rows(got) == {("a", 1, "2024-01-31"), ("a", 8, "2024-02-29"), ("b", 8, "2024-02-29")}
    plain = shared_dir(spark, "plain")
    for v in (1, 2):
        append_history(make([(v,)], "v int"), plain, "2024-01-31")
    append_history(make([(3,)], "v int"), plain, "2024-02-29")
    assert rows(spark.read.parquet(plain).select("v", F.col("run_date").cast("string"))) == {(2, "2024-01-31"), (3, "2024-02-29")}


def test_a_dimension_is_checked_before_and_after(spark, make):
    path = shared_dir(spark, "d")
    schema = "name string, code int"
    P.publish_dimension(make([("a", 1), ("b", 2)], schema), path, "dim", "name")
    _, rejected = P.publish_dimension(make([("b", 9), ("c", 3)], schema), path, "dim", "name")
    assert rows(rejected) == {("b", 9)}
    for bad in ([("d", 4), ("d", 5)], [(None, 6)]):
        with pytest.raises(P.Refused):
            P.publish_dimension(make(bad, schema), path, "dim", "name")
    P.publish_dimension(make([("b", 9), ("c", 3)], schema), path, "dim", "name")
    assert rows(P.read_published(spark, path, "dim")) == {("a", 1), ("b", 2), ("c", 3)}


def test_no_line_of_a_file_vanishes(spark, tmp_path):
    lines = ["id,name,amount", '1,"a, ""b""",1.5', "2,short", "3,long,1,2", "x,mistyped,1", "4,mistyped,y", "5,,", '6,"quoted ""twice""",2', "", "7,z,3"]
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    good, bad = read_checked(spark, str(tmp_path), "id int, name string, amount double", options={"escape": '"'})
    assert rows(good) == {(1, 'a, "b"', 1.5, "in.csv"), (5, None, None, "in.csv"), (6, 'quoted "twice"', 2.0, "in.csv"), (7, "z", 3.0, "in.csv")}
    assert {(r.record, r.problem) for r in bad.collect()} == {("2,short", "number of fields"), ("3,long,1,2", "number of fields"),
                                                              ("x,mistyped,1", "type of id"), ("4,mistyped,y", "type of amount")}
    assert good.count() + bad.count() == len([x for x in lines[1:] if x])
