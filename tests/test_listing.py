from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.quality import profile
from ledgerloom.plans.monitoring import compare_outputs
from ledgerloom.session import shared_dir
from ledgerloom.sources import listing as L

D = datetime.date


@pytest.fixture(scope="module")
def outputs(spark):
    """Outputs of runs as folders and single names, some paired, some not, of three schemas that partly contradict."""
    folder = shared_dir(spark, "outputs")

    def put(name, ddl, rows):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{folder}/{name}")

    put("2024-01-31_debt_all", "k int, v double, note string", [(1, 2.0, "a"), (2, None, None), (0, 0.0, "0")])
    put("2024-02-29_debt_all", "k int, v double, note string", [(1, 2.0, "a"), (2, 9.0, None), (3, 0.0, "7")])
    put("2023-12-31_debt_all", "k int, v double, note string", [(1, 2.0, "a")])
    put("2024-01-31_cash", "k bigint, v double", [(1, 1.0)])
    put("2024-02-29_cash", "k int, v double", [(1, 1.1)])
    put("2024-02-29_only", "z string", [("x",)])
    put("2024-01-31_a b+c%d", "k int", [(1,)])
    put("undated", "k int", [(1,)])
    put("2024-01-31_empty", "k int, q double", [])
    put("2024-02-29_empty", "k int, q double", [(0, 0.0)])
    return folder


def test_listing_and_pairs(spark, outputs):
    files = L.list_outputs(spark, outputs)
    assert {(r.output, r.day, r.name) for r in files.collect()} >= {
        ("2024-01-31_debt_all", D(2024, 1, 31), "debt all"), ("undated", None, "undated"), ("2024-01-31_a b+c%d", D(2024, 1, 31), "a b+c%d")}
    pairs = {r.name: (r.n_days, r.old_output, r.new_output, r.paired) for r in L.pair_outputs(files).collect()}
    assert pairs == {"debt all": (3, "2024-01-31_debt_all", "2024-02-29_debt_all", True), "cash": (2, "2024-01-31_cash", "2024-02-29_cash", True),
                     "only": (1, None, "2024-02-29_only", False), "a b+c%d": (1, None, "2024-01-31_a b+c%d", False),
                     "empty": (2, "2024-01-31_empty", "2024-02-29_empty", True)}


def test_all_ordered_pairs_of_days(spark, outputs):
    files = L.list_outputs(spark, outputs).where("name = 'debt all'")
    days = [D(2023, 12, 31), D(2024, 1, 31), D(2024, 2, 29)]
    assert {(r.old_day, r.new_day) for r in L.day_pairs(files).collect()} == {(days[0], days[1]), (days[0], days[2]), (days[1], days[2])}
    assert {(r.old_day, r.new_day) for r in L.day_pairs(files, 30).collect()} == {(days[1], days[2])}


def test_listing_reads_no_content(spark, outputs):
    plan = L.list_outputs(spark, outputs)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_profiles_equal_those_of_each_output(spark, outputs):
    files = L.list_outputs(spark, outputs)
    got = {(r.output, r.column): (r.type, r.n_columns, r.nulls, r["sum"], r.rows, r.zero_rows) for r in L.profile_outputs(spark, files).collect()}
    want = {}
    for name in {r.output for r in files.select("output").collect()}:
        for r in profile(spark.read.parquet(f"{outputs}/{name}")).collect():
            want[name, r["column"]] = (r.type, r.n_columns, r.nulls, r["sum"], r.rows, r.zero_rows)
    assert got == want


def test_scans_do_not_grow_with_outputs(spark):
    folder = shared_dir(spark, "many")
    spark.range(600).select((F.col("id") % 120).alias("n"), F.col("id").alias("v")).select(
        F.concat(F.when(F.col("n") % 2 == 0, "2024-01-01").otherwise("2024-01-02"), F.lit("_x"), F.floor(F.col("n") / 2)).alias("output"), "v",
    ).repartition(1).write.partitionBy("output").parquet(folder)
    files = L.list_outputs(spark, folder)
    profiles = L.profile_outputs(spark, files)
    plan = profiles._jdf.queryExecution().analyzed().toString()
    assert plan.count("Relation [v#") == 1 and profiles.count() == 120
    assert L.pair_outputs(files).where("paired").count() == 60


def test_compare(spark, outputs):
    files = L.list_outputs(spark, outputs)
    found = compare_outputs(L.profile_outputs(spark, files), L.pair_outputs(files).where("paired"))
    problems = {r.name: r for r in found["problems"].collect()}
    assert set(problems) == {"debt all", "cash", "empty"}
    assert not problems["cash"].type_equal and problems["cash"].sum_equal and problems["cash"].n_columns_equal
    assert not problems["debt all"].sum_equal and not problems["debt all"].zero_rows_equal and problems["debt all"].rows_equal
    assert not problems["empty"].rows_equal


def test_empty_listing(spark, outputs):
    files = L.list_outputs(spark, outputs).where("name = 'nothing'")
    assert L.profile_outputs(spark, files).count() == 0 and L.pair_outputs(files).count() == 0
    rows, conflicts, rejected = L.read_reconciled(spark, files)
    assert rows.count() == conflicts.count() == rejected.count() == 0


def test_files_with_differing_types(spark):
    folder = shared_dir(spark, "types")
    for i, (ddl, rows) in enumerate([("k int, a int, b string", [(1, 5, "x")]), ("k bigint, a double", [(2 ** 40, 1.5)]), ("a string, k int, c date", [("7", 3, D(2024, 1, 2)), ("n/a", 4, None)]),
                                     ("k smallint, a tinyint", [(None, 1)])]):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{folder}/{i}")
    files = L.list_outputs(spark, folder)
    rows, conflicts, rejected = L.read_reconciled(spark, files)
    assert dict(rows.drop("source_file", "source_row").dtypes) == {"k": "bigint", "a": "string", "b": "string", "c": "date"}
    assert {(r.k, r.a, r.b, r.c) for r in rows.collect()} == {
        (1, "5", "x", None), (2 ** 40, "1.5", None, None), (3, "7", None, D(2024, 1, 2)), (4, "n/a", None, None), (None, "1", None, None)}
    assert {(r.column, r.type, r.files, r.common) for r in conflicts.collect()} == {
        ("k", "int", 2, "bigint"), ("k", "bigint", 1, "bigint"), ("k", "smallint", 1, "bigint"),
        ("a", "int", 1, "string"), ("a", "double", 1, "string"), ("a", "string", 1, "string"), ("a", "tinyint", 1, "string")}
    assert rejected.count() == 0
    rows, _, rejected = L.read_reconciled(spark, files, {"a": "double", "k": "int"})
    assert {(r.k, r.a) for r in rows.collect()} == {(1, 5.0), (None, 1.5), (3, 7.0), (4, None), (None, 1.0)}
    assert {(r.column, r.value, r.source_row) for r in rejected.collect()} == {("a", "n/a", 1), ("k", str(2 ** 40), 0)}


def test_common_types():
    assert L.common_type(["int"]) == "int" and L.common_type(["int", "bigint", "tinyint"]) == "bigint"
    assert L.common_type(["int", "float"]) == "double" and L.common_type(["decimal(10,2)", "double"]) == "double"
    assert L.common_type(["date", "timestamp_ntz"]) == "timestamp_ntz" and L.common_type(["date", "int"]) == "string"
