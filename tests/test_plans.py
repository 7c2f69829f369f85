"""What plans must not contain, what must reach the scan, and results without broadcasts."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.catalog import oracles, queries
from ledgerloom.operators.dimensions import lookup_multikey
from ledgerloom.operators.fx import convert
from ledgerloom.operators.grouping import exact_quantiles, latest_version
from ledgerloom.operators.reconcile import reconcile
from ledgerloom.operators.series import forward_fill
from tests.oracle import compare, connect

QUERIES = queries()
# Windows are allowed over tables that a date, a row range, a range partition or a sketch keeps small per key.
WINDOWED = {
    "version_pairs", "ordered_report", "pct_change", "rolling_mean", "rolling_full_window", "volatility_horizons", "volatility_strict",
    "forward_fill", "backward_fill", "quantile_thresholds", "describe_columns", "iqr_filter", "report_triggers", "report_price_series",
    "report_price_volatility", "report_volatility", "report_balance_monitor", "recon_inventory_statistics", "report_market_shares",
    "report_bank_limits_matrix", "report_balance_blocks", "rank_rows", "running_share", "rank_distinct",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_python_or_global_window(name, spark, small):
    text = plan(QUERIES[name](spark, small))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|EvalPython|InPandas", text)
    windows = re.findall(r"Window \[.*?\], \[(.*?)\]", text)
    assert all(w.strip() for w in windows), "window without partition"
    if name not in WINDOWED:
        assert " Window [" not in f" {text}"


def test_filters_and_columns_reach_the_scan(spark, small):
    text = plan(QUERIES["trailing_period"](spark, small))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>", text)
    text = plan(QUERIES["filter_in_list"](spark, small))
    assert "In(c_mktsegment" in text


def test_rules_and_buckets_need_no_shuffle(spark, small):
    for name in ("classify_prefix", "maturity_bucket", "value_remap", "condition_table", "second_best", "two_leg_melt", "stack_halves"):
        assert "Exchange" not in plan(QUERIES[name](spark, small)), name


@pytest.mark.parametrize("name", [
    "report_liquidity", "report_counterclaims", "recon_arap_companies", "entity_lookup_multikey", "fx_convert_by_date", "classify_rules",
    "latest_version", "bond_netting", "quantile_thresholds", "mirror_pairs", "two_pass_lookup", "filter_or_keys", "forward_fill",
])
def test_results_do_not_depend_on_broadcasts(name, spark, small):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result, _ = compare(spark, connect(small), name, QUERIES[name], oracles()[name], small)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert result == "ok"


@pytest.fixture(scope="module")
def skewed(spark):
    """60,000 rows of which a third share one key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    return spark.range(60_000).select(key.alias("k"), F.col("id").alias("row_no"), (F.col("id") % 977).cast("double").alias("v"))


def test_hot_key_results(skewed, spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert latest_version(skewed, ["k"], "row_no").where("k = 0").count() == 1
        hot = exact_quantiles(skewed, ["k"], "v", {"m": 0.5}, accuracy=200).where("k = 0").first()
        assert hot.n == 20_000 and hot.m == skewed.where("k = 0").agg(F.median("v")).first()[0]
        both = reconcile(skewed.withColumnRenamed("v", "a"), skewed.withColumnRenamed("v", "b"), ["k"], "a", "b")
        assert both.where("differs").count() == 0 and both.count() == 40_001
        filled = forward_fill(skewed.withColumn("v", F.when(F.col("row_no") % 300 == 0, F.col("v"))), ["k"], "row_no", ["v"], chunk=1000)
        assert filled.where("k = 0 and v is null").count() == 0 and filled.count() == 60_000
        dim = skewed.select(F.col("k").cast("string").alias("id"), F.lit("seg").alias("segment")).distinct()
        assert lookup_multikey(skewed.withColumn("c", F.col("k").cast("string")), "c", dim, ["id"], "segment", ["id"], "s").where("s = 'seg'").count() == 60_000
        quotes = spark.sql("select date'2024-01-01' period, 'EUR' ccy_from, 'USD' ccy_to, 2.0D rate")
        sold = skewed.withColumns({"ccy": F.lit("EUR"), "day": F.lit("2024-01-01").cast("date")})
        assert convert(sold, quotes, "USD", "ccy", "v", "day").where("v_in_USD = 2 * v").count() == 60_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["latest_snapshot", "latest_snapshot_as_of", "anti_missing", "anti_new", "qc_missing_new", "trailing_period"])
def test_day_filters_reach_the_scan(spark, small, name):
    column = "o_orderdate" if name == "trailing_period" else "ts"
    plan = plan_of(queries()[name](spark, small))
    assert f"GreaterThanOrEqual({column}," in plan and f"LessThan({column}," in plan


@pytest.mark.parametrize("name", ["classify_rules", "classify_rules_full", "effective_params", "fx_convert_asof", "fx_convert_by_date", "lookup_compound"])
def test_small_tables_do_not_shuffle_facts(spark, small, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(100 << 10))  # under the size of the facts here
    try:
        assert "SortMergeJoin" not in plan_of(queries()[name](spark, small))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lines_are_shuffled_once_for_flows(spark, small):
    from ledgerloom.catalog.joins import flows
    from ledgerloom.sources.tables import Tables

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(50 << 10))  # suppliers and nations fit, nothing else
    try:
        lines = plan_of(flows(Tables(spark, small))).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not [x for x in lines if "Exchange hashpartitioning(l_suppkey" in x or "Exchange hashpartitioning(o_custkey" in x and "l_suppkey" in x]
    assert sum("Exchange hashpartitioning(l_orderkey" in x for x in lines) == 1
