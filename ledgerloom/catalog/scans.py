"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.inputs import BALANCES, balances, ctes
from ledgerloom.catalog.registry import num, query, text
from ledgerloom.session import shared_dir
from ledgerloom.sources import (
    append_history, latest_snapshot, read_checked, read_delimited, read_files, snapshot_pairs, trailing_period, union_sources,
    write_by, write_delimited, write_named,
)
from ledgerloom.sources.publish import current, publish, publish_dimension, publish_history, read_history, read_published


@query("scan_table", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day
FROM orders""")
def scan_table(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                           text(F.to_date("o_orderdate")).alias("order_day"))


@query("scan_csv_dim", """SELECT n_name, n_regionkey FROM nation""")
def scan_csv_dim(t):
    path = write_delimited(t.nation, shared_dir(t.spark, "nation"), sep="\t")
    return read_delimited(t.spark, path, "n_nationkey int, n_name string, n_regionkey int",
                          ["n_name", "n_regionkey"], sep="\t")


@query("multi_source_union", """
SELECT 'customer' AS source, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment
FROM customer
UNION ALL SELECT 'supplier', s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def multi_source_union(t):
    customers = t.customer.selectExpr("c_name AS name", "c_nationkey AS nationkey", "c_acctbal AS acctbal",
                                      "c_mktsegment AS segment")
    suppliers = t.supplier.selectExpr("s_acctbal AS acctbal", "s_name AS name", "s_nationkey AS nationkey")
    return union_sources({"customer": customers, "supplier": suppliers})


@query("files_with_provenance", """
SELECT n_nationkey AS key, n_name AS name, 'nation.parquet' AS source_file FROM nation
UNION ALL SELECT s_suppkey, s_name, 'supplier.parquet' FROM supplier""")
def files_with_provenance(t):
    df = read_files(t.spark, [f"{t.folder}/{n}.parquet" for n in ("nation", "supplier")])
    return df.select(F.coalesce(F.col("n_nationkey").cast("bigint"), "s_suppkey").alias("key"), F.coalesce("n_name", "s_name").alias("name"),
                     "source_file")


@query("latest_snapshot", ctes(BALANCES) + """
SELECT account, status, balance, CAST(report_day AS VARCHAR) AS report_day FROM balances
WHERE report_day = (SELECT max(report_day) FROM balances)""")
def latest(t):
    return latest_snapshot(balances(t), "ts").select(
        "account", "status", "balance", text("report_day").alias("report_day"))


@query("latest_snapshot_as_of", ctes(BALANCES) + """
SELECT account, status, balance, CAST(report_day AS VARCHAR) AS report_day FROM balances
WHERE report_day = (SELECT max(report_day) FROM balances WHERE report_day <= DATE '2024-01-15')""")
def latest_as_of(t):
    return latest_snapshot(balances(t), "ts", "2024-01-15").select(
        "account", "status", "balance", text("report_day").alias("report_day"))


@query("trailing_period", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderdate >= DATE '1998-03-30' AND o_orderdate <= DATE '1998-06-30'""")
def trailing(t):
    return trailing_period(t.orders, "o_orderdate", "1998-06-30", months=3).select("o_orderkey", "o_totalprice")


@query("partitioned_sink", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY ALL""")
def partitioned_sink(t):
    path = shared_dir(t.spark, "orders")
    write_by(t.orders.select("o_orderstatus", "o_orderpriority", "o_totalprice"), path, ["o_orderstatus"])
    return t.spark.read.parquet(path).groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), num(F.sum("o_totalprice")).alias("total"))


@query("named_results", """
SELECT 'orders' AS name, o_orderstatus AS key, count(*) AS n FROM orders GROUP BY ALL
UNION ALL SELECT 'lines', l_returnflag, count(*) FROM lineitem GROUP BY ALL""")
def named_results(t):
    paths = write_named({
        "orders": t.orders.groupBy(F.col("o_orderstatus").alias("key")).agg(F.count(F.lit(1)).alias("n")),
        "lines": t.lineitem.groupBy(F.col("l_returnflag").alias("key")).agg(F.count(F.lit(1)).alias("n")),
    }, shared_dir(t.spark, "report"))
    return union_sources({name: t.spark.read.parquet(p) for name, p in paths.items()}, "name")


@query("append_history", """
SELECT o_orderstatus, round(sum(o_totalprice), 2) AS total, '2024-01-01' AS run_date FROM orders GROUP BY ALL
UNION ALL SELECT l_returnflag, round(sum(l_extendedprice), 2), '2024-01-02' FROM lineitem GROUP BY ALL""")
def history(t):
    path = shared_dir(t.spark, "history")
    append_history(t.orders.groupBy("o_orderstatus").agg(F.sum("o_totalprice").alias("total")), path, "2024-01-01")
    append_history(t.lineitem.groupBy(F.col("l_returnflag").alias("o_orderstatus")).agg(
        F.sum("l_extendedprice").alias("total")), path, "2024-01-02")
    return t.spark.read.parquet(path).select("o_orderstatus", num("total").alias("total"),
                                             text("run_date").alias("run_date"))


@query("published_history", """
SELECT o_orderstatus, round(sum(o_totalprice), 2) AS total, '2024-01-31' AS run_date FROM orders GROUP BY ALL
UNION ALL SELECT l_returnflag, round(sum(l_extendedprice), 2), '2024-02-29' FROM lineitem GROUP BY ALL""")
def published_history(t):
    """A run summary that is published twice for one date, the second time with other rows."""
    path = shared_dir(t.spark, "history")
    lines = t.lineitem.groupBy(F.col("l_returnflag").alias("o_orderstatus")).agg(F.sum("l_extendedprice").alias("total"))
    publish_history(t.orders.groupBy("o_orderstatus").agg(F.sum("o_totalprice").alias("total")), path, "2024-01-31")
    publish_history(lines.withColumn("total", F.col("total") + 1), path, "2024-02-29")
    publish_history(lines, path, "2024-02-29")
    return read_history(t.spark, path).select("o_orderstatus", num("total").alias("total"), text("run_date").alias("run_date"))


@query("published_results", """
SELECT 'orders' AS name, o_orderstatus AS key, count(*) AS n FROM orders GROUP BY ALL
UNION ALL SELECT 'lines', l_returnflag, count(*) FROM lineitem WHERE l_quantity > 10 GROUP BY ALL
UNION ALL SELECT 'customers', c_mktsegment, count(*) FROM customer GROUP BY ALL""")
def published_results(t):
    """Results published together, one of them replaced and one added by a later run."""
    path = shared_dir(t.spark, "published")

    def count(df, key):
        return df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))

    publish(t.spark, path, {"orders": count(t.orders, "o_orderstatus"), "lines": count(t.lineitem, "l_returnflag")})
    publish(t.spark, path, {"lines": count(t.lineitem.where("l_quantity > 10"), "l_returnflag"), "customers": count(t.customer, "c_mktsegment")})
    version = current(t.spark, path)
    return union_sources({name: read_published(t.spark, path, name, version) for name in version.results}, "name")


@query("published_dimension", """
WITH dim AS (SELECT s_name AS name, CAST(s_suppkey AS VARCHAR) AS code FROM supplier),
fresh AS (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN replace(c_name, 'Customer', 'Supplier') ELSE c_name END AS name, 'C' || c_custkey AS code FROM customer)
SELECT name, code, 'dimension' AS place FROM dim UNION ALL SELECT name, code, 'dimension' FROM fresh WHERE name NOT IN (SELECT name FROM dim)
UNION ALL SELECT name, code, 'rejected' FROM fresh WHERE name IN (SELECT name FROM dim)""")
def published_dimension(t):
    """A dimension that is published, extended with checks before and after, and extended again with the same rows."""
    path = shared_dir(t.spark, "dimension")
    dim = t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").cast("string").alias("code"))
    name = F.when(F.col("c_mktsegment") == "BUILDING", F.regexp_replace("c_name", "Customer", "Supplier")).otherwise(F.col("c_name"))
    fresh = t.customer.select(name.alias("name"), F.concat(F.lit("C"), F.col("c_custkey")).alias("code"))
    publish_dimension(dim, path, "companies", "name")
    _, rejected = publish_dimension(fresh, path, "companies", "name")
    publish_dimension(fresh, path, "companies", "name")  # a repeated run adds nothing
    whole = read_published(t.spark, path, "companies")
    return whole.withColumn("place", F.lit("dimension")).unionByName(rejected.withColumn("place", F.lit("rejected")))


LANDED = """CASE o_orderkey % 50 WHEN 7 THEN CAST(o_orderkey AS VARCHAR) WHEN 8 THEN o_orderkey || '|' || o_orderstatus || '|1|2|3'
  WHEN 9 THEN o_orderkey || '|' || o_orderstatus || '|n/a' END"""


def _landed(t):
    """Order lines as landed text: most are whole, with quoted separators; some are short, long or hold a text for a number."""
    path = shared_dir(t.spark, "landed")
    key, status, part = F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), F.col("o_orderkey") % 50
    whole = F.concat(key, F.lit('|"'), status, F.lit('|""x"""|'), F.col("o_custkey").cast("string"))
    line = F.when(part == 7, key).when(part == 8, F.concat(key, F.lit("|"), status, F.lit("|1|2|3"))).when(
        part == 9, F.concat(key, F.lit("|"), status, F.lit("|n/a"))).otherwise(whole)
    t.orders.select(line.alias("value")).write.text(path)
    return path


@query("landed_good", """
SELECT o_orderkey, o_orderstatus || '|"x"' AS status, o_custkey FROM orders WHERE o_orderkey % 50 NOT IN (7, 8, 9)""")
def landed_good(t):
    """The whole lines of landed text."""
    good, _ = read_checked(t.spark, _landed(t), "o_orderkey bigint, status string, o_custkey bigint", sep="|", header=False, options={"escape": '"'})
    return good.drop("source_file")


@query("landed_rejected", "SELECT " + LANDED + """ AS record, CASE o_orderkey % 50 WHEN 9 THEN 'type of o_custkey' ELSE 'number of fields' END AS problem
FROM orders WHERE o_orderkey % 50 IN (7, 8, 9)""")
def landed_rejected(t):
    """Lines that do not fit, with what is wrong; with the good ones they are all lines."""
    _, bad = read_checked(t.spark, _landed(t), "o_orderkey bigint, status string, o_custkey bigint", sep="|", header=False, options={"escape": '"'})
    return bad.select("record", "problem")


@query("csv_roundtrip", """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part""")
def csv_roundtrip(t):
    path = write_delimited(t.part, shared_dir(t.spark, "part"))
    return read_delimited(
        t.spark, path,
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")


@query("snapshot_pairs", ctes(BALANCES) + """
SELECT account, status, CAST(min(report_day) AS VARCHAR) AS first_day, CAST(max(report_day) AS VARCHAR) AS last_day,
  count(DISTINCT report_day) AS n_days, count(DISTINCT report_day) > 1 AS has_pair
FROM balances GROUP BY account, status""")
def pairs(t):
    return snapshot_pairs(balances(t), ["account", "status"], "report_day").withColumns(
        {c: text(c) for c in ("first_day", "last_day")})
