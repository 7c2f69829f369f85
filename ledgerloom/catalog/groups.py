"""Aggregations, subtotals, correlations, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.catalog.registry import num, query, text
from ledgerloom.functions.columns import sum_when
from ledgerloom.operators.correlation import series_correlations, strong
from ledgerloom.operators.dimensions import append_checked
from ledgerloom.operators.grouping import (
    collect_chunks, correlations, describe, exact_quantiles, group_sum, latest_version, subtotals, top_k,
)
from ledgerloom.operators.joins import join_keys
from ledgerloom.operators.reconcile import coverage
from ledgerloom.operators.rules import rule_diff

NULLABLE = """x AS (SELECT nullif(c_mktsegment, 'FURNITURE') AS market, c_nationkey AS nation,
  CASE WHEN c_acctbal > 500 AND c_nationkey <> 4 THEN c_acctbal END AS credit FROM customer)"""


def nullable(t):
    return t.customer.select(
        F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("market"), F.col("c_nationkey").alias("nation"),
        F.when((F.col("c_acctbal") > 500) & (F.col("c_nationkey") != 4), F.col("c_acctbal")).alias("credit"))


@query("group_sum_keep_null", f"""WITH {NULLABLE}
SELECT market, nation, round(coalesce(sum(credit), 0), 2) AS credit FROM x GROUP BY market, nation""")
def keep_null(t):
    return group_sum(nullable(t), ["market", "nation"], ["credit"], "keep").withColumn("credit", num("credit"))


@query("group_sum_drop_null", f"""WITH {NULLABLE}
SELECT market, nation, round(coalesce(sum(credit), 0), 2) AS credit FROM x WHERE market IS NOT NULL GROUP BY market, nation""")
def drop_null(t):
    return group_sum(nullable(t), ["market", "nation"], ["credit"], "drop").withColumn("credit", num("credit"))


@query("group_multi_agg", """
SELECT l_suppkey, l_returnflag, round(sum(l_quantity), 2) AS quantity, round(avg(l_extendedprice), 6) AS price,
  count(*) AS lines, min(l_tax) + 0 AS min_tax, CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) AS last_day
FROM lineitem GROUP BY ALL""")
def multi_agg(t):
    return t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(
        num(F.sum("l_quantity")).alias("quantity"), num(F.avg("l_extendedprice"), 6).alias("price"),
        F.count(F.lit(1)).alias("lines"), (F.min("l_tax") + 0.0).alias("min_tax"),
        text(F.to_date(F.max("l_shipdate"))).alias("last_day"))


@query("group_sql", """
SELECT o_orderpriority AS holding, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS report_day, round(sum(o_totalprice), 2) AS cash
FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= DATE '1998-01-01' GROUP BY ALL ORDER BY report_day, holding""")
def group_sql(t):
    return t.spark.sql("""
        SELECT o_orderpriority AS holding, CAST(CAST(o_orderdate AS DATE) AS STRING) AS report_day,
               round(sum(o_totalprice), 2) AS cash
        FROM {orders}
        WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP_NTZ '1998-01-01 00:00:00'
        GROUP BY o_orderpriority, CAST(o_orderdate AS DATE)
        ORDER BY report_day, holding""", orders=t.orders)


@query("collect_members", """
SELECT l_suppkey, l_returnflag, l_orderkey // 1000 AS chunk_no,
  array_to_string(list_sort(list(DISTINCT l_orderkey)), ',') AS members FROM lineitem GROUP BY ALL""")
def collect_members(t):
    return collect_chunks(t.lineitem, ["l_suppkey", "l_returnflag"], "l_orderkey", 1000).withColumn(
        "members", F.array_join("members", ","))


@query("distinct_members", """
SELECT c_nationkey, array_to_string(list_sort(list(DISTINCT c_mktsegment)), ',') AS markets FROM customer GROUP BY 1""")
def distinct_members(t):
    # distinct values of a label column with few values: the set stays small for any group size
    return t.customer.groupBy("c_nationkey").agg(
        F.array_join(F.array_sort(F.collect_set("c_mktsegment")), ",").alias("markets"))


@query("group_min_max_count", """
SELECT o_orderstatus, o_orderpriority, CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS first_day,
  CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_day, count(o_orderdate) AS n FROM orders GROUP BY ALL""")
def min_max_count(t):
    return t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(
        text(F.to_date(F.min("o_orderdate"))).alias("first_day"), text(F.to_date(F.max("o_orderdate"))).alias("last_day"),
        F.count("o_orderdate").alias("n"))


@query("distinct_counts", """
SELECT p_brand, count(DISTINCT p_name) AS names, count(DISTINCT p_type) AS types,
  count(DISTINCT p_name) = count(DISTINCT p_type) AS same FROM part GROUP BY 1""")
def distinct_counts(t):
    counts = t.part.groupBy("p_brand").agg(
        F.count_distinct("p_name").alias("names"), F.count_distinct("p_type").alias("types"))
    return counts.withColumn("same", F.col("names") == F.col("types"))


@query("quantile_thresholds", """
SELECT l_suppkey, count(*) AS n, round(quantile_cont(l_extendedprice, 0.9), 6) AS q90,
  round(quantile_cont(l_extendedprice, 0.5), 6) AS median FROM lineitem GROUP BY 1""")
def quantile_thresholds(t):
    return exact_quantiles(t.lineitem, ["l_suppkey"], "l_extendedprice", {"q90": 0.9, "median": 0.5}).withColumns(
        {"q90": num("q90", 6), "median": num("median", 6)})


@query("conditional_sum", """
SELECT l_suppkey, round(coalesce(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END), 0), 2) AS amount_ar,
  round(coalesce(sum(CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END), 0), 2) AS amount_ap,
  count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS ar_flag FROM lineitem GROUP BY 1""")
def conditional_sum(t):
    ar = F.col("l_returnflag") == "R"
    return t.lineitem.groupBy("l_suppkey").agg(
        num(sum_when(ar, "l_extendedprice")).alias("amount_ar"),
        num(sum_when(~ar, "l_extendedprice")).alias("amount_ap"),
        F.count_if(ar).alias("ar_flag"))


@query("subtotal_rollup", """
WITH x AS (SELECT r_name AS country, nullif(s_name, 'Supplier#000000001') AS bank, l_extendedprice AS amount, l_quantity AS quantity
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT CASE WHEN grouping(country) = 1 THEN 'Total' ELSE country END AS country,
  CASE WHEN grouping(bank) = 1 THEN 'Total' ELSE bank END AS bank,
  round(sum(amount), 2) AS amount, round(sum(quantity), 2) AS quantity,
  CAST(grouping(country) + grouping(bank) AS INTEGER) AS level FROM x GROUP BY ROLLUP (country, bank)""")
def subtotal_rollup(t):
    per_supplier = t.lineitem.groupBy("l_suppkey").agg(
        F.sum("l_extendedprice").alias("amount"), F.sum("l_quantity").alias("quantity"))
    places = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "s_suppkey", F.col("r_name").alias("country"), F.nullif("s_name", F.lit("Supplier#000000001")).alias("bank"))
    detail = join_keys(per_supplier, places, {"l_suppkey": "s_suppkey"}, "inner", null_safe=False)
    return subtotals(detail, ["country", "bank"], ["amount", "quantity"]).withColumns(
        {"amount": num("amount"), "quantity": num("quantity")})


@query("grand_total", """
SELECT CASE WHEN grouping(o_orderpriority) = 1 THEN 'Total' ELSE o_orderpriority END AS o_orderpriority,
  round(sum(o_totalprice), 2) AS total, CAST(grouping(o_orderpriority) AS INTEGER) AS level
FROM orders GROUP BY GROUPING SETS ((o_orderpriority), ())""")
def grand_total(t):
    return subtotals(t.orders.select("o_orderpriority", F.col("o_totalprice").alias("total")), ["o_orderpriority"],
                     ["total"]).withColumn("total", num("total"))


@query("bool_rollup", """
SELECT o_orderpriority, bool_and(o_totalprice > 1000) AS priced, bool_and(o_orderstatus <> 'P') AS settled
FROM orders GROUP BY 1""")
def bool_rollup(t):
    return t.orders.groupBy("o_orderpriority").agg(
        F.every(F.col("o_totalprice") > 1000).alias("priced"), F.every(F.col("o_orderstatus") != "P").alias("settled"))


@query("latest_then_group", """
WITH x AS (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS newest FROM orders)
SELECT o_custkey, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS report_day,
  round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 6) AS mean
FROM x WHERE o_orderdate = newest GROUP BY ALL""")
def latest_then_group(t):
    rows = t.orders.select("o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    return latest_version(rows, ["o_custkey"], "o_orderdate").groupBy(
        "o_custkey", "o_orderstatus", text(F.to_date("o_orderdate")).alias("report_day"),
    ).agg(num(F.sum("o_totalprice")).alias("total"), num(F.avg("o_totalprice"), 6).alias("mean"))


@query("describe_columns", """
WITH long AS (SELECT 'l_quantity' AS "column", l_quantity AS v FROM lineitem
  UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem UNION ALL SELECT 'l_discount', l_discount FROM lineitem)
SELECT "column", count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, round(min(v), 2) + 0 AS min,
  max(v) AS max, round(quantile_cont(v, 0.25), 6) + 0 AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
  round(quantile_cont(v, 0.75), 6) AS q75 FROM long GROUP BY 1""")
def describe_columns(t):
    return describe(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"]).withColumns(
        {c: num(c, 6) for c in ("mean", "std", "min", "q25", "q50", "q75")})


CORR_PAIRS = [(a, b) for a in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
              for b in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
CORR_SQL = "\nUNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) + 0 AS corr FROM lineitem" for a, b in CORR_PAIRS)


@query("corr_matrix", CORR_SQL)
def corr_matrix(t):
    return correlations(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]).withColumn(
        "corr", num("corr", 6))


STRONG_SQL = "WITH x AS (SELECT l_suppkey, sum(l_extendedprice) AS a, sum(l_extendedprice * (1 - l_discount)) AS b, sum(l_tax) AS c FROM lineitem GROUP BY 1)\n" + \
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{p}' AS col_a, '{q}' AS col_b, round(corr({p}, {q}), 6) AS corr FROM x" for p in "abc" for q in "abc" if p != q
    ) + ") WHERE abs(corr) > 0.87 AND abs(corr) < 1"


@query("corr_strong", STRONG_SQL)
def corr_strong(t):
    x = t.lineitem.groupBy("l_suppkey").agg(
        F.sum("l_extendedprice").alias("a"), F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("b"),
        F.sum("l_tax").alias("c"))
    strong = (F.abs("corr") > 0.87) & (F.abs("corr") < 1)
    return correlations(x, ["a", "b", "c"]).where((F.col("col_a") != F.col("col_b")) & strong).withColumn(
        "corr", num("corr", 6))


@query("corr_by_year", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, a AS col_a, b AS col_b, round(corr(CASE a WHEN 'q' THEN l_quantity ELSE l_extendedprice END,
  CASE b WHEN 'q' THEN l_quantity ELSE l_extendedprice END), 6) AS corr
FROM lineitem, (VALUES ('q', 'q'), ('q', 'p'), ('p', 'q'), ('p', 'p')) v(a, b) GROUP BY ALL""")
def corr_by_year(t):
    x = t.lineitem.select(F.year("l_shipdate").alias("year"), F.col("l_quantity").alias("q"),
                          F.col("l_extendedprice").alias("p"))
    return correlations(x, ["q", "p"], ["year"]).withColumn("corr", num("corr", 6))


def _dimensions(t):
    """Components of all embeddings as series over their vectors, small ones missing."""
    vectors = t.spark.read.parquet(f"{t.folder}/embeddings.parquet")
    cells = vectors.select("vec_id", "label", F.posexplode("embedding").alias("dimension", "component"))
    return cells.where(F.abs("component") >= 0.01)


DIMENSIONS = """d AS (SELECT vec_id, label, CAST(i - 1 AS INTEGER) AS dimension, CAST(embedding[i] AS DOUBLE) AS v
  FROM embeddings, unnest(range(1, len(embedding) + 1)) r(i) WHERE abs(embedding[i]) >= CAST(0.01 AS FLOAT))"""


@query("corr_dimensions", "WITH " + DIMENSIONS + """
SELECT a.dimension AS series_a, b.dimension AS series_b, count(*) AS n, round(corr(a.v, b.v), 6) + 0 AS corr
FROM d a JOIN d b ON a.vec_id = b.vec_id AND a.dimension <= b.dimension GROUP BY ALL""")
def corr_dimensions(t):
    """All pairs of dimensions, pairwise complete, in blocks of 24 series."""
    found = series_correlations(_dimensions(t), "dimension", ["vec_id"], "component", block=24)
    return found.withColumn("corr", num("corr", 6))


@query("corr_dimensions_by_label", "WITH " + DIMENSIONS + """, c AS (
SELECT a.label, a.dimension AS series_a, b.dimension AS series_b, count(*) AS n, corr(a.v, b.v) AS corr
FROM d a JOIN d b ON a.vec_id = b.vec_id AND a.dimension < b.dimension GROUP BY ALL)
SELECT label, series_a, series_b, n, round(corr, 6) AS corr FROM c WHERE abs(corr) > 0.3 AND abs(corr) < 1""")
def corr_dimensions_by_label(t):
    found = series_correlations(_dimensions(t), "dimension", ["vec_id"], "component", ["label"])
    return strong(found, 0.3).withColumn("corr", num("corr", 6))


@query("corr_suppliers", """
WITH x AS (SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, avg(l_extendedprice) AS price FROM lineitem GROUP BY ALL),
c AS (SELECT a.l_suppkey AS series_a, b.l_suppkey AS series_b, count(*) AS n, corr(a.price, b.price) AS corr
  FROM x a JOIN x b ON a.month = b.month AND a.l_suppkey < b.l_suppkey GROUP BY ALL)
SELECT series_a, series_b, n, round(corr, 6) AS corr FROM c WHERE n >= 12 AND abs(corr) > 0.25 AND abs(corr) < 1""")
def corr_suppliers(t):
    """Suppliers whose mean monthly prices move together, out of all pairs of suppliers."""
    lines = t.lineitem.select("l_suppkey", F.trunc(F.to_date("l_shipdate"), "month").alias("month"), "l_extendedprice")
    found = series_correlations(lines, "l_suppkey", ["month"], "l_extendedprice", least=12, low=0.25)
    return strong(found, 0.25).withColumn("corr", num("corr", 6))


@query("ordered_report", """
WITH x AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL)
SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY total DESC, o_orderpriority) AS INTEGER) AS rank
FROM x ORDER BY year, rank""")
def ordered_report(t):
    # ranks are given to the summed report (a few lines per year), never to the raw rows
    report = t.orders.groupBy(F.year("o_orderdate").alias("year"), "o_orderpriority").agg(
        num(F.sum("o_totalprice")).alias("total"))
    line = Window.partitionBy("year").orderBy(F.desc_nulls_last("total"), F.asc("o_orderpriority"))
    return report.withColumn("rank", F.row_number().over(line)).orderBy("year", "rank")


@query("top_k_other", """
WITH x AS (SELECT l_partkey, sum(l_extendedprice) AS money FROM lineitem GROUP BY 1),
top AS (SELECT l_partkey FROM x ORDER BY money DESC, l_partkey LIMIT 10)
SELECT coalesce(CAST(top.l_partkey AS VARCHAR), 'other') AS label, count(*) AS items, round(sum(money), 2) AS money
FROM x LEFT JOIN top USING (l_partkey) GROUP BY 1""")
def top_k_other(t):
    x = t.lineitem.groupBy("l_partkey").agg(F.sum("l_extendedprice").alias("money"))
    top = x.orderBy(F.desc("money"), "l_partkey").limit(10).select(F.col("l_partkey").alias("top_key"))
    label = F.coalesce(F.col("top_key").cast("string"), F.lit("other"))
    return x.join(top, F.col("l_partkey") == F.col("top_key"), "left").groupBy(label.alias("label")).agg(
        F.count(F.lit(1)).alias("items"), num(F.sum("money")).alias("money"))


@query("top_n", """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def top_n(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("union_all_by_name", """
SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier""")
def union_by_name(t):
    return t.customer.selectExpr("c_custkey AS id", "c_name AS name").unionByName(
        t.supplier.selectExpr("s_name AS name", "s_suppkey AS id"))


@query("key_intersect", """
SELECT l_partkey AS id FROM lineitem INTERSECT SELECT o_custkey FROM orders""")
def key_intersect(t):
    return t.lineitem.select(F.col("l_partkey").alias("id")).intersect(t.orders.select(F.col("o_custkey").alias("id")))


@query("key_except_both", """
WITH a AS (SELECT DISTINCT l_orderkey AS id FROM lineitem), b AS (SELECT DISTINCT o_orderkey AS id FROM orders WHERE o_totalprice < 450000)
SELECT id, 'only_old' AS side FROM (SELECT id FROM a EXCEPT SELECT id FROM b)
UNION ALL SELECT id, 'only_new' FROM (SELECT id FROM b EXCEPT SELECT id FROM a)""")
def key_except_both(t):
    return rule_diff(t.lineitem.select(F.col("l_orderkey").alias("id")),
                     t.orders.where(F.col("o_totalprice") < 450000).select(F.col("o_orderkey").alias("id")), ["id"])


@query("key_coverage", """
SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL THEN 'right_only' WHEN b.id IS NULL THEN 'left_only' ELSE 'both' END AS side
FROM (SELECT DISTINCT c_custkey AS id FROM customer) a FULL JOIN
  (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_totalprice > 300000) b ON a.id = b.id""")
def key_coverage(t):
    return coverage(t.customer.select(F.col("c_custkey").alias("id")),
                    t.orders.where(F.col("o_totalprice") > 300000).select(F.col("o_custkey").alias("id")), ["id"])


@query("dim_append_checked", """
WITH dim AS (SELECT s_name AS name, CAST(s_suppkey AS VARCHAR) AS code FROM supplier),
fresh AS (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN replace(c_name, 'Customer', 'Supplier') ELSE c_name END AS name,
  'C' || c_custkey AS code FROM customer)
SELECT name, code, 'existing' AS status FROM dim
UNION ALL SELECT name, code, CASE WHEN name IN (SELECT name FROM dim) THEN 'conflict' ELSE 'added' END FROM fresh""")
def dim_append_checked(t):
    dim = t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").cast("string").alias("code"))
    name = F.when(F.col("c_mktsegment") == "BUILDING", F.regexp_replace("c_name", "Customer", "Supplier")).otherwise(F.col("c_name"))
    fresh = t.customer.select(name.alias("name"), F.concat(F.lit("C"), F.col("c_custkey")).alias("code"))
    return append_checked(dim, fresh, "name")
