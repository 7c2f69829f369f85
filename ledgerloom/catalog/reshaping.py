"""Pivots, melts, transposes and matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.inputs import PRIORITIES, REGIONS
from ledgerloom.catalog.registry import num, query
from ledgerloom.operators.grouping import latest_version
from ledgerloom.operators.joins import join_keys
from ledgerloom.operators.reshape import (
    exposure_matrix, melt, melt_pairs, ordered_pivot, pivot_sum, stack_halves, transpose,
)
from ledgerloom.operators.treasury import legs


@query("pivot_sum", """
SELECT l_suppkey, round(sum(l_extendedprice) FILTER (l_returnflag = 'A'), 2) AS "A",
  round(sum(l_extendedprice) FILTER (l_returnflag = 'N'), 2) AS "N",
  round(sum(l_extendedprice) FILTER (l_returnflag = 'R'), 2) AS "R" FROM lineitem GROUP BY 1""")
def pivot_sum_(t):
    return pivot_sum(t.lineitem, ["l_suppkey"], "l_returnflag", ["A", "N", "R"],
                     "l_extendedprice").withColumns({c: num(c) for c in "ANR"})


AGENCIES = ("1-URGENT", "2-HIGH", "3-MEDIUM")


@query("rating_pivot", """
WITH x AS (SELECT o_custkey, o_orderpriority, o_orderstatus, o_totalprice, o_orderkey FROM orders
  WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
  QUALIFY o_orderdate = max(o_orderdate) OVER (PARTITION BY o_custkey, o_orderpriority)),
f AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) = 1)
SELECT o_custkey, """ + ", ".join(
    f"""max(o_orderstatus) FILTER (o_orderpriority = '{a}') AS "{a}_rating", max(o_totalprice) FILTER (o_orderpriority = '{a}') AS "{a}_value\""""
    for a in AGENCIES) + " FROM f GROUP BY 1")
def rating_pivot(t):
    rows = t.orders.where(F.col("o_orderpriority").isin(*AGENCIES))
    newest = latest_version(rows, ["o_custkey", "o_orderpriority"], "o_orderdate")
    return newest.groupBy("o_custkey").pivot("o_orderpriority", list(AGENCIES)).agg(
        F.min_by("o_orderstatus", "o_orderkey").alias("rating"), F.min_by("o_totalprice", "o_orderkey").alias("value"))


@query("melt", """
SELECT p_partkey, 'p_size' AS variable, CAST(p_size AS DOUBLE) AS value FROM part
UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part""")
def melt_(t):
    return melt(t.part.select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice"), ["p_partkey"],
                ["p_size", "p_retailprice"])


@query("melt_pairs", """
WITH x AS (SELECT o_custkey, max(o_totalprice) FILTER (o_orderstatus = 'F') AS v1, max(CAST(o_orderdate AS DATE)) FILTER (o_orderstatus = 'F') AS d1,
  max(o_totalprice) FILTER (o_orderstatus = 'O') AS v2, max(CAST(o_orderdate AS DATE)) FILTER (o_orderstatus = 'O') AS d2 FROM orders GROUP BY 1)
SELECT o_custkey, 'closed' AS source, v1 AS value, CAST(d1 AS VARCHAR) AS date FROM x
UNION ALL SELECT o_custkey, 'open', v2, CAST(d2 AS VARCHAR) FROM x""")
def melt_pairs_(t):
    closed, opened = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O"
    day = F.to_date("o_orderdate")
    x = t.orders.groupBy("o_custkey").agg(
        F.max(F.when(closed, F.col("o_totalprice"))).alias("v1"), F.max(F.when(closed, day)).alias("d1"),
        F.max(F.when(opened, F.col("o_totalprice"))).alias("v2"), F.max(F.when(opened, day)).alias("d2"))
    return melt_pairs(x, ["o_custkey"], {"closed": ("v1", "d1"), "open": ("v2", "d2")}).withColumn(
        "date", F.col("date").cast("string"))


@query("two_leg_melt", """
SELECT l_orderkey, l_linenumber, 'pay' AS leg, l_returnflag AS currency, -l_extendedprice AS amount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'receive', l_linestatus, l_quantity FROM lineitem""")
def two_leg_melt(t):
    return legs(t.lineitem, ["l_orderkey", "l_linenumber"], "l_returnflag", "l_extendedprice", "l_linestatus", "l_quantity")


@query("transpose_small", """
WITH x AS (SELECT o_orderstatus, CAST(count(*) AS DOUBLE) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1)
SELECT 'n' AS "column", max(n) FILTER (o_orderstatus = 'F') AS "F", max(n) FILTER (o_orderstatus = 'O') AS "O", max(n) FILTER (o_orderstatus = 'P') AS "P" FROM x
UNION ALL SELECT 'total', max(total) FILTER (o_orderstatus = 'F'), max(total) FILTER (o_orderstatus = 'O'), max(total) FILTER (o_orderstatus = 'P') FROM x""")
def transpose_small(t):
    x = t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), num(F.sum("o_totalprice")).alias("total"))
    return transpose(x, "o_orderstatus", ["F", "O", "P"], ["n", "total"])


@query("stack_halves", """
SELECT l_orderkey, l_linenumber, 'Assets' AS class_name, l_returnflag AS name, l_extendedprice AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'Liabilities and equity', l_linestatus, l_quantity FROM lineitem""")
def stack_halves_(t):
    sheet = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice", "l_linestatus", "l_quantity")
    return stack_halves(sheet, {"l_returnflag": "name", "l_extendedprice": "value"},
                        {"l_linestatus": "name", "l_quantity": "value"}, ("Assets", "Liabilities and equity"))


@query("exposure_matrix", """
WITH x AS (SELECT o_orderstatus AS ccy, c_mktsegment AS entity, r_name AS party, o_totalprice AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT ccy, entity, """ + ", ".join(
    f"round(coalesce(sum(amount) FILTER (party = '{r}'), 0), 2) AS \"{r}\"" for r in REGIONS) + " FROM x GROUP BY 1, 2")
def exposure_matrix_(t):
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "c_custkey", F.col("c_mktsegment").alias("entity"), F.col("r_name").alias("party"))
    per_customer = t.orders.groupBy(F.col("o_orderstatus").alias("ccy"), "o_custkey").agg(F.sum("o_totalprice").alias("amount"))
    x = join_keys(per_customer, places, {"o_custkey": "c_custkey"}, "inner", null_safe=False)
    return exposure_matrix(x, ["ccy"], "entity", "party", REGIONS, "amount").withColumns({r: num(r) for r in REGIONS})


@query("ordered_pivot", """
WITH x AS (SELECT r_name AS country, n_name AS bank, o_orderpriority AS segment, o_totalprice AS total
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
p AS (SELECT country, bank, """ + ", ".join(
    f"round(coalesce(sum(total) FILTER (segment = '{s}'), 0), 2) AS \"{s}\"" for s in PRIORITIES) + """,
  round(sum(total), 2) AS item_total FROM x GROUP BY 1, 2)
SELECT *, round(sum(item_total) OVER (PARTITION BY country), 2) AS group_total FROM p""")
def ordered_pivot_(t):
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "c_custkey", F.col("r_name").alias("country"), F.col("n_name").alias("bank"))
    per_customer = t.orders.groupBy(F.col("o_orderpriority").alias("segment"), "o_custkey").agg(F.sum("o_totalprice").alias("total"))
    x = join_keys(per_customer, places, {"o_custkey": "c_custkey"}, "inner", null_safe=False)
    total = sum((F.col(s) for s in PRIORITIES[1:]), F.col(PRIORITIES[0]))
    wide = ordered_pivot(x, "country", "bank", "segment", PRIORITIES, "total", total)
    return wide.withColumns({c: num(c) for c in [*PRIORITIES, "item_total", "group_total"]}).orderBy(
        F.desc("group_total"), "country", F.desc("item_total"))
