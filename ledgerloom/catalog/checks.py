"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.inputs import BALANCES, COMPANIES, LEDGER, balances, companies, ctes, ledger
from ledgerloom.catalog.joins import CODES, DAYS, MULTIKEY, coded_lines
from ledgerloom.catalog.registry import num, query
from ledgerloom.operators.dimensions import lookup_multikey
from ledgerloom.operators.quality import alerts, checklist, count_differences, expectations, repeated_keys, snapshot_changes
from ledgerloom.operators.reconcile import coverage

CHANGES = """seen AS (SELECT account, status, count(*) FILTER (report_day = (SELECT last_day FROM d)) AS n_last,
  count(*) FILTER (report_day = (SELECT prev_day FROM p)) AS n_prev, sum(balance) AS amount FROM balances
  WHERE report_day IN ((SELECT last_day FROM d), (SELECT prev_day FROM p)) GROUP BY ALL),
changes AS (SELECT CASE WHEN n_last = 0 THEN 'missing' ELSE 'new' END AS status_change, account, status, n_last + n_prev AS rows, amount
  FROM seen WHERE n_last = 0 OR n_prev = 0)"""


def changes(t):
    return snapshot_changes(balances(t).withColumnRenamed("status", "account_status"), "ts",
                            ["account", "account_status"], "balance")


@query("qc_missing_new", ctes(BALANCES, DAYS, CHANGES) + """
SELECT status_change AS status, account, status AS account_status, rows, round(amount, 2) AS amount FROM changes""")
def qc_missing_new(t):
    return changes(t).withColumn("amount", num("amount"))


@query("qc_mapping", ctes(CODES, COMPANIES, MULTIKEY) + """
SELECT DISTINCT code, split_part(code, '#', 1) AS stored, coalesce(segment, 'External') AS mapped FROM coded LEFT JOIN best ON code = k
WHERE split_part(code, '#', 1) <> coalesce(segment, 'External')""")
def qc_mapping(t):
    rows = coded_lines(t).select("code", F.split("code", "#")[0].alias("stored")).distinct()
    found = lookup_multikey(rows, "code", companies(t), ["id", "short_code", "plant_code"], "segment", ["unit_key"], "mapped")
    return found.where(F.col("stored") != F.col("mapped"))


@query("qc_alerts", ctes(BALANCES, DAYS, CHANGES) + """
, s AS (SELECT coalesce(sum(amount) FILTER (status_change = 'missing'), 0) AS missing, coalesce(sum(amount) FILTER (status_change = 'new'), 0) AS new FROM changes),
l AS (SELECT 'missing records' AS alert, missing AS value, 3000.0::DOUBLE AS "limit" FROM s UNION ALL SELECT 'new records', new, 2000000 FROM s)
SELECT alert, round(value, 2) AS value, "limit", CASE WHEN value >= "limit" THEN 'CRITICAL' WHEN value <> 0 THEN 'ALERT' ELSE 'OK' END AS level FROM l""")
def qc_alerts(t):
    status = F.col("status")
    out = alerts(changes(t), {
        "missing records": (F.when(status == "missing", F.col("amount")), 3000.0),
        "new records": (F.when(status == "new", F.col("amount")), 2000000.0),
    })
    return out.withColumn("value", num("value"))


@query("qc_expectations", """
WITH x AS (SELECT count(*) AS n, count(DISTINCT l_returnflag) AS flags, count(*) FILTER (l_suppkey IS NULL) AS nulls, count(DISTINCT l_orderkey) AS orders FROM lineitem)
SELECT 'rows' AS "check", CAST(n AS DOUBLE) AS actual, CAST(4 * (SELECT count(*) FROM orders) AS DOUBLE) AS expected, n = 4 * (SELECT count(*) FROM orders) AS ok FROM x
UNION ALL SELECT 'flags', flags, 3, flags = 3 FROM x UNION ALL SELECT 'no null supplier', nulls, 0, nulls = 0 FROM x
UNION ALL SELECT 'orders', orders, (SELECT count(*) FROM orders), orders = (SELECT count(*) FROM orders) FROM x""")
def qc_expectations(t):
    orders = t.orders.agg(F.count(F.lit(1))).scalar()  # what a second table says
    return expectations(t.lineitem, {
        "rows": (F.count(F.lit(1)), 4 * orders),
        "flags": (F.count_distinct("l_returnflag"), F.lit(3)),
        "no null supplier": (F.count_if(F.col("l_suppkey").isNull()), F.lit(0)),
        "orders": (F.count_distinct("l_orderkey"), orders),
    })


@query("qc_unique_key", """
SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def qc_unique_key(t):
    return repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("qc_duplicates", ctes(LEDGER) + """
SELECT company, size, count(*) AS rows FROM (SELECT company, abs(CASE WHEN report_type = 'AP' THEN -amount ELSE amount END) AS size FROM ledger)
GROUP BY ALL HAVING count(*) > 1""")
def qc_duplicates(t):
    signed = F.when(F.col("report_type") == "AP", -F.col("amount")).otherwise(F.col("amount"))
    return repeated_keys(ledger(t).select("company", F.abs(signed).alias("size")), ["company", "size"])


OUTLIERS = " UNION ALL ".join(f"""SELECT 'outlier' AS "check", '{c}' AS "column", count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS rows
  FROM lineitem, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lineitem)""" for c in ("l_quantity", "l_extendedprice"))


@query("qc_checklist", f"""
SELECT 'repeated' AS "check", 'l_orderkey, l_partkey' AS "column", coalesce(sum(n - 1), 0)::BIGINT AS rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1)
UNION ALL SELECT 'null', 'l_orderkey', count(*) FILTER (l_orderkey IS NULL) FROM lineitem UNION ALL SELECT 'null', 'l_partkey', count(*) FILTER (l_partkey IS NULL) FROM lineitem
UNION ALL SELECT 'null', 'l_quantity', count(*) FILTER (l_quantity IS NULL) FROM lineitem UNION ALL SELECT 'null', 'l_extendedprice', count(*) FILTER (l_extendedprice IS NULL) FROM lineitem
UNION ALL SELECT 'null', 'code', count(*) FILTER (code IS NULL) FROM x UNION ALL SELECT 'no number', 'code', count(*) FILTER (code IS NOT NULL AND try_cast(code AS DOUBLE) IS NULL) FROM x
UNION ALL {OUTLIERS}""".replace("FROM x", "FROM (SELECT CASE l_returnflag WHEN 'A' THEN CAST(l_linenumber AS VARCHAR) WHEN 'N' THEN 'N/A' END AS code FROM lineitem)"))
def qc_checklist(t):
    code = F.when(F.col("l_returnflag") == "A", F.col("l_linenumber").cast("string")).when(F.col("l_returnflag") == "N", "N/A")
    return checklist(t.lineitem.withColumn("code", code), ["l_orderkey", "l_partkey"], ["l_quantity", "l_extendedprice"], ["code"])


@query("qc_coverage", """
WITH a AS (SELECT DISTINCT c_nationkey AS nation, o_orderpriority AS kind FROM orders JOIN customer ON o_custkey = c_custkey),
b AS (SELECT DISTINCT s_nationkey AS nation, CASE WHEN s_acctbal > 5000 THEN '1-URGENT' ELSE '2-HIGH' END AS kind FROM supplier)
SELECT coalesce(a.nation, b.nation) AS nation, coalesce(a.kind, b.kind) AS kind, CASE WHEN a.nation IS NULL THEN 'right_only' ELSE 'left_only' END AS side
FROM a FULL JOIN b USING (nation, kind) WHERE a.nation IS NULL OR b.nation IS NULL""")
def qc_coverage(t):
    big = t.orders.select("o_custkey", F.col("o_orderpriority").alias("kind"))
    a = big.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").alias("nation"), "kind")
    b = t.supplier.select(F.col("s_nationkey").alias("nation"), F.when(F.col("s_acctbal") > 5000, "1-URGENT").otherwise("2-HIGH").alias("kind"))
    return coverage(a, b, ["nation", "kind"]).where(F.col("side") != "both")


@query("qc_count_by_key", """
WITH a AS (SELECT l_orderkey AS doc, count(*) AS n FROM lineitem GROUP BY 1), b AS (SELECT o_orderkey AS doc, count(*) AS n FROM orders GROUP BY 1)
SELECT coalesce(a.doc, b.doc) AS doc, coalesce(a.n, 0) AS left_rows, coalesce(b.n, 0) AS right_rows FROM a FULL JOIN b ON a.doc = b.doc
WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def qc_count_by_key(t):
    return count_differences(t.lineitem.select(F.col("l_orderkey").alias("doc")), t.orders.select(F.col("o_orderkey").alias("doc")), "doc")
