"""Row-level differences of copies, and runs of outputs found by their names."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import num, query, text
from ledgerloom.operators.difference import changed_columns, copy_difference, difference, write_copy
from ledgerloom.plans.monitoring import compare_outputs
from ledgerloom.session import shared_dir
from ledgerloom.sources.listing import day_pairs, list_outputs, pair_outputs, profile_outputs, read_reconciled

ORDER_KEYS, ORDER_VALUES = ["o_orderkey"], ["o_custkey", "o_orderstatus", "o_totalprice"]


def _orders(t):
    return t.orders.select(*ORDER_KEYS, *ORDER_VALUES)


def _later_orders(t):
    """A later copy: some orders are gone, some have another key, price or status."""
    key = F.col("o_orderkey")
    return _orders(t).where(key % 997 != 3).select(
        F.when(key % 1009 == 5, key + 1_000_000_000_000).otherwise(key).alias("o_orderkey"), "o_custkey",
        F.when(key % 703 == 1, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when((key % 501 == 7) | (key % 703 == 1), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"))


LATER_ORDERS = """a AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders),
b AS (SELECT CASE WHEN o_orderkey % 1009 = 5 THEN o_orderkey + 1000000000000 ELSE o_orderkey END AS o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 703 = 1 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 501 = 7 OR o_orderkey % 703 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
  FROM orders WHERE o_orderkey % 997 <> 3),
j AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, a.o_custkey AS c1, b.o_custkey AS c2, a.o_orderstatus AS s1, b.o_orderstatus AS s2,
  a.o_totalprice AS p1, b.o_totalprice AS p2, a.o_orderkey IS NOT NULL AS was, b.o_orderkey IS NOT NULL AS is_now
  FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey
  WHERE a.o_custkey IS DISTINCT FROM b.o_custkey OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus OR a.o_totalprice IS DISTINCT FROM b.o_totalprice)"""


@query("diff_copies", "WITH " + LATER_ORDERS + """
SELECT o_orderkey, c1 AS o_custkey, s1 AS o_orderstatus, p1 AS o_totalprice, 1 AS copies_old, 0 AS copies_new,
  CASE WHEN is_now THEN 'changed' ELSE 'lost' END AS change FROM j WHERE was
UNION ALL SELECT o_orderkey, c2, s2, p2, 0, 1, CASE WHEN was THEN 'changed' ELSE 'added' END FROM j WHERE is_now""")
def diff_copies(t):
    old, new = _orders(t), _later_orders(t)
    paths = [write_copy(df, shared_dir(t.spark, "copy"), ORDER_KEYS) for df in (old, new)]
    return copy_difference(t.spark, *paths, ORDER_KEYS, old.schema)


@query("diff_columns", "WITH " + LATER_ORDERS + """,
k AS (SELECT * FROM j WHERE was AND is_now)
SELECT 'o_orderstatus' AS "column", count(*) AS keys FROM k WHERE s1 IS DISTINCT FROM s2 HAVING count(*) > 0
UNION ALL SELECT 'o_totalprice', count(*) FROM k WHERE p1 IS DISTINCT FROM p2 HAVING count(*) > 0
UNION ALL SELECT 'o_custkey', count(*) FROM k WHERE c1 IS DISTINCT FROM c2 HAVING count(*) > 0""")
def diff_columns(t):
    return changed_columns(difference(_orders(t), _later_orders(t), ORDER_KEYS), ORDER_KEYS, ORDER_VALUES)


@query("diff_repeated_keys", """
WITH a AS (SELECT l_suppkey, l_returnflag, l_quantity, count(*) AS n FROM lineitem GROUP BY ALL),
b AS (SELECT l_suppkey, l_returnflag, CASE WHEN l_orderkey % 1999 = 2 THEN l_quantity + 100 ELSE l_quantity END AS l_quantity, count(*) AS n
  FROM lineitem WHERE l_orderkey % 4001 <> 9 GROUP BY ALL),
v AS (SELECT coalesce(a.l_suppkey, b.l_suppkey) AS l_suppkey, coalesce(a.l_returnflag, b.l_returnflag) AS l_returnflag,
  coalesce(a.l_quantity, b.l_quantity) AS l_quantity, coalesce(a.n, 0) AS copies_old, coalesce(b.n, 0) AS copies_new
  FROM a FULL JOIN b ON a.l_suppkey = b.l_suppkey AND a.l_returnflag = b.l_returnflag AND a.l_quantity = b.l_quantity)
SELECT *, CASE WHEN bool_or(copies_old > copies_new) OVER k AND bool_or(copies_old < copies_new) OVER k THEN 'changed'
  WHEN copies_old > copies_new THEN 'lost' ELSE 'added' END AS change
FROM v WHERE copies_old <> copies_new WINDOW k AS (PARTITION BY l_suppkey, l_returnflag)""")
def diff_repeated_keys(t):
    """Lines of a supplier and flag, many per key, compared as multisets."""
    old = t.lineitem.select("l_suppkey", "l_returnflag", "l_quantity")
    moved = F.when(F.col("l_orderkey") % 1999 == 2, F.col("l_quantity") + 100).otherwise(F.col("l_quantity"))
    new = t.lineitem.where(F.col("l_orderkey") % 4001 != 9).select("l_suppkey", "l_returnflag", moved.alias("l_quantity"))
    return difference(old, new, ["l_suppkey", "l_returnflag"])


def _runs(t):
    """A folder of dated outputs, one per year and priority, status, flag or market; three kinds of columns.

    Markets are written by two runs, of which the later one has its balance as text.
    """
    folder = shared_dir(t.spark, "runs")

    def write(df, day, *name):
        output = F.concat_ws("_", text(day), *name)
        dealt = df.withColumn("output", output).hint("rebalance", F.col("output"))
        dealt.write.mode("append").partitionBy("output").parquet(folder)

    write(t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus"),
          F.trunc(F.to_date("o_orderdate"), "year"), F.col("o_orderpriority"), F.col("o_orderstatus"))
    write(t.lineitem.select("l_quantity", "l_discount", "l_shipdate", "l_returnflag"), F.trunc(F.to_date("l_shipdate"), "year"),
          F.lit("lines"), F.col("l_returnflag"))
    market = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    write(market, F.lit("2001-06-30"), F.lit("market"), F.col("c_mktsegment"))
    write(market.where("c_acctbal > 0").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(12,2)").cast("string")), F.lit("2001-12-31"),
          F.lit("market"), F.col("c_mktsegment"))
    return list_outputs(t.spark, folder)


RUNS = """o AS (SELECT o_orderpriority || ' ' || o_orderstatus AS name, CAST(date_trunc('year', o_orderdate) AS DATE) AS day,
  o_orderkey, o_custkey, o_totalprice FROM orders),
l AS (SELECT 'lines ' || l_returnflag AS name, CAST(date_trunc('year', l_shipdate) AS DATE) AS day, l_quantity, l_discount FROM lineitem),
m AS (SELECT 'market ' || c_mktsegment AS name, d.day, c_custkey, c_acctbal FROM customer,
  (VALUES (DATE '2001-06-30'), (DATE '2001-12-31')) d(day) WHERE d.day = DATE '2001-06-30' OR c_acctbal > 0),
r AS (SELECT DISTINCT name, day FROM o UNION SELECT DISTINCT name, day FROM l UNION SELECT DISTINCT name, day FROM m),
p AS (SELECT name, count(*) AS n_days, max(day) AS new_day, CASE WHEN count(*) > 1 THEN list_sort(list(day))[-2] END AS old_day FROM r GROUP BY name)"""


@query("output_pairs", "WITH " + RUNS + """
SELECT name, n_days, CAST(old_day AS VARCHAR) AS old_day, CAST(new_day AS VARCHAR) AS new_day, n_days > 1 AS paired FROM p""")
def output_pairs(t):
    """Dated outputs paired by the rest of their name, from the folder's listing."""
    return pair_outputs(_runs(t)).select("name", "n_days", text("old_day").alias("old_day"), text("new_day").alias("new_day"), "paired")


@query("output_day_pairs", "WITH " + RUNS + """
SELECT a.name, CAST(a.day AS VARCHAR) AS old_day, CAST(b.day AS VARCHAR) AS new_day
FROM r a JOIN r b ON a.name = b.name AND a.day < b.day AND b.day - a.day <= 800""")
def output_day_pairs(t):
    """All ordered pairs of an output's days that lie within 800 days."""
    return day_pairs(_runs(t), 800).select("name", text("old_day").alias("old_day"), text("new_day").alias("new_day"))


def _lines_sql(source: str, columns: list[tuple[str, str, str]]) -> str:
    """Profile lines of (column, type, numeric expression or empty)."""
    return " UNION ALL ".join(
        f"""SELECT name, day, '{c}' AS "column", {kind} AS type, {len(columns)} AS n_columns, count(*) - count({c}) AS nulls,
  {f"coalesce(sum({number}), 0)" if number else "0.0"} AS sum, count(*) AS rows, 0 AS zero_rows FROM {source} GROUP BY name, day"""
        for c, kind, number in columns)


PROFILES = "x AS (" + " UNION ALL ".join([
    _lines_sql("(SELECT *, o_orderkey AS o_orderdate, o_orderkey AS o_orderpriority, o_orderkey AS o_orderstatus FROM o)", [
        ("o_orderkey", "'bigint'", "CAST(o_orderkey AS DOUBLE)"), ("o_custkey", "'bigint'", "CAST(o_custkey AS DOUBLE)"), ("o_totalprice", "'double'", "o_totalprice"),
        ("o_orderdate", "'timestamp_ntz'", ""), ("o_orderpriority", "'string'", ""), ("o_orderstatus", "'string'", "")]),
    _lines_sql("(SELECT *, l_quantity AS l_shipdate, l_quantity AS l_returnflag FROM l)", [
        ("l_quantity", "'double'", "l_quantity"), ("l_discount", "'double'", "l_discount"), ("l_shipdate", "'timestamp_ntz'", ""), ("l_returnflag", "'string'", "")]),
    _lines_sql("(SELECT *, c_custkey AS c_mktsegment FROM m)", [
        ("c_custkey", "'bigint'", "CAST(c_custkey AS DOUBLE)"), ("c_acctbal", "CASE day WHEN DATE '2001-06-30' THEN 'double' ELSE 'string' END", "c_acctbal"),
        ("c_mktsegment", "'string'", "")]),
]) + ")"


@query("output_profiles", "WITH " + RUNS + ", " + PROFILES + """
SELECT name, CAST(day AS VARCHAR) AS day, "column", type, n_columns, nulls, round(sum, 2) AS sum, rows, zero_rows FROM x""")
def output_profiles(t):
    """Column profiles of all outputs of a folder from as many scans as their schemas need."""
    files = _runs(t)
    named = files.select("output", "name", "day").distinct()
    return profile_outputs(t.spark, files).join(named, "output").select(
        "name", text("day").alias("day"), "column", "type", "n_columns", "nulls", num("sum").alias("sum"), "rows", "zero_rows")


def _equal_sql(c: str) -> str:
    return f"""coalesce(a.{c} = b.{c} OR abs(a.{c} - b.{c}) / nullif(greatest(abs(a.{c}), abs(b.{c})), 0) <= 0.4, false)"""


@query("report_outputs_compare", "WITH " + RUNS + ", " + PROFILES + f""",
c AS (SELECT p.name, a.type = b.type AS type_equal, a.n_columns = b.n_columns AS n_columns_equal, {_equal_sql('nulls')} AS nulls_equal,
  {_equal_sql('sum')} AS sum_equal, {_equal_sql('rows')} AS rows_equal, {_equal_sql('zero_rows')} AS zero_rows_equal
  FROM p JOIN x a ON a.name = p.name AND a.day = p.old_day JOIN x b ON b.name = p.name AND b.day = p.new_day AND b."column" = a."column")
SELECT name, bool_and(nulls_equal) AS nulls_equal, bool_and(sum_equal) AS sum_equal, bool_and(rows_equal) AS rows_equal,
  bool_and(zero_rows_equal) AS zero_rows_equal, bool_and(type_equal) AS type_equal, bool_and(n_columns_equal) AS n_columns_equal
FROM c GROUP BY name HAVING NOT bool_and(nulls_equal AND sum_equal AND rows_equal AND zero_rows_equal AND type_equal AND n_columns_equal)""")
def report_outputs_compare(t):
    """Paired outputs of a folder whose newest run differs from the one before."""
    files = _runs(t)
    return compare_outputs(profile_outputs(t.spark, files), pair_outputs(files).where("paired"))["problems"]


def _typed_parts(t):
    """One table landed in four files' folders, whose key and amount have four types."""
    folder = shared_dir(t.spark, "typed")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    for i, (k, p) in enumerate([(key.cast("int"), price.cast("int")), (key, price.cast("bigint")), (key.cast("double"), price),
                                (key, F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(price.cast("decimal(14,2)").cast("string")))]):
        t.orders.where(F.pmod(key, F.lit(4)) == i).select(k.alias("o_orderkey"), p.alias("o_totalprice"), "o_orderstatus").write.parquet(f"{folder}/{i}")
    return list_outputs(t.spark, folder)


@query("files_reconciled", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 4 = 0 THEN CAST(trunc(o_totalprice) AS DOUBLE)
  WHEN o_orderkey % 4 = 1 THEN CAST(trunc(o_totalprice) AS DOUBLE) WHEN o_orderkey % 4 = 2 THEN o_totalprice
  WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice FROM orders""")
def files_reconciled(t):
    """Files that type a column as int, long, double and text, read as one table."""
    rows, _, _ = read_reconciled(t.spark, _typed_parts(t), {"o_orderkey": "bigint", "o_totalprice": "double"})
    return rows.select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("files_rejected", """
SELECT 'o_totalprice' AS "column", 'n/a' AS value, count(*) AS rows FROM orders WHERE o_orderkey % 4 = 3 AND o_orderstatus = 'P' HAVING count(*) > 0""")
def files_rejected(t):
    """Values that do not cast to the wanted type, counted."""
    _, _, rejected = read_reconciled(t.spark, _typed_parts(t), {"o_orderkey": "bigint", "o_totalprice": "double"})
    return rejected.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))


@query("files_conflicts", """
SELECT * FROM (VALUES ('o_orderkey', 'int', 'bigint'), ('o_orderkey', 'bigint', 'bigint'), ('o_orderkey', 'double', 'bigint'),
  ('o_totalprice', 'int', 'double'), ('o_totalprice', 'bigint', 'double'), ('o_totalprice', 'double', 'double'), ('o_totalprice', 'string', 'double'))
  v("column", type, common) WHERE EXISTS (SELECT 1 FROM orders)""")
def files_conflicts(t):
    """The columns that files type differently, from their footers."""
    return read_reconciled(t.spark, _typed_parts(t), {"o_orderkey": "bigint", "o_totalprice": "double"})[1].select("column", "type", "common")
