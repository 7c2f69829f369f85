"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import query
from ledgerloom.functions.columns import all_null, any_false, any_null, any_of, columns_like
from ledgerloom.functions.measures import ratio_above
from ledgerloom.functions.text import contains_any_column, is_integer_text, matches_any_column
from ledgerloom.operators.grouping import first_per_key
from ledgerloom.operators.joins import join_keys
from ledgerloom.operators.quality import drop_empty_rows, empty_columns
from ledgerloom.operators.rules import classify_by_prefix, condition_filter


@query("project_rename", """
SELECT l_orderkey AS document, l_extendedprice AS amount, l_shipdate IS NULL AS undated,
  'ERP' AS source, CAST(NULL AS VARCHAR) AS facility, CAST(NULL AS DOUBLE) AS notional
FROM lineitem""")
def project_rename(t):
    return t.lineitem.select("l_orderkey", "l_extendedprice", F.col("l_shipdate").isNull().alias("undated")).withColumnsRenamed(
        {"l_orderkey": "document", "l_extendedprice": "amount"},
    ).withColumns({"source": F.lit("ERP"), "facility": F.lit(None).cast("string"), "notional": F.lit(None).cast("double")})


@query("filter_conjunct", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderstatus <> 'P' AND o_orderpriority = '2-HIGH' AND o_orderdate > DATE '1998-06-30'
  AND NOT (o_orderstatus = 'F' AND o_totalprice < 100000)""")
def filter_conjunct(t):
    return t.orders.where(
        (F.col("o_orderstatus") != "P") & (F.col("o_orderpriority") == "2-HIGH")
        & (F.col("o_orderdate") > F.lit("1998-06-30").cast("timestamp_ntz"))
        & ~((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 100000))
    ).select("o_orderkey", "o_totalprice")


@query("filter_in_list", """
SELECT c_custkey, c_mktsegment, c_nationkey FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey NOT IN (3, 7, 11)""")
def filter_in_list(t):
    return t.customer.where(
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & ~F.col("c_nationkey").isin(3, 7, 11)
    ).select("c_custkey", "c_mktsegment", "c_nationkey")


@query("classify_prefix", """
SELECT *, CASE WHEN p_name LIKE 'red%' OR p_name LIKE 'blue%' THEN 'Loans received'
  WHEN p_name LIKE 'small%' THEN 'Loans issued' WHEN p_name LIKE 'b%' THEN 'Other' END AS purpose
FROM part""")
def classify_prefix(t):
    label = classify_by_prefix("p_name", {
        "Loans received": ["red", "blue"], "Loans issued": ["small"], "Other": ["b"]})
    return t.part.select("*", label.alias("purpose"))


@query("regex_any_column", """
SELECT p_partkey, p_name, p_brand, p_type FROM part
WHERE regexp_matches(p_name, '(ring|bolt)$') OR regexp_matches(p_brand, '#1[0-4]') OR regexp_matches(p_type, '^PRO')""")
def regex_any_column(t):
    # one pattern over several columns, as an alternation
    pattern = "(ring|bolt)$|#1[0-4]|^PRO"
    return t.part.where(matches_any_column(["p_name", "p_brand", "p_type"], pattern)).select(
        "p_partkey", "p_name", "p_brand", "p_type")


@query("search_any_column", """
SELECT doc_id, lang, source FROM documents
WHERE contains(lower(text), 'license') OR contains(lower(lang), 'license') OR contains(lower(source), 'license')""")
def search_any_column(t):
    return t.documents.where(contains_any_column(["text", "lang", "source"], " License ")).select(
        "doc_id", "lang", "source")


@query("filter_or_keys", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#3')
   OR l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)
   OR l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 490000)""")
def filter_or_keys(t):
    lists = {
        "l_partkey": t.part.where(F.col("p_brand") == "Brand#3").select(F.col("p_partkey").alias("k0")),
        "l_suppkey": t.supplier.where(F.col("s_acctbal") < 0).select(F.col("s_suppkey").alias("k1")),
        "l_orderkey": t.orders.where(F.col("o_totalprice") > 490000).select(F.col("o_orderkey").alias("k2")),
    }
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    for i, (key, wanted) in enumerate(lists.items()):
        rows = rows.join(wanted.distinct(), F.col(key) == F.col(f"k{i}"), "left")
    return rows.where(any_of(F.col(f"k{i}").isNotNull() for i in range(3))).drop("k0", "k1", "k2")


@query("null_rows_any_all", """
WITH x AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS credit,
    nullif(c_mktsegment, 'BUILDING') AS market, c_acctbal > 0 AS solvent, c_nationkey < 20 AS near FROM customer)
SELECT c_custkey, credit IS NULL OR market IS NULL AS some_null, credit IS NULL AND market IS NULL AS none_known,
  NOT solvent OR NOT near AS some_false FROM x""")
def null_rows_any_all(t):
    x = t.customer.select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("credit"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("market"),
        (F.col("c_acctbal") > 0).alias("solvent"), (F.col("c_nationkey") < 20).alias("near"))
    return x.select("c_custkey", any_null(["credit", "market"]).alias("some_null"),
                    all_null(["credit", "market"]).alias("none_known"), any_false(["solvent", "near"]).alias("some_false"))


@query("drop_empty", """
SELECT l_orderkey, l_linenumber, l_discount + 0 AS l_discount, l_tax + 0 AS l_tax FROM lineitem
WHERE NOT (l_discount = 0 AND l_tax = 0)""")
def drop_empty(t):
    return drop_empty_rows(t.lineitem, ["l_discount", "l_tax"]).select(
        "l_orderkey", "l_linenumber", (F.col("l_discount") + 0.0).alias("l_discount"), (F.col("l_tax") + 0.0).alias("l_tax"))


@query("empty_columns", """
WITH x AS (SELECT CASE WHEN l_quantity > 50 THEN l_quantity END AS over_50, l_tax, l_discount * 0 AS nothing FROM lineitem)
SELECT 'over_50' AS "column", bool_and(over_50 IS NULL OR over_50 = 0) AS empty FROM x
UNION ALL SELECT 'l_tax', bool_and(l_tax IS NULL OR l_tax = 0) FROM x
UNION ALL SELECT 'nothing', bool_and(nothing IS NULL OR nothing = 0) FROM x""")
def empty_cols(t):
    x = t.lineitem.select(F.when(F.col("l_quantity") > 50, F.col("l_quantity")).alias("over_50"), "l_tax",
                          (F.col("l_discount") * 0).alias("nothing"))
    return empty_columns(x, ["over_50", "l_tax", "nothing"])


@query("numeric_only", """
WITH x AS (SELECT doc_id, substr(source, 4) AS code, split_part(text, ' ', 1) AS first_word FROM documents)
SELECT doc_id, try_cast(code AS BIGINT) AS code FROM x WHERE try_cast(code AS BIGINT) IS NOT NULL
  AND try_cast(first_word AS BIGINT) IS NULL""")
def numeric_only(t):
    x = t.documents.select("doc_id", F.substr("source", F.lit(4)).alias("code"),
                           F.split("text", " ", 2)[0].alias("first_word"))
    return x.where(is_integer_text("code") & ~is_integer_text("first_word")).select(
        "doc_id", F.col("code").cast("bigint").alias("code"))


CONDITIONS = [
    {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"},
    {"o_orderstatus": "O"},
    {"o_orderpriority": "5-LOW"},
]


@query("condition_table", """
WITH c(condition_id, status, priority) AS (VALUES (0, 'F', '1-URGENT'), (1, 'O', NULL), (2, NULL, '5-LOW'))
SELECT o_orderkey, o_orderstatus, o_orderpriority, condition_id FROM orders JOIN c
  ON (c.status IS NULL OR c.status = o_orderstatus) AND (c.priority IS NULL OR c.priority = o_orderpriority)""")
def condition_table(t):
    return condition_filter(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), CONDITIONS)


@query("dedupe", """SELECT DISTINCT l_orderkey, l_suppkey, l_returnflag FROM lineitem""")
def dedupe(t):
    return t.lineitem.select("l_orderkey", "l_suppkey", "l_returnflag").dropDuplicates()


@query("dedupe_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_extendedprice, l_partkey, l_suppkey) = 1""")
def dedupe_first(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return first_per_key(rows, ["l_orderkey", "l_linenumber"], ["l_extendedprice", "l_partkey", "l_suppkey"])


@query("ratio_anomaly", """
SELECT l_orderkey, l_linenumber, l_quantity, p_retailprice, l_extendedprice FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE (abs(l_extendedprice / (l_quantity * p_retailprice)) > 2
    OR abs(l_quantity * p_retailprice / l_extendedprice) > 2) AND l_quantity > 1""")
def ratio_anomaly(t):
    priced = join_keys(t.lineitem, t.part.select("p_partkey", "p_retailprice"), {"l_partkey": "p_partkey"}, "inner",
                       null_safe=False)
    return priced.where(
        ratio_above("l_extendedprice", F.col("l_quantity") * F.col("p_retailprice"), 2.0) & (F.col("l_quantity") > 1)
    ).select("l_orderkey", "l_linenumber", "l_quantity", "p_retailprice", "l_extendedprice")


@query("columns_by_pattern", """SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem""")
def columns_by_pattern(t):
    return t.lineitem.select(*columns_like(t.lineitem.columns, "key"))
