"""Exact ranks of raw rows, distinct keys as bitmaps, keyword dictionaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.inputs import BALANCES, balances, ctes
from ledgerloom.catalog.registry import num, query, settled, settled_sql
from ledgerloom.operators.bitmaps import compare_spans, day_bitmaps, group_coverage, number_keys, span_counts
from ledgerloom.operators.keywords import last_rule
from ledgerloom.operators.ranking import rank_lines, with_rank
from ledgerloom.operators.selection import select_quantiles


@query("rank_rows", """
SELECT l_orderkey, l_linenumber, rank() OVER (ORDER BY l_quantity DESC, l_shipdate) AS rank, dense_rank() OVER (ORDER BY l_quantity DESC, l_shipdate) AS dense_rank
FROM lineitem""")
def rank_rows(t):
    """Every line's rank by quantity and day, ties alike."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    return with_rank(lines, {"l_quantity": "desc", "l_shipdate": "asc"}, lines=5000).select("l_orderkey", "l_linenumber", "rank", "dense_rank")


@query("running_share", """
WITH x AS (SELECT l_partkey, sum(l_extendedprice) AS money FROM lineitem GROUP BY 1)
SELECT l_partkey, rank() OVER (ORDER BY money DESC) AS rank, round(sum(money) OVER (ORDER BY money DESC) / sum(money) OVER (), 6) AS share FROM x""")
def running_share(t):
    """Parts by money, with the share of all money up to each."""
    money = t.lineitem.groupBy("l_partkey").agg(F.sum("l_extendedprice").alias("money"))
    ranks = with_rank(money, {"money": "desc"}, "money", lines=500)
    return ranks.select("l_partkey", "rank", num("share", 6).alias("share"))


@query("rank_distinct", """
WITH x AS (SELECT o_totalprice, count(*) AS rows FROM orders GROUP BY 1)
SELECT o_totalprice, rows, CAST(sum(rows) OVER (ORDER BY o_totalprice) - rows + 1 AS BIGINT) AS rank, row_number() OVER (ORDER BY o_totalprice) AS dense_rank FROM x""")
def rank_distinct(t):
    """Distinct prices with how many orders come before them."""
    return rank_lines(t.orders, {"o_totalprice": "asc"}, lines=2000)


def _account_bitmaps(t):
    facts = balances(t).select("report_day", "account_no", "status")
    return day_bitmaps(facts, ["status"], "report_day", "account_no", number_keys(facts, "account_no"))


@query("bitmap_span_counts", ctes(BALANCES) + """
SELECT status, count(DISTINCT account_no) AS keys FROM balances WHERE report_day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY status""")
def bitmap_span_counts(t):
    """Distinct accounts per status in a span, from bitmaps per day."""
    return span_counts(_account_bitmaps(t), ["status"], "2024-01-05", "2024-01-20")


@query("bitmap_compare_spans", ctes(BALANCES) + """,
k AS (SELECT status, account_no, bool_or(report_day BETWEEN DATE '2024-01-01' AND DATE '2024-01-12') AS o,
  bool_or(report_day BETWEEN DATE '2024-01-10' AND DATE '2024-01-25') AS n FROM balances GROUP BY ALL)
SELECT status, count(*) FILTER (o AND n) AS "both", count(*) FILTER (o AND NOT n) AS only_old, count(*) FILTER (n AND NOT o) AS only_new,
  count(*) FILTER (o <> n) = 0 AS same FROM k WHERE o OR n GROUP BY status""")
def bitmap_compare_spans(t):
    """Whether two spans have the same accounts, and which part is in one of them only."""
    return compare_spans(_account_bitmaps(t), ["status"], ("2024-01-01", "2024-01-12"), ("2024-01-10", "2024-01-25"))


@query("bitmap_coverage", """
WITH a AS (SELECT DISTINCT l_partkey AS k FROM lineitem), b AS (SELECT DISTINCT o_custkey AS k FROM orders)
SELECT (SELECT count(*) FROM a JOIN b USING (k)) AS "both", (SELECT count(*) FROM a ANTI JOIN b USING (k)) AS only_left,
  (SELECT count(*) FROM b ANTI JOIN a USING (k)) AS only_right""")
def bitmap_coverage(t):
    """Keys of two tables, counted both ways."""
    keys = t.lineitem.select(F.lit("lines").alias("side"), F.to_date("l_shipdate").alias("day"), F.col("l_partkey").alias("k")).unionByName(
        t.orders.select(F.lit("orders").alias("side"), F.to_date("o_orderdate").alias("day"), F.col("o_custkey").alias("k")))
    return group_coverage(day_bitmaps(keys, ["side"], "day", "k", number_keys(keys, "k")), "side", "lines", "orders")


RULES = """w AS (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS keyword FROM benchmark WHERE text IS NOT NULL),
r AS (SELECT keyword, row_number() OVER (ORDER BY keyword) AS rule_no FROM w WHERE length(keyword) >= 5 AND length(keyword) <= 9)"""


@query("keyword_dictionary", "WITH " + RULES + """
SELECT doc_id, max(rule_no) AS rule_no FROM documents LEFT JOIN r ON contains(lower(text), keyword) GROUP BY doc_id""")
def keyword_dictionary(t):
    """The last rule whose keyword a document contains, for a dictionary of all benchmark words of 5 to 9 letters."""
    benchmark = t.spark.read.parquet(f"{t.folder}/benchmark.parquet")
    words = benchmark.select(F.explode(F.split(F.lower("text"), " ")).alias("keyword")).where("length(keyword) BETWEEN 5 AND 9")
    rules = rank_lines(words, {"keyword": "asc"}).select("keyword", F.col("dense_rank").alias("rule_no"))
    return last_rule(t.documents.select("doc_id", "text"), "text", rules).select("doc_id", "rule_no")


@query("quantile_selection", "SELECT l_suppkey, count(*) AS n, " + ", ".join(
    f"{settled_sql(f'quantile_cont(l_extendedprice, {q})')} AS {name}" for name, q in (("q90", 0.9), ("median", 0.5), ("q01", 0.01))) + " FROM lineitem GROUP BY 1")
def quantile_selection(t):
    """Exact quantiles per supplier by narrowing brackets down to fifty rows."""
    found = select_quantiles(t.lineitem, ["l_suppkey"], "l_extendedprice", {"q90": 0.9, "median": 0.5, "q01": 0.01}, few=50)
    return found.select("l_suppkey", "n", *(settled(c).alias(c) for c in ("q90", "median", "q01")))
