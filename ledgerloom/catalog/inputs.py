"""Business tables derived from the given tables, in Spark and as SQL text.

Each stand-in is a projection of whole tables: accounts and balances from events, ledger
lines from lineitem, entities from supplier and customer, quotes from orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.tables import Tables

AS_OF = "1998-06-30"


def balances(t: Tables) -> DataFrame:
    """Daily account balances: one row per event, with its time as landed."""
    return t.events.select(
        "ts", F.to_date("ts").alias("report_day"), F.col("user_id").alias("account"),
        F.col("event_type").alias("status"), F.col("value").alias("balance"),
        F.col("user_id").cast("string").alias("account_no"),
    )


BALANCES = """balances AS (SELECT CAST(ts AS DATE) AS report_day, user_id AS account, event_type AS status,
  value AS balance, CAST(user_id AS VARCHAR) AS account_no FROM events)"""


def quotes(t: Tables) -> DataFrame:
    """Daily currency quotes; not every pair is quoted every day."""
    return t.orders.groupBy(
        F.to_date("o_orderdate").alias("period"),
        F.when(F.col("o_orderstatus") == "F", "EUR").otherwise("USD").alias("ccy_from"),
        F.when(F.col("o_orderstatus") == "F", "USD").when(F.col("o_orderstatus") == "O", "CHF")
        .otherwise("RUB").alias("ccy_to"),
    ).agg((F.avg("o_totalprice") / 100000).alias("rate"))


QUOTES = """quotes AS (SELECT CAST(o_orderdate AS DATE) AS period,
  CASE WHEN o_orderstatus = 'F' THEN 'EUR' ELSE 'USD' END AS ccy_from,
  CASE WHEN o_orderstatus = 'F' THEN 'USD' WHEN o_orderstatus = 'O' THEN 'CHF' ELSE 'RUB' END AS ccy_to,
  avg(o_totalprice) / 100000 AS rate FROM orders GROUP BY ALL),
usd_rates AS (SELECT period AS rate_day, CASE WHEN ccy_to = 'USD' THEN ccy_from ELSE ccy_to END AS rate_ccy,
  CASE WHEN ccy_to = 'USD' THEN rate ELSE 1 / rate END AS coef FROM quotes)"""


def ledger(t: Tables) -> DataFrame:
    """Receivable and payable lines with a currency, half of them under technical codes."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("document"), F.col("l_partkey").alias("item"), F.col("l_suppkey").alias("company"),
        F.when(F.col("l_returnflag") == "R", "AR").otherwise("AP").alias("report_type"),
        F.when(F.col("l_returnflag") == "R", F.when(F.col("l_linestatus") == "F", "RUE").otherwise("EUR"))
        .when(F.col("l_returnflag") == "A", F.when(F.col("l_linestatus") == "F", "RUC").otherwise("CHF"))
        .otherwise(F.when(F.col("l_linestatus") == "F", "RUU5").otherwise("USD")).alias("currency"),
        F.col("l_extendedprice").alias("amount"), F.col("l_quantity").alias("quantity"),
        F.to_date("l_shipdate").alias("due"), F.col("l_linestatus").alias("line_status"),
        F.col("l_returnflag").alias("flag"), F.col("l_linenumber").alias("line_no"),
    )


LEDGER = """ledger AS (SELECT l_orderkey AS document, l_partkey AS item, l_suppkey AS company,
  CASE WHEN l_returnflag = 'R' THEN 'AR' ELSE 'AP' END AS report_type,
  CASE l_returnflag WHEN 'R' THEN 'EUR' WHEN 'A' THEN 'CHF' ELSE 'USD' END AS currency,
  l_extendedprice AS amount, l_quantity AS quantity, CAST(l_shipdate AS DATE) AS due,
  l_linestatus AS line_status, l_returnflag AS flag, l_linenumber AS line_no FROM lineitem)"""


def companies(t: Tables) -> DataFrame:
    """Sales units: three identifiers, a segment (missing for some) and a holding.

    Written once per query: a dimension resolved from three tables, read with its real size.
    """
    return t.derived("companies", lambda: _companies(t))


def _companies(t: Tables) -> DataFrame:
    nation = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return t.supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("unit_key"), F.col("s_suppkey").cast("string").alias("id"),
        F.col("s_name").alias("short_code"), F.concat(F.lit("Z"), F.col("s_nationkey")).alias("plant_code"),
        F.when(F.col("s_acctbal") >= 0, F.col("n_name")).alias("segment"), F.col("r_name").alias("holding"),
        F.col("s_acctbal").alias("credit"),
    )


COMPANIES = """companies AS (SELECT s_suppkey AS unit_key, CAST(s_suppkey AS VARCHAR) AS id, s_name AS short_code,
  'Z' || s_nationkey AS plant_code, CASE WHEN s_acctbal >= 0 THEN n_name END AS segment, r_name AS holding,
  s_acctbal AS credit
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def parties(t: Tables) -> DataFrame:
    """Counterparties: customers with segment and holding."""
    nation = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("party"), F.col("c_name").alias("party_name"),
        F.when(F.col("c_mktsegment") != "FURNITURE", F.col("n_name")).alias("party_segment"),
        F.col("r_name").alias("party_holding"), F.col("c_mktsegment").alias("market"),
        F.col("c_acctbal").alias("party_balance"),
    )


PARTIES = """parties AS (SELECT c_custkey AS party, c_name AS party_name,
  CASE WHEN c_mktsegment <> 'FURNITURE' THEN n_name END AS party_segment, r_name AS party_holding,
  c_mktsegment AS market, c_acctbal AS party_balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

NATIONS = [f"NATION_{i}" for i in range(25)]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
