"""Latest versions, series, fills, slices and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.inputs import BALANCES, balances, ctes
from ledgerloom.catalog.registry import num, query, settled, settled_sql, text
from ledgerloom.functions.measures import second_best
from ledgerloom.operators.grouping import latest_one, latest_version, with_group_value
from ledgerloom.operators.quality import last_two_days
from ledgerloom.operators.series import (
    backward_fill, forward_fill, pct_change, rolling_mean, rolling_std, section_slice, to_series, volatility,
)

DAILY = """daily AS (SELECT l_returnflag AS product, CAST(l_shipdate AS DATE) AS period, avg(l_extendedprice) AS value
  FROM lineitem GROUP BY ALL)"""
MONTHLY = """monthly AS (SELECT o_orderpriority AS product, CAST(date_trunc('month', o_orderdate) AS DATE) AS period,
  avg(o_totalprice) AS value FROM orders GROUP BY ALL)"""


def daily_prices(t):
    return to_series(t.lineitem, ["l_returnflag"], "l_shipdate", "l_extendedprice").withColumnRenamed("l_returnflag", "product")


def monthly_prices(t):
    return to_series(t.orders, ["o_orderpriority"], F.trunc(F.to_date("o_orderdate"), "month"), "o_totalprice").withColumnRenamed(
        "o_orderpriority", "product")


@query("latest_version", """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY o_orderdate = max(o_orderdate) OVER (PARTITION BY o_custkey)""")
def latest_version_(t):
    return latest_version(t.orders, ["o_custkey"], "o_orderdate").select("o_custkey", "o_orderkey", "o_totalprice")


@query("latest_one", """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_one_(t):
    return latest_one(t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"), ["o_custkey"],
                      ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("share_of_total", """
SELECT l_orderkey, l_linenumber, l_suppkey, round(sum(l_quantity) OVER (PARTITION BY l_suppkey), 2) AS total,
  round(l_quantity / sum(l_quantity) OVER (PARTITION BY l_suppkey), 6) AS share FROM lineitem""")
def share_of_total(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    return with_group_value(rows, ["l_suppkey"], total=F.sum("l_quantity")).select(
        "l_orderkey", "l_linenumber", "l_suppkey", num("total").alias("total"),
        num(F.col("l_quantity") / F.col("total"), 6).alias("share"))


@query("rolling_mean", ctes(DAILY) + """
SELECT product, CAST(period AS VARCHAR) AS period, round(value, 6) AS value,
  round(avg(value) OVER (PARTITION BY product ORDER BY period ROWS BETWEEN 13 PRECEDING AND CURRENT ROW), 6) AS mean FROM daily""")
def rolling_mean_(t):
    d = daily_prices(t)
    return d.select("product", text("period").alias("period"), num("value", 6).alias("value"),
                    num(rolling_mean(d, ["product"], "period", "value", 14), 6).alias("mean"))


@query("rolling_full_window", ctes(DAILY) + f"""
, r AS (SELECT product, period, count(value) OVER w2 AS n2, avg(value) OVER w2 AS m2, count(value) OVER w60 AS n60,
    stddev_samp(value) OVER w60 AS s60 FROM daily
  WINDOW w2 AS (PARTITION BY product ORDER BY period ROWS BETWEEN 1 PRECEDING AND CURRENT ROW),
    w60 AS (PARTITION BY product ORDER BY period ROWS BETWEEN 59 PRECEDING AND CURRENT ROW))
SELECT product, CAST(period AS VARCHAR) AS period, {settled_sql("CASE WHEN n2 = 2 THEN m2 END", 6)} AS mean_2,
  round(CASE WHEN n60 = 60 THEN s60 END, 6) AS std_60 FROM r""")
def rolling_full_window(t):
    d = daily_prices(t)
    return d.select("product", text("period").alias("period"),
                    settled(rolling_mean(d, ["product"], "period", "value", 2, full_window=True), 6).alias("mean_2"),
                    num(rolling_std(d, ["product"], "period", "value", 60), 6).alias("std_60"))


@query("pct_change", ctes(DAILY) + """
SELECT product, CAST(period AS VARCHAR) AS period,
  round(coalesce(value / lag(value) OVER (PARTITION BY product ORDER BY period) - 1, 0), 6) + 0 AS change FROM daily""")
def pct_change_(t):
    return daily_prices(t).select("product", text("period").alias("period"), num(
        F.coalesce(pct_change(["product"], "period", "value"), F.lit(0.0)), 6).alias("change"))


ROLES = """turns AS (SELECT conv_id, turn, CASE WHEN role <> 'assistant' THEN role END AS section,
  CASE WHEN role = 'assistant' THEN CAST(length(text) AS VARCHAR) END AS size FROM conversations)"""


def turns(t):
    return t.conversations.select(
        "conv_id", "turn", F.when(F.col("role") != "assistant", F.col("role")).alias("section"),
        text(F.when(F.col("role") == "assistant", F.length("text"))).alias("size"))


@query("forward_fill", ctes(ROLES) + """
SELECT conv_id, turn, last_value(section IGNORE NULLS) OVER w AS section, last_value(size IGNORE NULLS) OVER w AS size FROM turns
WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def forward_fill_(t):
    return forward_fill(turns(t), ["conv_id"], "turn", ["section", "size"])


@query("backward_fill", ctes(ROLES) + """
SELECT conv_id, turn, first_value(section IGNORE NULLS) OVER w AS section, first_value(size IGNORE NULLS) OVER w AS size FROM turns
WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""")
def backward_fill_(t):
    return backward_fill(turns(t), ["conv_id"], "turn", ["section", "size"])


@query("volatility_horizons", ctes(DAILY) + """
, c AS (SELECT product, period, coalesce(value / lag(value) OVER (PARTITION BY product ORDER BY period) - 1, 0) AS change,
  row_number() OVER (PARTITION BY product ORDER BY period DESC) AS age FROM daily)
SELECT product, round(stddev_samp(change) FILTER (age <= 252) * 100, 6) AS vol_1y,
  round(stddev_samp(change) FILTER (age <= 756) * 100, 6) AS vol_3y,
  round(stddev_samp(change) FILTER (age <= 1260) * 100, 6) AS vol_5y, round(stddev_samp(change) * 100, 6) AS vol_all
FROM c GROUP BY product""")
def volatility_horizons(t):
    names = {"vol_1y": 252, "vol_3y": 756, "vol_5y": 1260, "vol_all": None}
    return volatility(daily_prices(t), ["product"], "period", "value", names).withColumns({n: num(n, 6) for n in names})


@query("volatility_strict", ctes(MONTHLY) + """
, c AS (SELECT product, value / lag(value) OVER (PARTITION BY product ORDER BY period) - 1 AS change,
  row_number() OVER (PARTITION BY product ORDER BY period DESC) AS age FROM monthly)
SELECT product, CASE WHEN count(change) FILTER (age <= 51) = 51 THEN round(stddev_samp(change) FILTER (age <= 51) * 100, 6) END AS vol_52,
  CASE WHEN count(change) FILTER (age <= 155) = 155 THEN round(stddev_samp(change) FILTER (age <= 155) * 100, 6) END AS vol_156,
  round(stddev_samp(change) * 100, 6) AS vol_all FROM c GROUP BY product""")
def volatility_strict(t):
    names = {"vol_52": 52, "vol_156": 156, "vol_all": None}
    return volatility(monthly_prices(t), ["product"], "period", "value", names, strict=True).withColumns(
        {n: num(n, 6) for n in names})


@query("section_slice", """
WITH s AS (SELECT conv_id, min(turn) AS first_row FROM conversations WHERE role = 'assistant' GROUP BY 1),
e AS (SELECT conv_id, min(turn) AS last_row FROM conversations JOIN s USING (conv_id)
  WHERE role = 'assistant' AND turn > first_row GROUP BY 1)
SELECT conv_id, turn, role FROM conversations JOIN s USING (conv_id) LEFT JOIN e USING (conv_id)
WHERE turn >= first_row AND (last_row IS NULL OR turn <= last_row)""")
def section_slice_(t):
    marker = F.col("role") == "assistant"
    return section_slice(t.conversations.select("conv_id", "turn", "role"), ["conv_id"], "turn", marker, marker)


@query("second_best", """
WITH r AS (SELECT p_partkey, CASE WHEN p_size > 5 THEN CAST(p_size % 10 AS DOUBLE) END AS a, CAST(p_size // 5 AS DOUBLE) AS b,
  CAST(CAST(floor(p_retailprice) AS BIGINT) % 7 AS DOUBLE) AS c FROM part),
long AS (SELECT p_partkey, 'Alpha' AS source, 1 AS pos, a AS v FROM r UNION ALL SELECT p_partkey, 'Beta', 2, b FROM r
  UNION ALL SELECT p_partkey, 'Gamma', 3, c FROM r),
ranked AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY v DESC, pos) AS rank,
  count(*) OVER (PARTITION BY p_partkey) AS n FROM long WHERE v <> 0)
SELECT r.p_partkey, v AS rating, source FROM r LEFT JOIN ranked k ON r.p_partkey = k.p_partkey AND k.rank = least(k.n, 2)""")
def second_best_(t):
    rating, source = second_best({
        "Alpha": F.when(F.col("p_size") > 5, (F.col("p_size") % 10).cast("double")),
        "Beta": F.floor(F.col("p_size") / 5).cast("double"),
        "Gamma": (F.floor("p_retailprice") % 7).cast("double"),
    })
    return t.part.select("p_partkey", rating.alias("rating"), source.alias("source"))


@query("last_two_snapshots", ctes(BALANCES) + """
SELECT CAST(report_day AS VARCHAR) AS report_day, CAST(row_number() OVER (ORDER BY report_day DESC) AS INTEGER) AS position
FROM (SELECT DISTINCT report_day FROM balances) QUALIFY position <= 2""")
def last_two_snapshots(t):
    return last_two_days(balances(t), "ts").select(text("ts").alias("report_day"), "position")
