"""Domain operators: maturities, currencies, rules, comparisons, limits, bonds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.inputs import (
    LEDGER, PARTIES, QUOTES, ctes, ledger, parties, quotes,
)
from ledgerloom.catalog.registry import num, query, settled, settled_sql, text, usd
from ledgerloom.catalog.windows import DAILY, daily_prices
from ledgerloom.functions.columns import any_false, any_null
from ledgerloom.functions.measures import (
    days_to, deal_signs, differs, limit_breach, maturity_bucket, mostly_equal, outside_band, safe_ratio,
)
from ledgerloom.functions.text import to_number
from ledgerloom.operators.dimensions import lookup
from ledgerloom.operators.fx import convert, unwrap_virtual
from ledgerloom.operators.grouping import latest_version, subtotals, with_group_value, without_outliers
from ledgerloom.operators.joins import join_keys
from ledgerloom.operators.quality import compare_profiles, profile
from ledgerloom.operators.reconcile import agreement, difference_profile, drop_mirrored, period_diff
from ledgerloom.operators.rules import Rule, classify_by_table, classify, drop_excluded, mapping_gaps, rule_diff, rule_overlaps, rule_table
from ledgerloom.operators.series import cross_rate
from ledgerloom.sources.tables import literal_table
from ledgerloom.operators.treasury import control_totals, effective_params, impaired, minimum_of_versions, net_bonds

BUCKET = """CASE WHEN days < 30 THEN '<1M' WHEN days < 91 THEN '1M-3M' WHEN days < 182 THEN '3M-6M'
  WHEN days < 365 THEN '6M-1Y' WHEN days < 730 THEN '1Y-2Y' ELSE '2Y+' END"""


@query("maturity_bucket", f"""
WITH x AS (SELECT l_orderkey, l_linenumber, coalesce(date_diff('day', DATE '1998-06-30',
  CASE WHEN l_linestatus = 'F' OR l_returnflag <> 'N' THEN CAST(l_shipdate AS DATE) END), 0) AS days FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(days AS INTEGER) AS days, {BUCKET} AS period FROM x""")
def maturity_bucket_(t):
    due = F.when((F.col("l_linestatus") == "F") | (F.col("l_returnflag") != "N"), F.to_date("l_shipdate"))
    day = F.lit("1998-06-30").cast("date")
    return t.lineitem.select("l_orderkey", "l_linenumber", days_to(due, day).alias("days"),
                             maturity_bucket(due, day).alias("period"))


@query("maturity_by_column", f"""
WITH x AS (SELECT l_orderkey, l_linenumber, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS days
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, CAST(days AS INTEGER) AS days, {BUCKET} AS period FROM x""")
def maturity_by_column(t):
    x = join_keys(t.lineitem, t.orders.select("o_orderkey", "o_orderdate"), {"l_orderkey": "o_orderkey"}, "inner", null_safe=False)
    due, day = F.to_date("l_shipdate"), F.to_date("o_orderdate")
    return x.select("l_orderkey", "l_linenumber", days_to(due, day).alias("days"), maturity_bucket(due, day).alias("period"))


@query("fx_convert_asof", ctes(QUOTES, LEDGER) + """
SELECT document, line_no, currency, amount, CASE WHEN currency = 'USD' THEN 1.0::DOUBLE ELSE round(coef, 6) END AS coef_to_usd,
  round(amount * CASE WHEN currency = 'USD' THEN 1.0::DOUBLE ELSE coef END, 2) AS amount_in_usd
FROM ledger LEFT JOIN usd_rates ON rate_ccy = currency AND rate_day = DATE '1998-06-30'""")
def fx_convert_asof(t):
    out = convert(ledger(t), quotes(t), "USD", "currency", "amount", F.lit("1998-06-30").cast("date"))
    return out.select("document", "line_no", "currency", "amount", F.when(F.col("currency") == "USD", F.lit(1.0)).otherwise(
        num("coef_to_USD", 6)).alias("coef_to_usd"), usd("amount_in_USD").alias("amount_in_usd"))


@query("fx_convert_by_date", ctes(QUOTES, LEDGER) + """
SELECT CAST(due AS VARCHAR) AS due, currency, count(*) AS lines, count(coef) + count(*) FILTER (currency = 'USD') AS converted,
  round(sum(amount * CASE WHEN currency = 'USD' THEN 1.0::DOUBLE ELSE coef END), 2) AS amount_in_usd
FROM ledger LEFT JOIN usd_rates ON rate_ccy = currency AND rate_day = due GROUP BY ALL""")
def fx_convert_by_date(t):
    out = convert(ledger(t), quotes(t), "USD", "currency", "amount", "due")
    return out.groupBy(text("due").alias("due"), "currency").agg(
        F.count(F.lit(1)).alias("lines"), F.count("coef_to_USD").alias("converted"), usd(F.sum("amount_in_USD")).alias("amount_in_usd"))


@query("virtual_currency", """
WITH cur AS (SELECT p_brand AS code, CASE WHEN count(*) > 80 THEN 'USD' ELSE 'CNY' END AS base, avg(p_size) / 100 AS multiplier
  FROM part WHERE p_brand <> 'Brand#7' GROUP BY 1)
SELECT p_brand AS ccy, coalesce(base, p_brand) AS base_ccy, count(*) AS n, round(sum(p_retailprice * coalesce(multiplier, 1)), 2) AS amount_base
FROM part LEFT JOIN cur ON p_brand = code GROUP BY ALL""")
def virtual_currency(t):
    cur = t.part.where(F.col("p_brand") != "Brand#7").groupBy(F.col("p_brand").alias("code")).agg(
        F.when(F.count(F.lit(1)) > 80, "USD").otherwise("CNY").alias("base"), (F.avg("p_size") / 100).alias("multiplier"))
    out = unwrap_virtual(t.part.select(F.col("p_brand").alias("ccy"), F.col("p_retailprice").alias("amount")), cur, "ccy", "amount")
    return out.groupBy("ccy", "base_ccy").agg(F.count(F.lit(1)).alias("n"), num(F.sum("amount_base")).alias("amount_base"))


@query("cross_rate", ctes(DAILY) + """
SELECT product AS pair, CAST(period AS VARCHAR) AS period, round(value, 6) AS value FROM daily
UNION ALL SELECT 'A/R', CAST(a.period AS VARCHAR), round((1 / a.value) * r.value, 6) FROM daily a JOIN daily r ON a.period = r.period
WHERE a.product = 'A' AND r.product = 'R'""")
def cross_rate_(t):
    series = daily_prices(t).withColumnRenamed("product", "pair")
    return cross_rate(series, "pair", "period", "value", "A", "R", "A/R").select(
        "pair", text("period").alias("period"), num("value", 6).alias("value"))


# A rule table in the shape of the ledger rules: source set, report type, codes, accounts, prefixes.
RULES = [
    Rule("Trade receivables", ("ERP", "ECP"), "AR", accounts=("Brand#1", "Brand#12"), prefixes=("Brand#2",)),
    Rule("Other receivables", ("ERP",), "AR", accounts=("Brand#21", "Brand#3", "Brand#4")),
    Rule("Provisions", ("ERP", "ECP"), "AP", prefixes=("Brand#1",)),
    Rule("Trade payables", ("ECP",), "AP", accounts=("Brand#5", "Brand#13"), prefixes=("Brand#25", "Brand#6")),
    Rule("Other payables", ("ERP", "ECP"), "AP", accounts=("Brand#5", "Brand#6", "Brand#7")),
]

RULES_SQL = """CASE
  WHEN source IN ('ERP', 'ECP') AND report_type = 'AR' AND (account IN ('Brand#1', 'Brand#12') OR account LIKE 'Brand#2%') THEN 'Trade receivables'
  WHEN source = 'ERP' AND report_type = 'AR' AND account IN ('Brand#21', 'Brand#3', 'Brand#4') THEN 'Other receivables'
  WHEN source IN ('ERP', 'ECP') AND report_type = 'AP' AND account LIKE 'Brand#1%' THEN 'Provisions'
  WHEN source = 'ECP' AND report_type = 'AP' AND (account IN ('Brand#5', 'Brand#13') OR account LIKE 'Brand#25%' OR account LIKE 'Brand#6%') THEN 'Trade payables'
  WHEN source IN ('ERP', 'ECP') AND report_type = 'AP' AND account IN ('Brand#5', 'Brand#6', 'Brand#7') THEN 'Other payables' END"""

ACCOUNTS = """accounts AS (SELECT l_orderkey AS document, l_linenumber AS line_no, CASE WHEN l_linestatus = 'F' THEN 'ERP' ELSE 'ECP' END AS source,
  CASE WHEN l_returnflag = 'R' THEN 'AR' ELSE 'AP' END AS report_type, p_brand AS account, p_type AS code, l_extendedprice AS amount,
  l_suppkey AS company, CAST(l_shipdate AS DATE) AS due FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def accounts(t):
    """Ledger lines with their account and account code."""
    x = join_keys(t.lineitem, t.part.select("p_partkey", "p_brand", "p_type"), {"l_partkey": "p_partkey"}, "inner", null_safe=False)
    return x.select(
        F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("line_no"),
        F.when(F.col("l_linestatus") == "F", "ERP").otherwise("ECP").alias("source"),
        F.when(F.col("l_returnflag") == "R", "AR").otherwise("AP").alias("report_type"),
        F.col("p_brand").alias("account"), F.col("p_type").alias("code"), F.col("l_extendedprice").alias("amount"),
        F.col("l_suppkey").alias("company"), F.to_date("l_shipdate").alias("due"))


@query("classify_rules", ctes(ACCOUNTS) + f"SELECT document, line_no, account, {RULES_SQL} AS purpose FROM accounts")
def classify_rules(t):
    out = classify_by_table(accounts(t), rule_table(t.spark, RULES), ["source", "report_type", "code"], "account")
    return out.select("document", "line_no", "account", "purpose")


# Lines by code, without a source or a report type, with prefixes of several lengths, and with no account at all.
FULL_RULES = [
    Rule("Coded", codes=("PROMO", "SMALL"), prefixes=("Brand#1", "B")),
    Rule("Any source", report_type="AR", accounts=("Brand#22",), prefixes=("Brand#33",)),
    Rule("Any type", ("ERP",), prefixes=("Brand#4", "Br")),
    Rule("Code and source", ("ECP",), codes=("MEDIUM",)),
    Rule("Whole account", ("ECP",), "AP", accounts=("Brand#55", "Brand#11"), prefixes=("Brand#5", "Brand#12")),
]
FULL_RULES_SQL = """CASE WHEN kind IN ('PROMO', 'SMALL') AND (account LIKE 'Brand#1%' OR account LIKE 'B%') THEN 'Coded'
  WHEN report_type = 'AR' AND (account = 'Brand#22' OR account LIKE 'Brand#33%') THEN 'Any source'
  WHEN source = 'ERP' AND (account LIKE 'Brand#4%' OR account LIKE 'Br%') THEN 'Any type'
  WHEN source = 'ECP' AND kind = 'MEDIUM' THEN 'Code and source'
  WHEN source = 'ECP' AND report_type = 'AP' AND (account IN ('Brand#55', 'Brand#11') OR account LIKE 'Brand#5%' OR account LIKE 'Brand#12%') THEN 'Whole account' END"""


@query("classify_rules_full", ctes(ACCOUNTS) + f"SELECT document, line_no, account, kind, {FULL_RULES_SQL} AS purpose FROM (SELECT *, split_part(code, ' ', 1) AS kind FROM accounts)")
def classify_rules_full(t):
    rows = accounts(t).withColumn("code", F.split("code", " ")[0])
    out = classify_by_table(rows, rule_table(t.spark, FULL_RULES), ["source", "report_type", "code"], "account")
    return out.select("document", "line_no", "account", F.col("code").alias("kind"), "purpose")


@query("classify_rule_list", ctes(ACCOUNTS) + f"SELECT document, line_no, account, coalesce({RULES_SQL}, 'Unknown') AS purpose FROM accounts")
def classify_rule_list(t):
    purpose = classify(RULES, "source", "report_type", "code", "account", "Unknown")
    return accounts(t).select("document", "line_no", "account", purpose.alias("purpose"))


RULE_LINES = """old_rules AS (SELECT DISTINCT p_type AS purpose, p_brand AS account FROM part WHERE p_brand <> 'Brand#11'),
new_rules AS (SELECT DISTINCT p_type AS purpose, p_brand AS account FROM part WHERE p_type NOT LIKE 'PROMO%')"""


def rule_lines(t):
    cols = [F.col("p_type").alias("purpose"), F.col("p_brand").alias("account")]
    return (t.part.where(F.col("p_brand") != "Brand#11").select(*cols).distinct(), t.part.where(~F.col("p_type").startswith("PROMO")).select(*cols).distinct())


@query("rule_diff", ctes(RULE_LINES) + """
SELECT purpose, account, 'only_old' AS side FROM (SELECT * FROM old_rules EXCEPT SELECT * FROM new_rules)
UNION ALL SELECT purpose, account, 'only_new' FROM (SELECT * FROM new_rules EXCEPT SELECT * FROM old_rules)""")
def rule_diff_(t):
    old, new = rule_lines(t)
    return rule_diff(old, new, ["purpose", "account"])


@query("rule_overlaps", """
SELECT p_brand AS account, count(DISTINCT p_type) AS n_purposes, min(p_size) AS first_priority FROM part
GROUP BY 1 HAVING count(DISTINCT p_type) > 1""")
def rule_overlaps_(t):
    lines = t.part.select(
        F.col("p_brand").alias("account"), F.col("p_type").alias("purpose"), F.col("p_size").alias("priority"))
    return rule_overlaps(lines, ["account"])


@query("rules_without_excluded", ctes(RULE_LINES) + """
SELECT o.purpose, o.account FROM old_rules o WHERE NOT EXISTS (SELECT 1 FROM new_rules n WHERE n.purpose = o.purpose AND n.account = o.account)""")
def rules_without_excluded(t):
    old, new = rule_lines(t)
    return drop_excluded(old, new, ["purpose", "account"])


@query("mapping_gaps", ctes(PARTIES) + """
SELECT DISTINCT 'counterparty' AS "check", party_name AS key, CAST(party AS VARCHAR) AS code, coalesce(party_segment, 'External') AS segment
FROM parties WHERE market IN ('FURNITURE', 'BUILDING') AND party_segment IS NULL
UNION ALL SELECT DISTINCT 'holding', party_holding, coalesce(party_segment, 'External'), NULL FROM parties
WHERE market <> 'FURNITURE' AND party_balance < 0""")
def mapping_gaps_(t):
    p = parties(t).withColumn("segment", F.coalesce("party_segment", F.lit("External")))
    return mapping_gaps(p, {
        "counterparty": (F.col("market").isin("FURNITURE", "BUILDING") & (F.col("segment") == "External"), ["party_name", "party", "segment"]),
        "holding": ((F.col("market") != "FURNITURE") & (F.col("party_balance") < 0), ["party_holding", "segment"]),
    })


TWO_COPIES = """copies AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS a,
  CASE WHEN o_orderpriority = '1-URGENT' THEN NULL WHEN o_orderpriority = '2-HIGH' THEN -o_totalprice
    WHEN o_totalprice > 250000 THEN o_totalprice * 1.8 ELSE o_totalprice END AS b FROM orders)"""


def two_copies(t):
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    return t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", price).alias("a"),
        F.when(priority == "1-URGENT", None).when(priority == "2-HIGH", -price).when(price > 250000, price * 1.8).otherwise(price).alias("b"))


@query("approx_equal", ctes(TWO_COPIES) + """
SELECT o_orderkey, coalesce(abs(abs(a) - abs(b)) / nullif(greatest(abs(a), abs(b)), 0) >= 0.4, false) AS differs,
  coalesce(abs(abs(coalesce(a, 0)) - abs(coalesce(b, 0))) / nullif(greatest(abs(coalesce(a, 0)), abs(coalesce(b, 0))), 0) >= 0.4, false) AS differs_filled
FROM copies""")
def approx_equal(t):
    zero = F.lit(0.0)
    return two_copies(t).select("o_orderkey", differs("a", "b").alias("differs"),
                                differs(F.coalesce("a", zero), F.coalesce("b", zero)).alias("differs_filled"))


@query("metric_compare", ctes(TWO_COPIES) + """
SELECT o_orderkey, a = b OR abs(a - b) / nullif(greatest(abs(a), abs(b)), 0) <= 0.4 AS mostly_equal, a = b AS equal FROM copies
WHERE a IS NOT NULL AND b IS NOT NULL""")
def metric_compare(t):
    return two_copies(t).where(~any_null(["a", "b"])).select(
        "o_orderkey", mostly_equal("a", "b").alias("mostly_equal"), (F.col("a") == F.col("b")).alias("equal"))


@query("ratio_band", ctes(TWO_COPIES, """filled AS (SELECT o_orderkey, abs(coalesce(a, 0)) AS a, abs(coalesce(b, 0)) AS b FROM copies)""") + """
SELECT o_orderkey, CASE WHEN b = 0 THEN true ELSE a / nullif(b, 0) < 0.7 OR a / nullif(b, 0) > 1.3 END AS huge_diff FROM filled WHERE NOT (a = 0 AND b = 0)""")
def ratio_band(t):
    filled = two_copies(t).na.fill(0.0, subset=["a", "b"])
    return filled.select("o_orderkey", outside_band("a", "b").alias("huge_diff")).where(F.col("huge_diff").isNotNull())


@query("period_diff", """
WITH a AS (SELECT o_custkey, sum(o_totalprice) AS v FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1),
b AS (SELECT o_custkey, sum(o_totalprice) AS v FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1),
j AS (SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.v, 0) AS o, coalesce(b.v, 0) AS n FROM a FULL JOIN b USING (o_custkey))
SELECT o_custkey, round(o, 2) AS o_totalprice_old, round(n, 2) AS o_totalprice_new, round(n - o, 2) + 0 AS o_totalprice_diff,
  round(coalesce(sign(n - o) * abs((n - o) / nullif(o, 0)), 0), 6) + 0 AS o_totalprice_pct_diff FROM j""")
def period_diff_(t):
    year = F.year("o_orderdate")
    out = period_diff(t.orders.where(year == 1997), t.orders.where(year == 1998), ["o_custkey"], "o_totalprice")
    return out.withColumns({c: num(c) for c in ("o_totalprice_old", "o_totalprice_new", "o_totalprice_diff")}).withColumn(
        "o_totalprice_pct_diff", num("o_totalprice_pct_diff", 6))


PROFILE_SQL = """
SELECT '{c}' AS "column", '{ty}' AS type, 5 AS n_columns, count(*) FILTER ({c} IS NULL) AS nulls, {s} AS sum, count(*) AS rows,
  count(*) FILTER (coalesce(try_cast(event_id AS DOUBLE) = 0, false) AND coalesce(try_cast(user_id AS DOUBLE) = 0, false)
    AND coalesce(try_cast(event_type AS DOUBLE) = 0, false) AND coalesce(value = 0, false) AND coalesce(try_cast(props AS DOUBLE) = 0, false)) AS zero_rows
FROM {src}"""
PROFILE_COLS = [("event_id", "bigint", "CAST(sum(event_id) AS DOUBLE)"), ("user_id", "bigint", "CAST(sum(user_id) AS DOUBLE)"),
                ("event_type", "string", "0.0::DOUBLE"), ("value", "double", "round(sum(value), 2)"), ("props", "string", "0.0::DOUBLE")]
PROFILE = " UNION ALL ".join(PROFILE_SQL.format(c=c, ty=ty, s=s, src="events") for c, ty, s in PROFILE_COLS)
PROFILED = ["event_id", "user_id", "event_type", "value", "props"]


@query("column_profile", PROFILE)
def column_profile(t):
    return profile(t.events, PROFILED).withColumn("sum", num("sum"))


def _half_sql(cond: str) -> str:
    src = f"(SELECT event_id, user_id, CASE WHEN {cond} THEN NULL ELSE event_type END AS event_type, value, props FROM events WHERE {cond} OR event_type = 'view')"
    return " UNION ALL ".join(PROFILE_SQL.format(c=c, ty=ty, s=s, src=src) for c, ty, s in PROFILE_COLS)


@query("profile_compare", f"""WITH o AS ({_half_sql("ts < TIMESTAMP '2024-01-16'")}), n AS ({_half_sql("ts >= TIMESTAMP '2024-01-10'")})
SELECT o."column", o.type AS type_old, n.type AS type_new, o.n_columns AS n_columns_old, n.n_columns AS n_columns_new, o.nulls AS nulls_old, n.nulls AS nulls_new,
  o.sum AS sum_old, n.sum AS sum_new, o.rows AS rows_old, n.rows AS rows_new, o.zero_rows AS zero_rows_old, n.zero_rows AS zero_rows_new,
  coalesce(o.nulls = n.nulls OR abs(o.nulls - n.nulls) / greatest(o.nulls, n.nulls) <= 0.4, false) AS nulls_equal,
  coalesce(o.sum = n.sum OR abs(o.sum - n.sum) / greatest(abs(o.sum), abs(n.sum)) <= 0.4, false) AS sum_equal,
  coalesce(o.rows = n.rows OR abs(o.rows - n.rows) / greatest(o.rows, n.rows) <= 0.4, false) AS rows_equal,
  coalesce(o.zero_rows = n.zero_rows OR abs(o.zero_rows - n.zero_rows) / greatest(o.zero_rows, n.zero_rows) <= 0.4, false) AS zero_rows_equal,
  o.type = n.type AS type_equal, o.n_columns = n.n_columns AS n_columns_equal
FROM o FULL JOIN n ON o."column" = n."column" """)
def profile_compare(t):
    def half(cond):
        kept = t.events.where(cond | (F.col("event_type") == "view")).withColumn(
            "event_type", F.when(cond, None).otherwise(F.col("event_type")))
        return profile(kept, PROFILED).withColumn("sum", num("sum"))

    day = lambda d: F.lit(d).cast("timestamp_ntz")
    return compare_profiles(half(F.col("ts") < day("2024-01-16")), half(F.col("ts") >= day("2024-01-10")))


PD = """pd AS (SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal > 2000 THEN c_acctbal / 100000 END AS pd FROM customer)"""


def default_rates(t):
    return t.customer.select("c_custkey", "c_nationkey", F.when(F.col("c_acctbal") > 2000, F.col("c_acctbal") / 100000).alias("pd"))


@query("impute_group_mean", ctes(PD) + f"""
SELECT c_custkey, c_nationkey, {settled_sql("coalesce(pd, avg(pd) OVER (PARTITION BY c_nationkey))", 6)} AS pd FROM pd""")
def impute_group_mean(t):
    return with_group_value(default_rates(t), ["c_nationkey"], mean=F.avg("pd")).select(
        "c_custkey", "c_nationkey", settled(F.coalesce("pd", "mean"), 6).alias("pd"))


@query("impute_report", ctes(PD) + """
SELECT c_nationkey, pd IS NOT NULL AS have_data, count(*) AS n, round(avg(pd), 6) AS mean_pd FROM pd GROUP BY 1, 2""")
def impute_report(t):
    return default_rates(t).groupBy("c_nationkey", F.col("pd").isNotNull().alias("have_data")).agg(
        F.count(F.lit(1)).alias("n"), num(F.avg("pd"), 6).alias("mean_pd"))


@query("rating_normalise", """
WITH x AS (SELECT p_partkey, CASE WHEN p_size < 40 THEN CAST(p_size AS VARCHAR) ELSE p_type END AS rating FROM part),
scale AS (SELECT p_size AS points, min(p_type) AS letter FROM part WHERE p_size < 30 GROUP BY 1)
SELECT p_partkey, rating, CASE WHEN try_cast(rating AS DOUBLE) IS NULL THEN rating ELSE letter END AS letter
FROM x LEFT JOIN scale ON try_cast(rating AS DOUBLE) = points""")
def rating_normalise(t):
    x = t.part.select("p_partkey", F.when(F.col("p_size") < 40, text("p_size")).otherwise(F.col("p_type")).alias("rating"))
    scale = t.part.where(F.col("p_size") < 30).groupBy(F.col("p_size").cast("double").alias("points")).agg(F.min("p_type").alias("letter"))
    found = lookup(x.withColumn("number", to_number("rating")), scale, {"number": "points"}, ["letter"], ["letter"])
    return found.select("p_partkey", "rating", F.when(F.col("number").isNull(), F.col("rating")).otherwise(F.col("letter")).alias("letter"))


@query("iqr_filter", """
WITH x AS (SELECT l_suppkey, l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS amount, sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL),
q AS (SELECT quantile_cont(amount, 0.25) AS a1, quantile_cont(amount, 0.75) AS a3, quantile_cont(quantity, 0.25) AS q1, quantile_cont(quantity, 0.75) AS q3 FROM x)
SELECT x.* FROM x, q WHERE amount BETWEEN a1 - 1.5 * (a3 - a1) AND a3 + 1.5 * (a3 - a1) AND quantity BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")
def iqr_filter(t):
    x = t.lineitem.groupBy("l_suppkey", "l_returnflag", "l_linestatus").agg(
        num(F.sum("l_extendedprice")).alias("amount"), F.sum("l_quantity").alias("quantity"))
    return without_outliers(x, ["amount", "quantity"])


# Threshold and early trigger per group, before and from a change date.
PARAMS = [("F", "1900-01-01", "1998-07-01", 70.0, 159.0), ("F", "1998-07-01", None, 71.0, 154.0),
          ("O", "1900-01-01", "1998-07-01", 159.0, 273.0), ("O", "1998-07-01", None, 161.0, 289.0)]
PARAMS_SQL = """params(o_orderstatus, valid_from, valid_to, threshold, early_trigger) AS (VALUES
  ('F', DATE '1900-01-01', DATE '1998-07-01', 70.0::DOUBLE, 159.0::DOUBLE), ('F', DATE '1998-07-01', NULL, 71.0, 154.0),
  ('O', DATE '1900-01-01', DATE '1998-07-01', 159.0, 273.0), ('O', DATE '1998-07-01', NULL, 161.0, 289.0))"""


def params(t, key: str):
    return literal_table(t.spark, PARAMS, f"{key} string, valid_from date, valid_to date, threshold double, early_trigger double")


@query("effective_params", ctes(PARAMS_SQL) + """
SELECT o_orderkey, o_orderstatus, threshold, early_trigger FROM orders LEFT JOIN params p USING (o_orderstatus)
WHERE p.threshold IS NULL OR (CAST(o_orderdate AS DATE) >= valid_from AND (valid_to IS NULL OR CAST(o_orderdate AS DATE) < valid_to))""")
def effective_params_(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))
    return effective_params(rows, params(t, "o_orderstatus"), "o_orderstatus", "day", ["threshold", "early_trigger"]).drop("day")


LIMITS = """limits AS (SELECT s_nationkey AS bank, sum(CASE WHEN s_acctbal > 8500 THEN 0 ELSE s_acctbal END) / 1000 AS "limit" FROM supplier
  WHERE s_nationkey < 22 GROUP BY 1),
used AS (SELECT c_nationkey AS bank, c_mktsegment AS status, sum(c_acctbal) / 10000 AS used FROM customer GROUP BY ALL)"""


def limits_and_use(t):
    limits = t.supplier.where(F.col("s_nationkey") < 22).groupBy(F.col("s_nationkey").alias("bank")).agg(
        (F.sum(F.when(F.col("s_acctbal") > 8500, 0.0).otherwise(F.col("s_acctbal"))) / 1000).alias("limit"))
    used = t.customer.groupBy(F.col("c_nationkey").alias("bank"), F.col("c_mktsegment").alias("status")).agg(
        (F.sum("c_acctbal") / 10000).alias("used"))
    return lookup(used, limits, "bank", {"limit": "limit"}, ["limit"])


@query("limit_usage", ctes(LIMITS) + """
SELECT bank, status, round(used, 6) AS used, round("limit", 6) AS "limit", round(coalesce(used / nullif("limit", 0) * 100, 0), 6) AS usage
FROM used LEFT JOIN limits USING (bank)""")
def limit_usage(t):
    return limits_and_use(t).select("bank", "status", num("used", 6).alias("used"), num("limit", 6).alias("limit"),
                                    num(safe_ratio("used", "limit", 100.0), 6).alias("usage"))


@query("limit_breach", ctes(LIMITS) + """
SELECT bank, status, CASE WHEN used - "limit" IS NULL OR used <= "limit" THEN 'ok'
  WHEN used - "limit" > "limit" * 0.1 OR used - "limit" > 10 THEN 'significant' ELSE 'insignificant' END AS breach FROM used LEFT JOIN limits USING (bank)""")
def limit_breach_(t):
    return limits_and_use(t).select("bank", "status", limit_breach("used", "limit").alias("breach"))


@query("deal_signs", """
SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN q WHEN 'R' THEN -q ELSE q END AS quantity,
  round(CASE l_returnflag WHEN 'A' THEN -q * l_extendedprice ELSE q * l_extendedprice END, 2) AS money
FROM (SELECT *, CASE WHEN l_quantity > 5 THEN l_quantity ELSE l_linenumber * 1.0::DOUBLE END AS q FROM lineitem)""")
def deal_signs_(t):
    actual = F.when(F.col("l_quantity") > 5, F.col("l_quantity"))
    q = F.coalesce(actual, F.col("l_linenumber").cast("double"))
    quantity, money = deal_signs("l_returnflag", q, q * F.col("l_extendedprice"), purchase="A", sale="R")
    return t.lineitem.select("l_orderkey", "l_linenumber", quantity.alias("quantity"), num(money).alias("money"))


BONDS = """bonds AS (SELECT l_orderkey AS deal_set, CASE WHEN l_linenumber = 1 THEN 'ISSUED' ELSE 'TRADED' END AS owner,
  CASE WHEN l_linenumber = 1 THEN CAST(l_orderkey // 100 AS VARCHAR) ELSE CAST(l_suppkey AS VARCHAR) END AS entity, l_returnflag AS grp, l_linestatus AS party,
  l_extendedprice AS amount, l_quantity AS amount_usd FROM lineitem)"""


def bonds(t):
    issued = F.col("l_linenumber") == 1
    return t.lineitem.select(
        F.col("l_orderkey").alias("deal_set"), F.when(issued, "ISSUED").otherwise("TRADED").alias("owner"),
        F.when(issued, F.floor(F.col("l_orderkey") / 100).cast("string")).otherwise(text("l_suppkey")).alias("entity"),
        F.col("l_returnflag").alias("grp"), F.col("l_linestatus").alias("party"), F.col("l_extendedprice").alias("amount"),
        F.col("l_quantity").alias("amount_usd"))


NETTED = """issued AS (SELECT deal_set, entity, grp, party FROM bonds WHERE owner = 'ISSUED' GROUP BY ALL),
valid AS (SELECT deal_set, any_value(entity) AS entity, any_value(grp) AS grp, any_value(party) AS party FROM issued GROUP BY 1 HAVING count(*) = 1),
netted AS (SELECT v.deal_set, 'ISSUED' AS owner, v.entity, v.grp, v.party, sum(amount) AS amount, sum(amount_usd) AS amount_usd
  FROM valid v JOIN bonds b USING (deal_set) GROUP BY ALL
UNION ALL SELECT b.deal_set, owner, b.entity, b.grp, v.entity, amount, amount_usd FROM bonds b JOIN valid v USING (deal_set) WHERE owner = 'TRADED')"""


@query("bond_netting", ctes(BONDS, NETTED) + """
SELECT deal_set, owner, entity, grp, party, round(amount, 2) AS amount, amount_usd FROM netted""")
def bond_netting(t):
    return net_bonds(bonds(t), ["deal_set"], "owner", "ISSUED", "TRADED", ["entity", "grp"], "party", ["amount", "amount_usd"]).withColumn(
        "amount", num("amount"))


@query("mirror_dedupe", ctes("""pairs AS (SELECT DISTINCT s_nationkey AS a, c_nationkey AS b, c_mktsegment AS ccy, c_acctbal < 3000 AS only_right
  FROM supplier JOIN customer ON s_suppkey = c_custkey)""") + """
SELECT * FROM pairs x WHERE NOT (only_right AND EXISTS (SELECT 1 FROM pairs y WHERE y.a = x.b AND y.b = x.a AND y.ccy = x.ccy))""")
def mirror_dedupe(t):
    pairs = t.supplier.join(t.customer, F.col("s_suppkey") == F.col("c_custkey")).select(
        F.col("s_nationkey").alias("a"), F.col("c_nationkey").alias("b"), F.col("c_mktsegment").alias("ccy"),
        (F.col("c_acctbal") < 3000).alias("only_right")).distinct()
    return drop_mirrored(pairs, "a", "b", ["ccy"], "only_right")


@query("impaired_balance", """
WITH ecl AS (SELECT l_suppkey, l_returnflag, round_even(avg(l_tax) * 3, 3) AS impairment FROM lineitem GROUP BY ALL HAVING max(l_quantity) >= 50)
SELECT l_suppkey, l_returnflag, round(coalesce(impairment, 0), 3) AS impairment, round(sum(l_extendedprice) * (1 - coalesce(impairment, 0)), 2) AS balance
FROM lineitem LEFT JOIN ecl USING (l_suppkey, l_returnflag) GROUP BY l_suppkey, l_returnflag, impairment""")
def impaired_balance(t):
    keys = ["l_suppkey", "l_returnflag"]
    ecl = t.derived("impairment", lambda: t.lineitem.groupBy(*keys).agg(
        F.bround(F.avg("l_tax") * 3, 3).alias("impairment"), F.max("l_quantity").alias("most")).where("most >= 50").drop("most"))
    held = t.lineitem.groupBy(*keys).agg(F.sum("l_extendedprice").alias("held"))
    both = lookup(held, ecl, {k: k for k in keys}, ["impairment"], ["impairment"])
    return both.select(*keys, num(F.coalesce("impairment", F.lit(0.0)), 3).alias("impairment"),
                       num(impaired(both, "held", "impairment")).alias("balance"))


@query("version_minimum", """
WITH w AS (SELECT l_suppkey, l_linestatus AS holding, coalesce(sum(l_extendedprice) FILTER (l_returnflag = 'A'), 0) AS a,
  coalesce(sum(l_extendedprice) FILTER (l_returnflag = 'N'), 0) AS n, coalesce(sum(l_extendedprice) FILTER (l_returnflag = 'R'), 0) AS r FROM lineitem GROUP BY ALL),
m AS (SELECT l_suppkey, holding, CASE holding WHEN 'F' THEN least(a, n) WHEN 'O' THEN least(n, r) END AS amount FROM w)
SELECT l_suppkey, holding, round(amount, 2) AS amount FROM m WHERE amount <> 0""")
def version_minimum(t):
    rows = t.lineitem.withColumnRenamed("l_linestatus", "holding")
    return minimum_of_versions(rows, ["l_suppkey"], "holding", "l_returnflag", "l_extendedprice", {"F": ("A", "N"), "O": ("N", "R")}).select(
        "l_suppkey", "holding", num("amount").alias("amount"))


@query("stock_driven_sales", """
WITH stock AS (SELECT l_partkey, l_quantity - 25 AS q FROM lineitem),
s AS (SELECT l_partkey FROM stock GROUP BY 1 HAVING min(q) < avg(q) AND min(q) < -23)
SELECT l_partkey, l_returnflag, l_linestatus, sum(l_quantity) AS quantity, round(sum(l_extendedprice), 2) AS money FROM lineitem
WHERE l_partkey IN (SELECT l_partkey FROM s) GROUP BY ALL""")
def stock_driven_sales(t):
    stock = t.lineitem.select(F.col("l_partkey").alias("item"), (F.col("l_quantity") - 25).alias("q")).groupBy("item").agg(
        F.min("q").alias("low"), F.avg("q").alias("mean")).where((F.col("low") < F.col("mean")) & (F.col("low") < -23))
    sold = t.lineitem.groupBy("l_partkey", "l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("quantity"), num(F.sum("l_extendedprice")).alias("money"))
    return sold.join(stock, F.col("l_partkey") == F.col("item"), "left_semi")


@query("control_totals", """
WITH stated AS (SELECT o_custkey, sum(o_totalprice) AS stated FROM orders GROUP BY 1),
a AS (SELECT o_custkey, sum(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice * 0.97 ELSE o_totalprice END) AS actual FROM orders GROUP BY 1)
SELECT o_custkey, round(stated, 2) AS stated, round(actual, 4) AS actual, abs(stated - actual) / greatest(stated, actual) < 0.01 AS ok
FROM stated JOIN a USING (o_custkey)""")
def control_totals_(t):
    stated = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("stated"))
    rows = t.orders.withColumn("value", F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_totalprice") * 0.97).otherwise(F.col("o_totalprice")))
    out = control_totals(rows, stated, ["o_custkey"], "value", "stated")
    return out.withColumns({"stated": num("stated"), "actual": num("actual", 4)})


@query("attribute_agreement", """
WITH a AS (SELECT c_name AS code, c_nationkey AS nation, c_acctbal > 0 AS solvent FROM customer),
b AS (SELECT replace(s_name, 'Supplier', 'Customer') AS code, s_nationkey AS unit_nation, s_acctbal > 0 AS unit_solvent FROM supplier)
SELECT coalesce(a.code, b.code) AS code, CAST(nation AS VARCHAR) AS nation, CAST(unit_nation AS VARCHAR) AS unit_nation,
  CAST(solvent AS VARCHAR) AS solvent, CAST(unit_solvent AS VARCHAR) AS unit_solvent, coalesce(nation = unit_nation, false) AS nation_equal,
  coalesce(solvent = unit_solvent, false) AS solvent_equal FROM a FULL JOIN b ON a.code = b.code
WHERE NOT coalesce(nation = unit_nation, false) OR NOT coalesce(solvent = unit_solvent, false)""")
def attribute_agreement(t):
    a = t.customer.select(F.col("c_name").alias("code"), F.col("c_nationkey").alias("nation"), (F.col("c_acctbal") > 0).alias("solvent"))
    b = t.supplier.select(F.regexp_replace("s_name", "Supplier", "Customer").alias("code"), F.col("s_nationkey").alias("unit_nation"),
                          (F.col("s_acctbal") > 0).alias("unit_solvent"))
    both = agreement(a, b, ["code"], {"nation": "unit_nation", "solvent": "unit_solvent"})
    return both.where(any_false(["nation_equal", "solvent_equal"])).withColumns(
        {c: text(c) for c in ("nation", "unit_nation", "solvent", "unit_solvent")})


@query("difference_profile", """
WITH gone AS (SELECT * FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_totalprice > 100000))
SELECT 'l_suppkey' AS "column", count(l_suppkey)::BIGINT AS n_rows, count(DISTINCT l_suppkey) AS n_unique FROM gone
UNION ALL SELECT 'l_returnflag', count(l_returnflag), count(DISTINCT l_returnflag) FROM gone
UNION ALL SELECT 'l_quantity', count(l_quantity), count(DISTINCT l_quantity) FROM gone""")
def difference_profile_(t):
    known = t.orders.where(F.col("o_totalprice") > 100000).select("o_orderkey")
    gone = t.lineitem.join(known, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")
    return difference_profile(gone, ["l_suppkey", "l_returnflag", "l_quantity"])


@query("exclusion_latest", """
WITH x AS (SELECT o_custkey, o_orderkey, o_orderdate, nullif(o_orderpriority, '5-LOW') AS supplier, nullif(o_orderstatus, 'P') AS mediator, o_orderstatus, o_totalprice FROM orders),
kept AS (SELECT * FROM x WHERE NOT (supplier IS NULL AND mediator IS NULL) AND NOT (supplier IS NULL AND o_totalprice > 400000))
SELECT o_custkey, o_orderkey FROM kept QUALIFY o_orderdate = max(o_orderdate) OVER (PARTITION BY o_custkey)""")
def exclusion_latest(t):
    x = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("supplier"),
                        F.nullif("o_orderstatus", F.lit("P")).alias("mediator"))
    no_supplier = F.col("supplier").isNull()
    kept = x.where(~(no_supplier & (F.col("mediator").isNull() | (F.col("o_totalprice") > 400000))))
    return latest_version(kept, ["o_custkey"], "o_orderdate").select("o_custkey", "o_orderkey")


@query("price_volume", """
WITH s AS (SELECT l_partkey AS product, -sum(l_quantity) AS sales FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
p AS (SELECT l_partkey AS product, sum(l_quantity) AS purchases FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
j AS (SELECT coalesce(s.product, p.product) AS product, sales, purchases FROM s FULL JOIN p ON s.product = p.product),
v AS (SELECT CAST(product AS VARCHAR) AS product, p_retailprice AS price, sales, purchases, p_retailprice * sales AS amount_sales, p_retailprice * purchases AS amount_purchases
  FROM j LEFT JOIN part ON product = p_partkey)
SELECT product, round(coalesce(sum(price), 0), 2) AS price, coalesce(sum(sales), 0) AS sales, coalesce(sum(purchases), 0) AS purchases,
  round(coalesce(sum(amount_sales), 0), 2) AS amount_sales, round(coalesce(sum(amount_purchases), 0), 2) AS amount_purchases, 0 AS level FROM v GROUP BY product
UNION ALL SELECT 'Total', round(sum(price), 2), sum(sales), sum(purchases), round(sum(amount_sales), 2), round(sum(amount_purchases), 2), 1 FROM v""")
def price_volume(t):
    sales = t.lineitem.where(F.col("l_returnflag") == "R").groupBy(F.col("l_partkey").alias("product")).agg((-F.sum("l_quantity")).alias("sales"))
    bought = t.lineitem.where(F.col("l_returnflag") == "A").groupBy(F.col("l_partkey").alias("product")).agg(F.sum("l_quantity").alias("purchases"))
    both = lookup(join_keys(sales, bought, ["product"], "full"), t.part, {"product": "p_partkey"}, {"p_retailprice": "price"}, ["p_name"])
    valued = both.withColumns({
        "amount_sales": F.col("price") * F.col("sales"), "amount_purchases": F.col("price") * F.col("purchases"), "product": text("product")})
    cols = ["price", "sales", "purchases", "amount_sales", "amount_purchases"]
    return subtotals(valued, ["product"], cols).withColumns({c: num(c) for c in ("price", "amount_sales", "amount_purchases")})
