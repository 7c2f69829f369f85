"""End-to-end reports on stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.checks import CHANGES
from ledgerloom.catalog.domain import BUCKET, RULES, RULES_SQL
from ledgerloom.catalog.inputs import (
    BALANCES, COMPANIES, NATIONS, QUOTES, REGIONS, balances, companies, ctes, quotes,
)
from ledgerloom.catalog.joins import DAYS, GRID, MULTIKEY
from ledgerloom.catalog.registry import num, query, settled, settled_sql, text, usd
from ledgerloom.operators.fx import iso_code
from ledgerloom.operators.joins import join_keys
from ledgerloom.operators.rules import classify
from ledgerloom.plans import markets, monitoring, positions
from ledgerloom.plans.entities import Entities

NAMES = """names AS (SELECT s_name AS name, CAST(s_suppkey AS VARCHAR) AS code FROM supplier
  UNION ALL SELECT c_name, 'Z' || c_nationkey FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'),
hold AS (SELECT id AS k, 1 AS p, holding, unit_key FROM companies UNION ALL SELECT short_code, 2, holding, unit_key FROM companies
  UNION ALL SELECT plant_code, 3, holding, unit_key FROM companies),
best_hold AS (SELECT k, holding FROM hold QUALIFY row_number() OVER (PARTITION BY k ORDER BY p DESC, unit_key) = 1)"""
ENTITY = [COMPANIES, MULTIKEY, NAMES]


def entities(t) -> Entities:
    suppliers = t.supplier.select(F.col("s_name").alias("name"), text("s_suppkey").alias("code"))
    customers = t.customer.where(F.col("c_mktsegment") != "HOUSEHOLD").select(
        F.col("c_name").alias("name"), F.concat(F.lit("Z"), F.col("c_nationkey")).alias("code"))
    return Entities(companies(t), suppliers.unionByName(customers))


def supplier_name(key: str = "l_suppkey"):
    return F.concat(F.lit("Supplier#"), F.lpad(text(key), 9, "0"))


def customer_name(key: str):
    return F.concat(F.lit("Customer#"), F.lpad(text(key), 9, "0"))


SUPPLIER_NAME = "'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0')"
CURRENCY_SQL = "CASE l_returnflag WHEN 'R' THEN 'EUR' WHEN 'A' THEN 'CHF' ELSE 'USD' END"


def currency():
    """Currency of a line, some under technical codes."""
    return F.when(F.col("l_returnflag") == "R", "EUR").when(
        F.col("l_returnflag") == "A", F.when(F.col("l_linestatus") == "F", "RUC").otherwise("CHF")).otherwise("USD")


def day(value: str):
    return F.lit(value).cast("date")


def lines_with_customer(t):
    """Lines with the order's day and customer."""
    return join_keys(t.lineitem, t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_day")),
                     {"l_orderkey": "o_orderkey"}, "inner", null_safe=False)


# --- liquidity -------------------------------------------------------------------------------

LIQUIDITY_PARAMS = [
    ("AFRICA", "1900-01-01", "1998-07-01", 0.3, 0.5), ("AFRICA", "1998-07-01", None, 0.4, 0.6),
    ("AMERICA", "1900-01-01", None, 0.2, 0.4), ("ASIA", "1900-01-01", None, 0.5, 0.7), ("EUROPE", "1900-01-01", None, 0.6, 0.9),
]
LIQUIDITY_PARAMS_SQL = """params(holding, valid_from, valid_to, threshold, early_trigger) AS (VALUES
  ('AFRICA', DATE '1900-01-01', DATE '1998-07-01', 0.3::DOUBLE, 0.5::DOUBLE), ('AFRICA', DATE '1998-07-01', NULL, 0.4, 0.6),
  ('AMERICA', DATE '1900-01-01', NULL, 0.2, 0.4), ('ASIA', DATE '1900-01-01', NULL, 0.5, 0.7), ('EUROPE', DATE '1900-01-01', NULL, 0.6, 0.9))"""

PLACES = """places AS (SELECT c_custkey, c_mktsegment, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def places(t):
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "c_mktsegment", "r_name")


@query("report_liquidity", ctes(QUOTES, *ENTITY, LIQUIDITY_PARAMS_SQL, PLACES, """
cash AS (SELECT CAST(o_orderdate AS DATE) AS report_day, r_name AS holding, sum(o_totalprice) AS cash FROM orders JOIN places ON o_custkey = c_custkey
  WHERE o_orderstatus <> 'P' AND c_mktsegment <> 'FURNITURE' GROUP BY ALL)""", """
drawn AS (SELECT CAST(o_orderdate AS DATE) AS report_day, r_name AS holding, sum(o_totalprice) AS drawn FROM orders JOIN places ON o_custkey = c_custkey
  WHERE o_orderstatus = 'P' GROUP BY ALL)""", """
limits AS (SELECT holding, sum(credit) * 100 AS "limit" FROM companies GROUP BY 1)""", f"""
due AS (SELECT CAST(o_orderdate AS DATE) AS report_day, ch.holding AS holding, {CURRENCY_SQL} AS ccy, -l_extendedprice AS amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN names cn ON cn.name = {SUPPLIER_NAME} LEFT JOIN best_hold ch ON ch.k = cn.code
  LEFT JOIN names pn ON pn.name = 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') LEFT JOIN best_hold ph ON ph.k = pn.code
  WHERE date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) <= 7 AND l_linestatus = 'O' AND l_returnflag <> 'N'
    AND ch.holding <> coalesce(ph.holding, 'External'))""", """
outflow AS (SELECT report_day, holding, coalesce(sum(amount * CASE WHEN ccy = 'USD' THEN 1 ELSE coef END), 0) AS outflow
  FROM due LEFT JOIN usd_rates ON rate_day = report_day AND rate_ccy = ccy GROUP BY ALL)""", """
joined AS (SELECT cash.report_day, cash.holding, cash, ("limit" - coalesce(drawn, 0)) * coef AS available, threshold, early_trigger,
  CAST(trunc(round(coalesce(outflow, 0), 4)) AS BIGINT) / 1e6 AS debt_outflow
  FROM cash LEFT JOIN drawn USING (report_day, holding) LEFT JOIN limits USING (holding)
  LEFT JOIN usd_rates ON rate_day = cash.report_day AND rate_ccy = 'RUB'
  LEFT JOIN params p ON p.holding = cash.holding AND cash.report_day >= valid_from AND (valid_to IS NULL OR cash.report_day < valid_to)
  LEFT JOIN outflow o ON o.report_day = cash.report_day AND o.holding = cash.holding)""") + """
SELECT CAST(report_day AS VARCHAR) AS report_day, holding, CAST(trunc(round(cash, 4)) AS BIGINT) / 1e6 AS cash,
  CAST(trunc(round(available, 4)) AS BIGINT) / 1e6 AS available_overdraft, CAST(trunc(round(cash + available, 4)) AS BIGINT) / 1e6 AS total,
  CAST(isodow(report_day) - 1 AS INTEGER) AS day_of_week, debt_outflow, threshold, early_trigger,
  round(threshold + abs(debt_outflow), 6) AS threshold_debt, round(early_trigger + abs(debt_outflow), 6) AS early_trigger_debt FROM joined""")
def report_liquidity(t):
    where = places(t)
    located = join_keys(t.orders.select(F.to_date("o_orderdate").alias("report_day"), "o_custkey", "o_orderstatus", "o_totalprice"),
                        where, {"o_custkey": "c_custkey"}, "inner", null_safe=False)
    held = located.where((F.col("o_orderstatus") != "P") & (F.col("c_mktsegment") != "FURNITURE")).select(
        "report_day", F.col("r_name").alias("holding"), F.col("o_totalprice").alias("balance"))
    overdrafts = located.where(F.col("o_orderstatus") == "P").select(
        "report_day", F.col("r_name").alias("holding"), F.col("o_totalprice").alias("drawn"))
    limits = companies(t).groupBy("holding").agg((F.sum("credit") * 100).alias("limit"))
    debt = lines_with_customer(t).select(
        F.col("order_day").alias("report_day"), supplier_name().alias("company_name"), customer_name("o_custkey").alias("party_name"),
        F.when(F.col("l_linestatus") == "O", "other").otherwise("group").alias("partner_kind"), currency().alias("currency"),
        F.when(F.col("l_returnflag") == "N", F.col("l_extendedprice")).otherwise(-F.col("l_extendedprice")).alias("amount"),
        F.to_date("l_shipdate").alias("term_end"))
    params = t.spark.createDataFrame(
        LIQUIDITY_PARAMS, "holding string, valid_from string, valid_to string, threshold double, early_trigger double",
    ).withColumns({c: F.col(c).cast("date") for c in ("valid_from", "valid_to")})
    out = positions.liquidity(held, overdrafts, limits, debt, quotes(t), params, entities(t))
    return out.withColumns({"report_day": text("report_day"), "threshold_debt": num("threshold_debt", 6),
                            "early_trigger_debt": num("early_trigger_debt", 6)})


@query("report_liquidity_qc", ctes(BALANCES, DAYS, CHANGES, """
seen_before AS (SELECT account, status, max(report_day) AS day FROM balances
  WHERE report_day < (SELECT last_day FROM d) AND report_day >= (SELECT last_day FROM d) - INTERVAL 3 MONTH GROUP BY ALL)""", """
sums AS (SELECT status_change, sum(amount) AS s FROM changes GROUP BY 1)""") + """
SELECT c.status_change AS status, c.account, c.status AS account_status, rows, round(amount, 2) AS amount,
  CASE WHEN c.status_change = 'new' THEN coalesce(CAST(day AS VARCHAR), 'never') END AS last_seen,
  CASE WHEN s >= CASE c.status_change WHEN 'missing' THEN 3000 ELSE 2000000 END THEN 'CRITICAL' ELSE 'ALERT' END AS level
FROM changes c JOIN sums USING (status_change) LEFT JOIN seen_before b ON b.account = c.account AND b.status = c.status""")
def report_liquidity_qc(t):
    out = positions.liquidity_qc(balances(t).withColumnRenamed("status", "account_status"), "ts", ["account", "account_status"],
                                 "balance", {"missing": 3000.0, "new": 2000000.0})
    return out.select("status", "account", "account_status", "rows", num("amount").alias("amount"), "last_seen", "level")


# --- bank limits -----------------------------------------------------------------------------

BANK_LIMITS = ctes(BALANCES, COMPANIES, MULTIKEY, """
today AS (SELECT account AS bank_id, status AS holding, balance, CASE WHEN balance > 20 THEN 'active' WHEN balance > 10 THEN 'mmarket' ELSE 'blocked' END AS kind,
  account_no AS unit_code FROM balances WHERE report_day = (SELECT max(report_day) FROM balances))""", """
banks AS (SELECT c_custkey AS bank_id, c_name AS name FROM customer WHERE c_acctbal > 0)""", """
terms AS (SELECT o_custkey AS bank_id, CASE o_orderstatus WHEN 'F' THEN 'view' WHEN 'O' THEN 'click' ELSE 'purchase' END AS holding,
  o_orderpriority AS limit_type, o_totalprice * 100 AS "limit", CAST(o_orderdate AS DATE) AS active_from FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
  QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus, o_orderpriority ORDER BY active_from DESC, "limit" DESC) = 1)""", """
agreed AS (SELECT bank_id, holding, sum("limit") / 1e6 AS "limit" FROM terms GROUP BY ALL)""", """
rows AS (SELECT t.holding, coalesce(b.name, 'Bank ' || t.bank_id) AS bank, n_name AS country, coalesce(segment, 'External') AS segment,
  round_even(coalesce(CASE WHEN kind <> 'blocked' THEN balance ELSE 0 END * 1e6 / 1e6 / nullif(a."limit", 0) * 100, 0), 1) AS pct_active,
  round_even(coalesce(balance / nullif(a."limit", 0) * 100, 0), 1) AS pct_total,
  round_even(CASE WHEN kind <> 'blocked' THEN balance ELSE 0 END, 2) AS active, round_even(balance, 2) AS total, round_even(a."limit", 2) AS "limit"
  FROM today t LEFT JOIN agreed a USING (bank_id, holding) LEFT JOIN best ON unit_code = k LEFT JOIN banks b USING (bank_id)
  LEFT JOIN customer ON c_custkey = t.bank_id LEFT JOIN nation ON n_nationkey = c_nationkey)""", """
kept AS (SELECT * FROM rows WHERE active <> 0 AND ("limit" IS NULL OR "limit" <> 0))""")


# Groups of segments with a table of their own.
LIMIT_PARTS = {"south": ["NATION_1", "NATION_2", "NATION_3", "NATION_5"], "rest": ["NATION_8", "NATION_13", "NATION_21", "External"]}


def bank_limit_table(t, name):
    b = balances(t)
    home = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("country"))
    held = join_keys(b, home, {"account": "c_custkey"}, "left", null_safe=False).select(
        "ts", F.col("status").alias("holding"), F.col("account").alias("bank_id"),
        F.concat(F.lit("Bank "), F.col("account")).alias("bank_name"), "country", F.col("account_no").alias("unit_code"),
        F.when(F.col("balance") > 20, "active").when(F.col("balance") > 10, "mmarket").otherwise("blocked").alias("status"),
        (F.col("balance") * 1e6).alias("balance"))
    holding = F.when(F.col("o_orderstatus") == "F", "view").when(F.col("o_orderstatus") == "O", "click").otherwise("purchase")
    limits = t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        F.col("o_custkey").alias("bank_id"), holding.alias("holding"), F.col("o_orderpriority").alias("limit_type"),
        (F.col("o_totalprice") * 100).alias("limit"), F.to_date("o_orderdate").alias("active_from"))
    banks = t.customer.where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("bank_id"), F.col("c_name").alias("name"))
    return positions.bank_limits(held, limits, banks, entities(t), day="ts", parts=LIMIT_PARTS, wanted=(name,))[name]


@query("report_bank_limits", BANK_LIMITS + """, g AS (SELECT holding, bank, coalesce(avg("limit"), 0) AS "limit", sum(active) AS active,
  sum(pct_active) AS pct_active, sum(total) AS total, sum(pct_total) AS pct_total FROM kept GROUP BY ALL)
SELECT holding, bank, round("limit", 2) AS "limit", round(active, 2) AS active, round(pct_active, 1) AS pct_active, round(total, 2) AS total, round(pct_total, 1) AS pct_total,
  CASE WHEN active <= "limit" THEN 'ok' WHEN active - "limit" > "limit" * 0.1 OR active - "limit" > 10 THEN 'significant' ELSE 'insignificant' END AS breach FROM g""")
def report_bank_limits(t):
    return bank_limit_table(t, "by_bank").withColumns(
        {"limit": num("limit"), "active": num("active"), "total": num("total"), "pct_active": num("pct_active", 1), "pct_total": num("pct_total", 1)})


@query("report_bank_limits_by_segment", BANK_LIMITS + """
SELECT holding, segment, round(sum(active), 2) AS active, round(sum(total), 2) AS total FROM kept GROUP BY ALL""")
def report_bank_limits_by_segment(t):
    return bank_limit_table(t, "by_segment").withColumns({"active": num("active"), "total": num("total")})


@query("report_bank_limits_by_country", BANK_LIMITS + """
SELECT holding, country, round(sum(active), 2) AS active, round(sum(total), 2) AS total FROM kept GROUP BY ALL""")
def report_bank_limits_by_country(t):
    return bank_limit_table(t, "by_country").withColumns({"active": num("active"), "total": num("total")})


@query("report_bank_limits_frame", BANK_LIMITS + """
SELECT CASE WHEN grouping(holding) = 1 THEN 'Total' ELSE holding END AS holding, CASE WHEN grouping(country) = 1 THEN 'Total' ELSE country END AS country,
  CASE WHEN grouping(bank) = 1 THEN 'Total' ELSE bank END AS bank, CASE WHEN grouping(segment) = 1 THEN 'Total' ELSE segment END AS segment,
  round(sum(active), 2) AS active, round(sum(total), 2) AS total,
  CAST(grouping(holding) + grouping(country) + grouping(bank) + grouping(segment) AS INTEGER) AS level
FROM kept GROUP BY ROLLUP (holding, country, bank, segment)""")
def report_bank_limits_frame(t):
    return bank_limit_table(t, "frame").withColumns({"active": num("active"), "total": num("total")})


@query("report_bank_limits_matrix", BANK_LIMITS + """, c AS (SELECT * FROM kept WHERE country IS NOT NULL),
seg AS (SELECT holding, segment, row_number() OVER (PARTITION BY holding ORDER BY sum(active) DESC, sum(total) DESC, segment) AS segment_no FROM c GROUP BY holding, segment),
ctry AS (SELECT holding, country, sum(active) AS active, sum(total) AS total,
  row_number() OVER (PARTITION BY holding ORDER BY sum(active) DESC, sum(total) DESC, country) AS country_no FROM c GROUP BY holding, country),
bank AS (SELECT holding, country, bank, sum(active) AS active, sum(total) AS total,
  row_number() OVER (PARTITION BY holding, country ORDER BY sum(active) DESC, sum(total) DESC, bank) AS bank_no FROM c GROUP BY holding, country, bank),
lines AS (SELECT b.holding, b.country, country_no, bank, bank_no, b.active, b.total FROM bank b JOIN ctry t ON b.holding = t.holding AND b.country = t.country
  UNION ALL SELECT t.holding, t.country, country_no, NULL, (SELECT count(*) + 1 FROM bank b WHERE b.holding = t.holding AND b.country = t.country), active, total FROM ctry t),
held AS (SELECT holding, country, bank, segment, sum(total) AS v FROM c GROUP BY GROUPING SETS ((holding, country, bank, segment), (holding, country, segment)))
SELECT l.holding, l.country, CAST(country_no AS INTEGER) AS country_no, l.bank, CAST(bank_no AS INTEGER) AS bank_no, round(active, 2) AS active, round(total, 2) AS total,
  s.segment, CAST(segment_no AS INTEGER) AS segment_no, round(coalesce(v, 0), 2) AS segment_total
FROM lines l JOIN seg s ON s.holding = l.holding LEFT JOIN held h ON h.holding = l.holding AND h.country = l.country AND h.bank IS NOT DISTINCT FROM l.bank AND h.segment = s.segment""")
def report_bank_limits_matrix(t):
    return bank_limit_table(t, "matrix").withColumns({c: num(c) for c in ("active", "total", "segment_total")})


@query("report_bank_limits_by_part", BANK_LIMITS + """, parts(part, segment) AS (VALUES ('south', 'NATION_1'), ('south', 'NATION_2'), ('south', 'NATION_3'), ('south', 'NATION_5'),
  ('rest', 'NATION_8'), ('rest', 'NATION_13'), ('rest', 'NATION_21'), ('rest', 'External')),
w AS (SELECT holding, bank, sum(total) AS total FROM kept GROUP BY ALL),
g AS (SELECT holding, part, bank, coalesce(avg("limit"), 0) AS "limit", sum(active) AS active FROM kept JOIN parts USING (segment) GROUP BY ALL)
SELECT holding, part, bank, round("limit", 2) AS "limit", round(active, 2) AS active, round(total, 2) AS total,
  round(coalesce(active / nullif("limit", 0) * 100, 0), 1) AS pct_active, round(coalesce(total / nullif("limit", 0) * 100, 0), 1) AS pct_total FROM g JOIN w USING (holding, bank)""")
def report_bank_limits_by_part(t):
    return bank_limit_table(t, "by_part").withColumns({
        "limit": num("limit"), "active": num("active"), "total": num("total"), "pct_active": num("pct_active", 1), "pct_total": num("pct_total", 1)})


# --- receivables and payables ----------------------------------------------------------------

ARAP = ctes(*ENTITY, f"""
lines AS (SELECT CASE WHEN l_linestatus = 'F' THEN 'ERP' ELSE 'ECP' END AS source, CASE WHEN l_returnflag = 'R' THEN 'AR' ELSE 'AP' END AS report_type,
  p_brand AS account, c.holding, 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS customer_name,
  CASE WHEN l_quantity > 2 THEN {SUPPLIER_NAME} END AS org_name, CASE WHEN l_quantity > 10 THEN CAST(l_suppkey AS VARCHAR) END AS company_code,
  CASE WHEN l_quantity > 5 THEN 'Z' || l_linenumber END AS second_code, {CURRENCY_SQL} AS currency,
  CASE WHEN l_tax > 0.04 THEN 'Internal' ELSE 'External' END AS internal_flag, CAST(l_shipdate AS DATE) AS due,
  CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE -l_extendedprice END AS amount_usd
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN companies c ON c.unit_key = l_suppkey)""", f"""
coded AS (SELECT *, {RULES_SQL} AS purpose FROM lines WHERE org_name IS NOT NULL OR company_code IS NOT NULL)""", """
resolved AS (SELECT x.*, coalesce(company_code, second_code, o.code, 'External') AS company, coalesce(cn.code, 'External') AS cty_code
  FROM coded x LEFT JOIN names o ON o.name = org_name LEFT JOIN names cn ON cn.name = customer_name WHERE purpose IS NOT NULL)""", """
mapped AS (SELECT r.*, coalesce(b.segment, 'External') AS comp_map, coalesce(q.segment, 'External') AS cty_map, coalesce(h.holding, 'External') AS cty_holding
  FROM resolved r LEFT JOIN best b ON b.k = company LEFT JOIN best q ON q.k = cty_code LEFT JOIN best_hold h ON h.k = cty_code)""", """
position AS (SELECT holding, customer_name, cty_holding, org_name, company, currency, source, purpose, comp_map, cty_code, cty_map, internal_flag, due,
  sum(amount_usd) AS amount_usd, count(*) AS lines, CAST(purpose IN ('Trade receivables', 'Other receivables', 'Provisions') AS INTEGER) AS ar_flag,
  CAST(purpose IN ('Trade payables', 'Other payables') AS INTEGER) AS ap_flag, date_diff('day', DATE '1998-06-30', due) AS days FROM mapped GROUP BY ALL)""")


def arap_position(t):
    lines = lines_with_customer(t)
    lines = join_keys(lines, t.part.select("p_partkey", "p_brand", "p_type"), {"l_partkey": "p_partkey"}, "inner", null_safe=False)
    lines = join_keys(lines, companies(t).select("unit_key", "holding"), {"l_suppkey": "unit_key"}, "inner", null_safe=False)
    ledger = lines.select(
        F.when(F.col("l_linestatus") == "F", "ERP").otherwise("ECP").alias("source"),
        F.when(F.col("l_returnflag") == "R", "AR").otherwise("AP").alias("report_type"), F.col("p_brand").alias("account"),
        F.col("p_type").alias("code"), "holding", customer_name("o_custkey").alias("customer_name"),
        F.when(F.col("l_quantity") > 2, supplier_name()).alias("org_name"), F.when(F.col("l_quantity") > 10, text("l_suppkey")).alias("company_code"),
        F.when(F.col("l_quantity") > 5, F.concat(F.lit("Z"), F.col("l_linenumber"))).alias("second_code"), currency().alias("currency"),
        F.when(F.col("l_tax") > 0.04, "Internal").otherwise("External").alias("internal_flag"), F.to_date("l_shipdate").alias("due"),
        F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice")).otherwise(-F.col("l_extendedprice")).alias("amount_usd"))
    return positions.arap_position(ledger, classify(RULES, "source", "report_type", "code", "account"), entities(t), day("1998-06-30"))


@query("report_arap", ARAP + f"""
SELECT holding, customer_name, cty_holding, org_name, company, currency, source, purpose, comp_map, cty_code, cty_map, internal_flag, CAST(due AS VARCHAR) AS due,
  round(amount_usd, 2) AS amount_usd, lines, ar_flag, ap_flag, round(amount_usd * ar_flag, 2) + 0 AS amount_ar_usd, round(amount_usd * ap_flag, 2) + 0 AS amount_ap_usd,
  CAST(days AS INTEGER) AS days, {BUCKET} AS period FROM position""")
def report_arap(t):
    return arap_position(t).withColumns({c: num(c) for c in ("amount_usd", "amount_ar_usd", "amount_ap_usd")}).withColumn("due", text("due"))


@query("report_arap_provisions", ARAP + """
SELECT holding, comp_map, customer_name, round(coalesce(sum(amount_usd) FILTER (purpose = 'Provisions'), 0), 2) AS provisions,
  round(coalesce(sum(amount_usd) FILTER (purpose <> 'Provisions'), 0), 2) AS ar FROM position WHERE ar_flag = 1 AND comp_map <> 'External' GROUP BY ALL""")
def report_arap_provisions(t):
    return positions.arap_provisions(arap_position(t)).withColumns({"provisions": num("provisions"), "ar": num("ar")})


@query("report_arap_summary", ARAP + """
SELECT p.holding, comp_map, currency, round(sum(amount_usd), 2) AS amount_usd, round(sum(amount_usd * ar_flag), 2) + 0 AS amount_ar_usd,
  round(sum(amount_usd * ap_flag), 2) + 0 AS amount_ap_usd, sum(ap_flag)::BIGINT AS ap_lines, sum(ar_flag)::BIGINT AS ar_lines, any_value(n) AS count_lines,
  '1998-06-30' AS run_date FROM position p JOIN (SELECT holding, count(*) AS n FROM position GROUP BY 1) c ON c.holding = p.holding GROUP BY ALL""")
def report_arap_summary(t):
    return positions.arap_summary(arap_position(t), F.lit("1998-06-30")).withColumns(
        {c: num(c) for c in ("amount_usd", "amount_ar_usd", "amount_ap_usd")})


@query("report_counterclaims", ARAP + ", " + GRID + """
, c AS (SELECT holding, comp_map AS row_label, cty_map AS col_label, currency, sum(amount_usd * ar_flag) AS ar, sum(amount_usd * ap_flag) AS ap FROM position
  WHERE purpose <> 'Provisions' AND comp_map <> 'External' AND cty_map <> 'External' GROUP BY ALL),
j AS (SELECT g.*, currency, round_even(coalesce(ar / 1e6, 0), 3) AS ar, round_even(coalesce(ap / 1e6, 0), 3) AS ap FROM grid g LEFT JOIN c USING (holding, row_label, col_label))
SELECT holding, row_label, col_label, currency, ar + 0 AS ar, ap + 0 AS ap, round(ar + ap, 3) + 0 AS diff,
  coalesce(abs(abs(ap) - abs(ar)) / nullif(greatest(abs(ap), abs(ar)), 0) >= 0.4, false) AS differs FROM j""")
def report_counterclaims(t):
    out = positions.counterclaims(arap_position(t), companies(t), REGIONS)
    return out.withColumns({"ar": F.col("ar") + 0.0, "ap": F.col("ap") + 0.0, "diff": num("diff", 3)})


@query("report_external_debt", ctes(QUOTES, *ENTITY, f"""
x AS (SELECT CAST(l_suppkey AS VARCHAR) AS company_code, CASE WHEN l_tax > 0.04 THEN 'Internal' ELSE 'External' END AS out_group,
  l_extendedprice * CASE WHEN {CURRENCY_SQL} = 'USD' THEN 1 ELSE coef END AS amount
  FROM lineitem LEFT JOIN usd_rates ON rate_ccy = {CURRENCY_SQL} AND rate_day = DATE '1998-06-30')""") + """
SELECT coalesce(holding, 'External') AS company_holding, company_code, coalesce(segment, 'External') AS company_segment, out_group,
  round(coalesce(sum(amount), 0), 2) AS amount_usd, count(amount) AS lines FROM x LEFT JOIN best b ON b.k = company_code LEFT JOIN best_hold h ON h.k = company_code GROUP BY ALL""")
def report_external_debt(t):
    return external_debt(t)["summary"].withColumn("amount_usd", usd("amount_usd"))


def external_debt(t):
    debt = lines_with_customer(t).select(
        text("l_suppkey").alias("company_code"), customer_name("o_custkey").alias("party_name"), currency().alias("currency"),
        F.col("l_extendedprice").alias("amount"), F.to_date("l_shipdate").alias("term"),
        F.when(F.col("l_tax") > 0.04, "Internal").otherwise("External").alias("out_group"))
    return positions.external_debt(debt, quotes(t), entities(t), day("1998-06-30"), "out_group")


@query("report_external_debt_gaps", ctes(*ENTITY) + """
SELECT DISTINCT c_name AS party_name, coalesce(code, 'External') AS party_code, coalesce(segment, 'External') AS party_segment
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey LEFT JOIN names ON name = c_name LEFT JOIN best ON k = code
WHERE l_tax > 0.04 AND segment IS NULL""")
def report_external_debt_gaps(t):
    return external_debt(t)["gaps"]


# --- debt ------------------------------------------------------------------------------------

DEBT = ctes(QUOTES, *ENTITY, f"""
g AS (SELECT {SUPPLIER_NAME} AS entity, l_linestatus AS relation, 'Customer#' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS party, l_returnflag AS account,
  {CURRENCY_SQL} AS currency, CAST(date_trunc('month', l_shipdate) AS DATE) AS term_end, sum(l_extendedprice) AS outstanding,
  sum(CASE WHEN l_tax > 0.04 THEN -l_extendedprice ELSE l_extendedprice END) AS display_amount, count(*) AS lines FROM lineitem GROUP BY ALL)""", """
debt AS (SELECT g.*, outstanding * CASE WHEN currency = 'USD' THEN 1 ELSE coef END * sign(display_amount) AS outstanding_usd,
  coalesce(eh.holding, 'External') AS holding, coalesce(es.segment, 'External') AS entity_group, coalesce(ps.segment, 'External') AS party_group,
  date_diff('day', DATE '1998-06-30', term_end) AS days
  FROM g LEFT JOIN usd_rates ON rate_ccy = currency AND rate_day = DATE '1998-06-30'
  LEFT JOIN names en ON en.name = entity LEFT JOIN best es ON es.k = en.code LEFT JOIN best_hold eh ON eh.k = en.code
  LEFT JOIN names pn ON pn.name = party LEFT JOIN best ps ON ps.k = pn.code)""")


def debt_position(t):
    loans = t.lineitem.select(
        supplier_name().alias("entity"), F.col("l_linestatus").alias("relation"), customer_name("l_partkey").alias("party"),
        F.col("l_returnflag").alias("account"), currency().alias("currency"), F.trunc(F.to_date("l_shipdate"), "month").alias("term_end"),
        F.col("l_extendedprice").alias("outstanding"),
        F.when(F.col("l_tax") > 0.04, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).alias("display_amount"))
    # technical codes become ISO codes before grouping, so equal currencies meet in one group
    return positions.debt_position(loans.withColumn("currency", iso_code("currency")), quotes(t), entities(t), day("1998-06-30"))


@query("report_debt", DEBT + f"""
SELECT entity, entity_group, party, party_group, relation, currency, round(outstanding, 2) AS outstanding, round(outstanding_usd, 2) + 0 AS outstanding_usd,
  CAST(term_end AS VARCHAR) AS term_end, CAST(days AS INTEGER) AS days, {BUCKET} AS period, holding, lines, 'SAP' AS source FROM debt""")
def report_debt(t):
    return debt_position(t).select(
        "entity", "entity_group", "party", "party_group", "relation", "currency", num("outstanding").alias("outstanding"),
        usd("outstanding_in_USD").alias("outstanding_usd"), text("term_end").alias("term_end"), "days", "period", "holding", "lines", "source")


@query("report_debt_matrix", DEBT + "SELECT holding, currency, entity_group, " + ", ".join(
    f"round(coalesce(sum(outstanding_usd) FILTER (party_group = '{n}'), 0), 2) + 0 AS \"{n}\"" for n in NATIONS) + """
FROM debt WHERE party_group <> 'External' GROUP BY ALL""")
def report_debt_matrix(t):
    return positions.debt_matrix(debt_position(t), NATIONS).withColumns({n: usd(n) for n in NATIONS})


@query("report_treasury_debt", ctes(*ENTITY, f"""
d AS (SELECT CAST(date_trunc('year', l_shipdate) AS DATE) AS report_day, CAST(date_trunc('month', l_shipdate) AS DATE) AS effective_from, {SUPPLIER_NAME} AS entity,
  'Customer#' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') || CASE WHEN l_linestatus = 'F' THEN ' (EC)' ELSE '' END AS party,
  CASE WHEN l_returnflag = 'R' THEN 'Bond ' ELSE 'Loan ' END || l_suppkey AS deal_set, CASE WHEN l_linenumber = 1 THEN 'ISSUED' ELSE 'TRADED' END AS owner,
  {CURRENCY_SQL} AS currency, CAST(l_shipdate AS DATE) AS action_day, l_extendedprice AS amount, l_quantity AS amount_usd FROM lineitem)""", """
v AS (SELECT d.*, coalesce(n.code, entity) AS entity_code FROM d LEFT JOIN names n ON n.name = entity QUALIFY effective_from = max(effective_from) OVER (PARTITION BY report_day))""", """
w AS (SELECT v.*, coalesce(segment, 'External') AS entity_group FROM v LEFT JOIN best ON k = entity_code)""", """
iss AS (SELECT report_day, deal_set, entity_code, entity_group, party, min((currency, action_day)) AS carry FROM w WHERE deal_set LIKE '%Bond%' AND owner = 'ISSUED' GROUP BY ALL)""", """
ok AS (SELECT report_day, deal_set, any_value(entity_code) AS issuer, any_value(entity_group) AS grp, any_value(party) AS pty, any_value(carry) AS carry
  FROM iss GROUP BY 1, 2 HAVING count(*) = 1)""", """
n AS (SELECT ok.report_day, ok.deal_set, 'ISSUED' AS owner, issuer AS entity_code, grp AS entity_group, pty AS party, carry[1] AS currency, carry[2] AS action_day,
  sum(amount) AS amount, sum(amount_usd) AS amount_usd FROM ok JOIN w USING (report_day, deal_set) GROUP BY ALL
UNION ALL SELECT report_day, deal_set, owner, entity_code, entity_group, issuer, currency, action_day, amount, amount_usd FROM w JOIN ok USING (report_day, deal_set) WHERE owner = 'TRADED'
UNION ALL SELECT report_day, deal_set, owner, entity_code, entity_group, party, currency, action_day, amount, amount_usd FROM w WHERE deal_set NOT LIKE '%Bond%')""", """
r AS (SELECT n.*, date_diff('day', report_day, action_day) AS days, coalesce(pn.code, 'External') AS party_code FROM n LEFT JOIN names pn ON pn.name = regexp_replace(party, ' \\(EC\\)$', ''))""") + f"""
SELECT CAST(report_day AS VARCHAR) AS report_day, deal_set, owner, entity_code, entity_group, party, coalesce(segment, 'External') AS party_group, currency,
  CAST(action_day AS VARCHAR) AS action_day, round(amount, 2) AS amount, amount_usd, CAST(days AS INTEGER) AS days, {BUCKET} AS period FROM r LEFT JOIN best ON k = party_code""")
def report_treasury_debt(t):
    ship = F.to_date("l_shipdate")
    deals = t.lineitem.select(
        F.trunc(ship, "year").alias("report_day"), F.trunc(ship, "month").alias("effective_from"), supplier_name().alias("entity"),
        F.concat(customer_name("l_partkey"), F.when(F.col("l_linestatus") == "F", " (EC)").otherwise("")).alias("party"),
        F.concat(F.when(F.col("l_returnflag") == "R", "Bond ").otherwise("Loan "), F.col("l_suppkey")).alias("deal_set"),
        F.when(F.col("l_linenumber") == 1, "ISSUED").otherwise("TRADED").alias("owner"),
        F.when(F.col("l_returnflag") == "R", "EUR").when(F.col("l_returnflag") == "A", "CHF").otherwise("USD").alias("currency"),
        ship.alias("action_day"), F.col("l_extendedprice").alias("amount"), F.col("l_quantity").alias("amount_usd"))
    return positions.treasury_debt(deals, entities(t)).select(
        text("report_day").alias("report_day"), "deal_set", "owner", "entity_code", "entity_group", "party", "party_group", "currency",
        text("action_day").alias("action_day"), num("amount").alias("amount"), "amount_usd", "days", "period")


DERIV = f"""
deals AS (SELECT l_orderkey AS deal_no, CAST(l_suppkey AS VARCHAR) AS entity, CAST(l_shipdate AS DATE) AS maturity, 'USD' AS pay_ccy, l_extendedprice AS pay,
  CASE WHEN l_linestatus = 'F' THEN 'CHF' ELSE 'EUR' END AS rec_ccy, l_quantity * 1000 AS rec FROM lineitem
  WHERE (l_returnflag <> 'R' OR l_returnflag = 'R' AND coalesce(l_quantity, 0) <= 45)
  AND l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45))"""


def deriv_inputs(t):
    """Forwards, swaps and debt deals: every line is one of them, R lines above 45 are debt and the others swaps."""
    deals = t.lineitem.select(
        F.col("l_orderkey").alias("deal_no"), F.to_date("l_shipdate").alias("position_day"), text("l_suppkey").alias("entity"),
        text("l_partkey").alias("party"), F.lit("USD").alias("pay_ccy"), F.col("l_extendedprice").alias("pay"),
        F.when(F.col("l_linestatus") == "F", "RUC").otherwise("EUR").alias("rec_ccy"), (F.col("l_quantity") * 1000).alias("rec"),
        F.to_date("l_shipdate").alias("maturity"), "l_returnflag", "l_quantity")
    flag = F.col("l_returnflag")
    owed = F.coalesce(F.col("l_quantity"), F.lit(0.0)) > 45
    own = deals.drop("l_returnflag", "l_quantity")
    return (deals.where(flag == "A").select(*own.columns), deals.where((flag == "N") | (flag == "R") & ~owed).select(*own.columns),
            deals.where((flag == "R") & owed).select("deal_no"))


@query("report_derivatives", ctes(QUOTES, COMPANIES, MULTIKEY, DERIV, """
legs AS (SELECT entity, maturity, 'pay' AS leg, pay_ccy AS currency, -pay AS amount FROM deals UNION ALL SELECT entity, maturity, 'receive', rec_ccy, rec FROM deals)""", """
x AS (SELECT *, date_diff('day', DATE '1998-06-30', maturity) AS days, amount * CASE WHEN currency = 'USD' THEN 1 ELSE coef END AS usd
  FROM legs LEFT JOIN usd_rates ON rate_ccy = currency AND rate_day = DATE '1998-06-30' LEFT JOIN best ON k = entity)""") + f"""
SELECT coalesce(segment, 'External') AS entity_group, leg, currency, {BUCKET} AS period, count(*) AS lines, round(sum(amount), 2) AS amount, {settled_sql("sum(usd)")} AS amount_usd
FROM x GROUP BY ALL""")
def report_derivatives(t):
    forwards, swaps, debt = deriv_inputs(t)
    rows = positions.derivatives(forwards, swaps, debt, quotes(t), entities(t), day("1998-06-30"))
    return rows.groupBy("entity_group", "leg", "currency", "period").agg(
        F.count(F.lit(1)).alias("lines"), num(F.sum("amount")).alias("amount"), settled(F.sum("amount_in_USD")).alias("amount_usd"))


@query("report_derivative_totals", """
SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS position_day, 'USD' AS pay_ccy, CASE WHEN l_linestatus = 'F' THEN 'RUC' ELSE 'EUR' END AS rec_ccy,
  round(sum(l_extendedprice), 2) AS pay, sum(l_quantity * 1000) AS rec FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL""")
def report_derivative_totals(t):
    return positions.derivative_totals(deriv_inputs(t)[0]).withColumns({"position_day": text("position_day"), "pay": num("pay")})


# --- deals, cash, investments ----------------------------------------------------------------

@query("report_deals", ctes(*ENTITY, f"""
x AS (SELECT CASE WHEN l_linestatus = 'F' THEN 'external' ELSE 'internal' END AS kind, CAST(l_linenumber AS VARCHAR) AS product, {SUPPLIER_NAME} AS company_name,
  'Customer#' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS party, {CURRENCY_SQL} AS currency, l_returnflag AS flag,
  CASE WHEN l_quantity > 5 THEN l_quantity ELSE l_linenumber END AS q, l_extendedprice AS price, CAST(l_shipdate AS DATE) AS delivery_to,
  CAST(date_trunc('month', l_shipdate) AS DATE) AS report_day FROM lineitem WHERE l_returnflag <> 'N' AND l_tax > 0.01)""", """
y AS (SELECT *, date_diff('day', report_day, delivery_to) AS days FROM x WHERE report_day = DATE '1998-06-01' AND delivery_to > report_day)""") + f"""
SELECT kind, product, company_name, party, currency, CASE WHEN flag = 'A' THEN q ELSE -q END AS quantity, round(CASE WHEN flag = 'A' THEN -q * price ELSE q * price END, 2) AS money,
  CAST(delivery_to AS VARCHAR) AS delivery_to, CAST(days AS INTEGER) AS days, {BUCKET} AS period, coalesce(s.segment, 'External') AS segment,
  coalesce(h.holding, 'External') AS holding, coalesce(p.segment, 'External') AS party_segment
FROM y LEFT JOIN names cn ON cn.name = company_name LEFT JOIN best s ON s.k = cn.code LEFT JOIN best_hold h ON h.k = cn.code
LEFT JOIN names pn ON pn.name = party LEFT JOIN best p ON p.k = pn.code""")
def report_deals(t):
    flag, party = F.col("l_returnflag"), customer_name("l_partkey")
    rows = t.lineitem.select(
        F.trunc(F.to_date("l_shipdate"), "month").alias("report_day"), F.when(flag == "N", "Cancelled").otherwise("Confirmed").alias("status"),
        F.when(F.col("l_tax") > 0.01, "Y").otherwise("N").alias("invoiced"), F.to_date("l_shipdate").alias("delivery_to"),
        F.when(flag == "A", "Purchasing Deal").otherwise("Sales Deal").alias("deal_type"), supplier_name().alias("company_name"),
        F.when(flag == "A", party).alias("seller"), F.when(flag != "A", party).alias("buyer"), text("l_linenumber").alias("product"),
        F.when(flag == "R", "EUR").when(flag == "A", "CHF").otherwise("USD").alias("currency"),
        F.when(F.col("l_quantity") > 5, F.col("l_quantity")).alias("quantity"), F.col("l_linenumber").cast("double").alias("fallback_quantity"),
        F.col("l_extendedprice").alias("price"), "l_linestatus")
    tables = {"external": rows.where(F.col("l_linestatus") == "F"), "internal": rows.where(F.col("l_linestatus") == "O")}
    out = positions.deals_position(tables, entities(t), "1998-06-30", "Purchasing Deal", "Sales Deal")
    return out.withColumns({"money": num("money"), "delivery_to": text("delivery_to")})


@query("report_cash", ctes(BALANCES, COMPANIES, MULTIKEY, """
ecl AS (SELECT CAST(l_suppkey AS VARCHAR) AS unit_code, CASE l_returnflag WHEN 'R' THEN 'view' WHEN 'A' THEN 'click' ELSE 'purchase' END AS bank_name,
  round_even(abs(sum(l_tax * l_extendedprice) / sum(l_extendedprice)) * 7, 3) AS impairment FROM lineitem GROUP BY ALL)""") + """
SELECT account, status AS bank_name, balance, coalesce(segment, 'External') AS segment, round(coalesce(impairment, 0), 3) AS impairment,
  round(balance * (1 - coalesce(impairment, 0)), 5) AS balance_impaired, '<1M' AS period
FROM balances LEFT JOIN best ON k = account_no LEFT JOIN ecl ON unit_code = account_no AND bank_name = status WHERE report_day = DATE '2024-01-15'""")
def report_cash(t):
    bank = F.when(F.col("l_returnflag") == "R", "view").when(F.col("l_returnflag") == "A", "click").otherwise("purchase")
    weighted = F.sum(F.col("l_tax") * F.col("l_extendedprice")) / F.sum("l_extendedprice")
    ecl = t.lineitem.groupBy(text("l_suppkey").alias("unit_code"), bank.alias("bank_name")).agg(
        F.bround(F.abs(weighted) * 7, 3).alias("impairment"))
    held = balances(t).withColumnsRenamed({"account_no": "unit_code", "status": "bank_name"})
    return positions.cash_position(held, ecl, entities(t), "2024-01-15").select(
        "account", "bank_name", "balance", "segment", num("impairment", 3).alias("impairment"), num("balance_impaired", 5).alias("balance_impaired"), "period")


@query("report_investments", ctes(QUOTES, """
p AS (SELECT l_linestatus AS holding, l_suppkey AS company, l_linenumber > 4 AS party, CASE WHEN l_quantity > 25 THEN 'EUR' ELSE 'USD' END AS currency,
  CAST(date_trunc('year', l_shipdate) AS DATE) AS month, coalesce(sum(l_extendedprice) FILTER (l_returnflag = 'A'), 0) AS a,
  coalesce(sum(l_extendedprice) FILTER (l_returnflag = 'N'), 0) AS n, coalesce(sum(l_extendedprice) FILTER (l_returnflag = 'R'), 0) AS r FROM lineitem GROUP BY ALL)""", """
m AS (SELECT *, CASE holding WHEN 'F' THEN least(a, n) ELSE least(n, r) END AS amount FROM p)""") + """
SELECT holding, company, party, currency, CAST(month AS VARCHAR) AS month, round(amount, 2) AS amount,
  round(amount * CASE WHEN currency = 'USD' THEN 1 ELSE coef END, 2) AS amount_usd
FROM m LEFT JOIN usd_rates ON rate_ccy = currency AND rate_day = DATE '1998-06-30' WHERE amount <> 0""")
def report_investments(t):
    plan = t.lineitem.select(
        F.col("l_linestatus").alias("holding"), F.col("l_suppkey").alias("company"), (F.col("l_linenumber") > 4).alias("party"),
        F.when(F.col("l_quantity") > 25, "EUR").otherwise("USD").alias("currency"), F.concat(F.lit("01."), F.year("l_shipdate")).alias("month_text"),
        F.col("l_returnflag").alias("version"), F.col("l_extendedprice").alias("amount"))
    out = positions.investments(plan, quotes(t), {"F": ("A", "N"), "O": ("N", "R")}, day("1998-06-30"))
    return out.select("holding", "company", "party", "currency", text("month").alias("month"), num("amount").alias("amount"),
                      usd("amount_in_USD").alias("amount_usd"))


@query("report_investments_unified", """
SELECT l_linestatus AS holding, l_suppkey AS company, 'P' || l_linenumber AS project, CAST(date_trunc('month', l_shipdate) AS DATE)::VARCHAR AS month_start,
  round(sum(CASE WHEN l_tax > 0 THEN l_extendedprice ELSE 0 END), 2) AS amount, count(*) AS lines, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month
FROM lineitem WHERE l_tax > 0 GROUP BY ALL""")
def report_investments_unified(t):
    rows = t.lineitem.select(
        F.col("l_linestatus").alias("holding"), F.col("l_suppkey").alias("company"), F.to_date("l_shipdate").alias("maturity"),
        F.concat(F.lit("P"), F.col("l_linenumber"), F.lit("-"), F.col("l_orderkey")).alias("record_id"),
        F.when(F.col("l_tax") > 0, F.col("l_extendedprice")).otherwise(0.0).alias("amount"))
    return positions.investments_from_unified(rows, ["holding", "company"]).withColumns({"amount": num("amount"), "month_start": text("month_start")})


# --- markets ---------------------------------------------------------------------------------

TRIGGERS = ctes("""
f AS (SELECT coalesce(nullif(o_orderpriority, '5-LOW'), 'Empty') AS holding, CAST(o_orderdate AS DATE) AS day, -o_totalprice AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE c_mktsegment NOT IN ('BUILDING', 'FURNITURE') AND o_orderstatus <> 'P' AND o_totalprice > 2000 AND r_name = 'EUROPE')""", """
weekly AS (SELECT holding, CAST(year(day) AS INTEGER) AS year, CAST(weekofyear(day) AS INTEGER) AS week, weekofyear(day) || '.' || year(day) AS week_num,
  abs(sum(amount)) / 1e6 AS outflow FROM f GROUP BY ALL)""")


def triggers(t):
    rows = join_keys(t.orders, t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), {"o_custkey": "c_custkey"}, "inner", null_safe=False)
    flows = rows.select(
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("holding"), F.concat(F.lit("Z"), F.col("c_nationkey")).alias("unit_code"),
        F.to_date("o_orderdate").alias("day"), F.col("o_orderstatus").alias("group"),
        F.when(F.col("c_mktsegment") == "BUILDING", 1).when(F.col("c_mktsegment") != "FURNITURE", 0).alias("internal_flag"),
        F.when(F.col("o_totalprice") > 2000, -F.col("o_totalprice")).otherwise(0.0).alias("amount"), (-F.col("o_totalprice")).alias("amount_usd"))
    units = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("Z"), F.col("n_nationkey")).alias("plant_code"), F.col("r_name").alias("country"), F.col("n_nationkey").alias("unit_key"))
    return markets.outflow_triggers(flows, units, "EUROPE", ["P"])


@query("report_triggers", TRIGGERS + """
SELECT holding, count(*) AS n, round(quantile_cont(outflow, 0.9), 6) AS q90, round(quantile_cont(outflow, 0.5), 6) AS median FROM weekly GROUP BY 1""")
def report_triggers(t):
    return triggers(t)["thresholds"].withColumns({"q90": num("q90", 6), "median": num("median", 6)})


@query("report_triggers_weekly", TRIGGERS + "SELECT holding, year, week, week_num, round(outflow, 6) AS outflow FROM weekly")
def report_triggers_weekly(t):
    return triggers(t)["weekly"].withColumn("outflow", num("outflow", 6))


AGENCIES = {"1-URGENT": "Alpha", "2-HIGH": "Beta", "3-MEDIUM": "Gamma"}
RATINGS = ctes("""
r AS (SELECT n_name AS country, o_orderpriority AS agency, CAST(o_orderdate AS DATE) AS day, 'L' || CAST(floor(o_totalprice / 50000) AS BIGINT) AS letter
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))""", """
newest AS (SELECT country, agency, min(letter) AS letter, max(day) AS day FROM (SELECT * FROM r QUALIFY day = max(day) OVER (PARTITION BY country, agency)) GROUP BY ALL)""", """
codes AS (SELECT n_name AS country, 'N' || n_nationkey AS code FROM nation UNION ALL SELECT r_name, 'R' || r_regionkey FROM region)""", """
w AS (SELECT c.country, c.code, a.letter AS la, a.day AS da, b.letter AS lb, b.day AS db, g.letter AS lg, g.day AS dg FROM codes c
  LEFT JOIN newest a ON a.country = c.country AND a.agency = '1-URGENT' LEFT JOIN newest b ON b.country = c.country AND b.agency = '2-HIGH'
  LEFT JOIN newest g ON g.country = c.country AND g.agency = '3-MEDIUM')""", """
f AS (SELECT r_name AS country, 'L' || r_regionkey AS letter, DATE '2000-01-01' AS day FROM region)""", """
z AS (SELECT w.country, w.code, CASE WHEN la IS NULL AND lb IS NULL AND lg IS NULL THEN f.letter ELSE la END AS la, CASE WHEN la IS NULL AND lb IS NULL AND lg IS NULL THEN f.day ELSE da END AS da,
  CASE WHEN la IS NULL AND lb IS NULL AND lg IS NULL THEN f.letter ELSE lb END AS lb, CASE WHEN la IS NULL AND lb IS NULL AND lg IS NULL THEN f.day ELSE db END AS db,
  CASE WHEN la IS NULL AND lb IS NULL AND lg IS NULL THEN f.letter ELSE lg END AS lg, CASE WHEN la IS NULL AND lb IS NULL AND lg IS NULL THEN f.day ELSE dg END AS dg
  FROM w LEFT JOIN f USING (country))""", """
long AS (SELECT country, code, 'Alpha' AS agency, 1 AS pos, la AS rating, da AS day FROM z UNION ALL SELECT country, code, 'Beta', 2, lb, db FROM z
  UNION ALL SELECT country, code, 'Gamma', 3, lg, dg FROM z)""", """
ranked AS (SELECT *, CAST(substr(rating, 2) AS DOUBLE) AS v, row_number() OVER (PARTITION BY country ORDER BY CAST(substr(rating, 2) AS DOUBLE) DESC, pos) AS rank,
  count(*) OVER (PARTITION BY country) AS n FROM long WHERE rating IS NOT NULL AND rating <> 'L0')""")


def country_ratings(t):
    homes = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("country"))
    letter = F.concat(F.lit("L"), F.floor(F.col("o_totalprice") / 50000))
    ratings = join_keys(t.orders, homes, {"o_custkey": "c_custkey"}, "inner", null_safe=False).select(
        "country", F.col("o_orderpriority").alias("agency"), F.to_date("o_orderdate").alias("day"), letter.alias("letter"))
    points = ratings.select("letter").distinct().unionByName(
        t.region.select(F.concat(F.lit("L"), F.col("r_regionkey")).alias("letter"))).distinct().withColumn(
        "value", F.substr("letter", F.lit(2)).cast("double"))
    fallback = t.region.select(F.col("r_name").alias("country"), F.concat(F.lit("L"), F.col("r_regionkey")).alias("letter"),
                               day("2000-01-01").alias("day"))
    codes = t.nation.select(F.col("n_name").alias("country"), F.concat(F.lit("N"), F.col("n_nationkey")).alias("code")).unionByName(
        t.region.select(F.col("r_name").alias("country"), F.concat(F.lit("R"), F.col("r_regionkey")).alias("code")))
    return markets.country_ratings(ratings, points, fallback, codes, AGENCIES)


@query("report_ratings", RATINGS + """
SELECT country, code, agency, rating, CAST(day AS VARCHAR) AS day, v AS second_best FROM ranked WHERE rank = least(n, 2)""")
def report_ratings(t):
    return country_ratings(t)["one_rating"].withColumn("day", text("day"))


@query("report_ratings_full", RATINGS + """
SELECT z.country, z.code, la AS "Alpha_letter", lb AS "Beta_letter", lg AS "Gamma_letter", CAST(da AS VARCHAR) AS "Alpha_day", v AS second_best, agency AS chosen
FROM z LEFT JOIN ranked k ON k.country = z.country AND rank = least(n, 2)""")
def report_ratings_full(t):
    return country_ratings(t)["full"].select("country", "code", "Alpha_letter", "Beta_letter", "Gamma_letter", text("Alpha_day").alias("Alpha_day"),
                                             "second_best", "chosen")


@query("report_invoice_pd", ctes("""
i AS (SELECT o_orderkey AS invoice, o_custkey AS party, c_nationkey AS country, CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(floor(o_totalprice / 20000) AS BIGINT) AS VARCHAR) ELSE o_orderpriority END AS rating,
  CASE WHEN o_totalprice > 200000 THEN o_totalprice / 1e7 END AS pd FROM orders JOIN customer ON o_custkey = c_custkey)""", """
scale AS (SELECT p_size AS points, min(p_type) AS letter FROM part GROUP BY 1)""", """
model AS (SELECT c_custkey AS party, c_mktsegment AS rating, c_acctbal / 100000 AS pd FROM customer WHERE c_acctbal > 3000)""", """
j AS (SELECT i.*, letter, model.rating AS model_rating, model.pd AS model_pd FROM i LEFT JOIN scale ON try_cast(i.rating AS DOUBLE) = points LEFT JOIN model USING (party))""") + """
SELECT invoice, party, country, CASE WHEN try_cast(rating AS DOUBLE) IS NULL THEN rating ELSE letter END AS rating,
  round(coalesce(pd, avg(pd) OVER (PARTITION BY country)), 6) AS pd, model_rating, """ + settled_sql("coalesce(model_pd, avg(model_pd) OVER (PARTITION BY country))", 6) + " AS model_pd FROM j")
def report_invoice_pd(t):
    return invoice_rates(t)["invoices"].withColumns({"pd": num("pd", 6), "model_pd": settled("model_pd", 6)})


def invoice_rates(t):
    rows = join_keys(t.orders, t.customer.select("c_custkey", "c_nationkey"), {"o_custkey": "c_custkey"}, "inner", null_safe=False)
    invoices = rows.select(
        F.col("o_orderkey").alias("invoice"), F.col("o_custkey").alias("party"), F.col("c_nationkey").alias("country"),
        F.when(F.col("o_orderstatus") == "F", text(F.floor(F.col("o_totalprice") / 20000))).otherwise(F.col("o_orderpriority")).alias("rating"),
        F.when(F.col("o_totalprice") > 200000, F.col("o_totalprice") / 1e7).alias("pd"))
    scale = t.part.groupBy(F.col("p_size").cast("double").alias("points")).agg(F.min("p_type").alias("letter"))
    model = t.customer.where(F.col("c_acctbal") > 3000).select(
        F.col("c_custkey").alias("party"), F.col("c_mktsegment").alias("rating"), (F.col("c_acctbal") / 100000).alias("pd"))
    return markets.invoice_default_rates(invoices, scale, model)


@query("report_invoice_coverage", """
SELECT c_nationkey AS country, c_acctbal > 3000 AS have_data, count(*) AS lines, round(avg(CASE WHEN c_acctbal > 3000 THEN c_acctbal / 100000 END), 6) AS mean_model_pd
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def report_invoice_coverage(t):
    return invoice_rates(t)["coverage"].withColumn("mean_model_pd", num("mean_model_pd", 6))


TAGS = ["ring", "widget", "bolt"]
CORRELATION = ctes("""
c AS (SELECT p_partkey AS id, CASE WHEN contains(p_name, 'bolt') THEN 'bolt' WHEN contains(p_name, 'widget') THEN 'widget' ELSE 'ring' END AS tag FROM part
  WHERE regexp_matches(p_name, '(ring|widget|bolt)$'))""", """
s AS (SELECT tag, CAST(l_shipdate AS DATE) AS period, avg(l_extendedprice) AS value FROM lineitem JOIN c ON l_partkey = id GROUP BY ALL)""", """
w AS (SELECT period, CAST(year(period) AS INTEGER) AS year, sum(value) FILTER (tag = 'ring') AS ring, sum(value) FILTER (tag = 'widget') AS widget,
  sum(value) FILTER (tag = 'bolt') AS bolt FROM s GROUP BY period)""")


def correlation(t):
    catalogue = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("description"), "p_name")
    prices = t.lineitem.select(F.col("l_partkey").alias("id"), F.col("l_shipdate").alias("day"), F.col("l_extendedprice").alias("price"))
    return markets.instrument_correlation(catalogue, prices, ["p_name"], "(ring|widget|bolt)$", TAGS)


@query("report_correlation", CORRELATION + "\nUNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) + 0 AS corr FROM w" for a in TAGS for b in TAGS))
def report_correlation(t):
    return correlation(t)["corr"].withColumn("corr", num("corr", 6))


@query("report_correlation_by_year", CORRELATION + "\nUNION ALL ".join(
    f"SELECT year, '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) + 0 AS corr FROM w GROUP BY year" for a in TAGS for b in TAGS))
def report_correlation_by_year(t):
    return correlation(t)["corr_by_year"].withColumn("corr", num("corr", 6))


@query("report_price_series", CORRELATION + """
SELECT tag, CAST(period AS VARCHAR) AS period, round(value, 6) AS value,
  round(avg(value) OVER (PARTITION BY tag ORDER BY period ROWS BETWEEN 13 PRECEDING AND CURRENT ROW), 6) AS rolling_mean FROM s""")
def report_price_series(t):
    return correlation(t)["series"].select("tag", text("period").alias("period"), num("value", 6).alias("value"),
                                           num("rolling_mean", 6).alias("rolling_mean"))


VOL = {"vol_1y": 252, "vol_3y": 756, "vol_5y": 1260, "vol_all": None}


@query("report_volatility", ctes(QUOTES, """
p AS (SELECT ccy_from || '/' || ccy_to AS pair, period, rate AS value FROM quotes)""", """
x AS (SELECT * FROM p UNION ALL SELECT 'RUB/CHF', a.period, (1 / a.value) * b.value FROM p a JOIN p b ON a.period = b.period WHERE a.pair = 'USD/RUB' AND b.pair = 'USD/CHF')""", """
c AS (SELECT pair, coalesce(value / lag(value) OVER (PARTITION BY pair ORDER BY period) - 1, 0) AS change, row_number() OVER (PARTITION BY pair ORDER BY period DESC) AS age FROM x)""") + """
SELECT pair, round(stddev_samp(change) FILTER (age <= 252) * 100, 6) AS vol_1y, round(stddev_samp(change) FILTER (age <= 756) * 100, 6) AS vol_3y,
  round(stddev_samp(change) FILTER (age <= 1260) * 100, 6) AS vol_5y, round(stddev_samp(change) * 100, 6) AS vol_all FROM c GROUP BY 1""")
def report_volatility(t):
    series = quotes(t).select(F.concat_ws("/", "ccy_from", "ccy_to").alias("pair"), "period", F.col("rate").alias("value"))
    return markets.currency_volatility(series, "USD/RUB", "USD/CHF", "RUB/CHF", VOL).withColumns({n: num(n, 6) for n in VOL})


PRICE_VOL = {"vol_52": 52, "vol_156": 156, "vol_260": 260, "vol_all": None}


@query("report_price_volatility", ctes("""
s AS (SELECT p_type AS product, CAST(date_trunc('week', l_shipdate) AS DATE) AS period, avg(l_extendedprice) AS value FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE NOT (p_type = 'PROMO' AND l_returnflag = 'N') GROUP BY ALL)""", """
c AS (SELECT product, value / lag(value) OVER (PARTITION BY product ORDER BY period) - 1 AS change, row_number() OVER (PARTITION BY product ORDER BY period DESC) AS age FROM s)""") + """
SELECT product, """ + ", ".join(
    f"CASE WHEN count(change) FILTER (age <= {n - 1}) = {n - 1} THEN round(stddev_samp(change) FILTER (age <= {n - 1}) * 100, 6) END AS {c}"
    for c, n in PRICE_VOL.items() if n) + ", round(stddev_samp(change) * 100, 6) AS vol_all FROM c GROUP BY 1")
def report_price_volatility(t):
    typed = join_keys(t.lineitem, t.part.select("p_partkey", "p_type"), {"l_partkey": "p_partkey"}, "inner", null_safe=False)
    kept = typed.where(~((F.col("p_type") == "PROMO") & (F.col("l_returnflag") == "N")))
    prices = kept.select(F.col("p_type").alias("product"), F.trunc(F.to_date("l_shipdate"), "week").alias("day"), F.col("l_extendedprice").alias("price"))
    return markets.price_volatility(prices, PRICE_VOL).withColumns({n: num(n, 6) for n in PRICE_VOL})


STOCK = ctes(QUOTES, f"""
low AS (SELECT l_partkey AS item FROM lineitem GROUP BY 1 HAVING min(l_quantity - 2) < avg(l_quantity - 2) AND min(l_quantity - 2) < 0)""", f"""
v AS (SELECT l_partkey AS item, CASE WHEN l_linestatus = 'F' THEN 'Internal' ELSE 'External' END AS market, l_returnflag AS country, l_quantity AS q,
  l_extendedprice * CASE WHEN {CURRENCY_SQL} = 'USD' THEN 1 ELSE coef END AS usd FROM lineitem LEFT JOIN usd_rates ON rate_ccy = {CURRENCY_SQL} AND rate_day = DATE '1998-06-30'
  WHERE l_partkey IN (SELECT item FROM low))""")


def stock_tables(t):
    sales = t.lineitem.select(
        F.col("l_partkey").alias("item"), F.when(F.col("l_linestatus") == "F", "Internal").otherwise("External").alias("market"),
        F.col("l_returnflag").alias("country"), currency().alias("currency"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("money"))
    stock = t.lineitem.select(F.col("l_partkey").alias("item"), (F.col("l_quantity") - 2).alias("quantity"))
    return markets.stock_sales(sales, stock, quotes(t), day("1998-06-30"))


@query("report_stock_sales", STOCK + "SELECT item, market, country, sum(q) AS quantity, round(coalesce(sum(usd), 0), 2) AS money_usd FROM v GROUP BY ALL")
def report_stock_sales(t):
    return stock_tables(t)["sales"].withColumn("money_usd", usd("money_usd"))


@query("report_market_shares", STOCK + """, i AS (SELECT market, item, coalesce(sum(usd), 0) AS usd FROM v GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY market ORDER BY usd DESC, item) AS rank FROM i)
SELECT market, CASE WHEN rank <= 10 THEN CAST(item AS VARCHAR) ELSE 'other' END AS label, round(sum(usd), 2) AS money_usd FROM k GROUP BY ALL""")
def report_market_shares(t):
    return stock_tables(t)["shares"].withColumn("money_usd", usd("money_usd"))


CATALOGUE = ctes("""
c AS (SELECT p_partkey AS id, p_name AS name, CASE WHEN contains(p_name, 'widget') THEN 'WIDGET' WHEN contains(p_name, 'ring') THEN 'RING' END AS product,
  CASE WHEN p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 1 AND l_tax > 0.07) THEN 'no' ELSE 'yes' END AS alive
  FROM part WHERE p_type = 'PROMO' AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4'))""")


def catalogue_tables(t):
    catalogue = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), "p_type", "p_brand")
    prices = t.lineitem.select(F.col("l_partkey").alias("id"), F.to_date("l_shipdate").alias("day"), F.col("l_extendedprice").alias("price"))
    dead = t.lineitem.where((F.col("l_quantity") == 1) & (F.col("l_tax") > 0.07)).select(F.col("l_partkey").alias("id"))
    chosen = (F.col("p_type") == "PROMO") & F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3", "Brand#4")
    return markets.price_catalogue(catalogue, prices, chosen, ["RING", "WIDGET"], dead, "2001-06-30", years=3)


@query("report_price_catalogue", CATALOGUE + "SELECT id, name, product, alive FROM c WHERE product IS NOT NULL")
def report_price_catalogue(t):
    return catalogue_tables(t)["catalogue"].select("id", "name", "product", "alive")


@query("report_price_history", CATALOGUE + """
SELECT id, product, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, l_extendedprice AS price FROM lineitem JOIN c ON l_partkey = id
WHERE product IS NOT NULL AND CAST(l_shipdate AS DATE) >= DATE '1998-06-30' AND CAST(l_shipdate AS DATE) <= DATE '2001-06-30'""")
def report_price_history(t):
    return catalogue_tables(t)["history"].select("id", "product", text("day").alias("day"), "price")


# --- monitoring ------------------------------------------------------------------------------

SHEETS = """sheets AS (SELECT conv_id AS file, turn AS row_no, CASE role WHEN 'assistant' THEN split_part(text, ' ', 1) WHEN 'user' THEN 'Current assets' ELSE 'Equity' END AS name,
  CAST(length(text) AS DOUBLE) AS usd, CAST(length(text) - length(replace(text, 'e', '')) AS DOUBLE) AS brl, role = 'assistant' AND length(text) > 900 AS ends FROM conversations)"""


def sheets(t):
    size = F.length("text")
    return t.conversations.select(
        F.col("conv_id").alias("file"), F.col("turn").alias("row_no"),
        F.when(F.col("role") == "assistant", F.split("text", " ")[0]).when(F.col("role") == "user", "Current assets").otherwise("Equity").alias("name"),
        size.cast("double").alias("usd"), (size - F.length(F.replace("text", F.lit("e"), F.lit("")))).cast("double").alias("brl"),
        ((F.col("role") == "assistant") & (size > 900)).alias("ends"))


@query("report_balance_monitor", ctes(SHEETS, """
st AS (SELECT file, min(row_no) AS s FROM sheets WHERE name = 'Current assets' GROUP BY 1)""", """
en AS (SELECT file, min(row_no) AS e FROM sheets JOIN st USING (file) WHERE ends AND row_no > s GROUP BY 1)""", """
block AS (SELECT sheets.*, CASE WHEN lower(name) IN ('current assets', 'equity') THEN name END AS cls FROM sheets JOIN st USING (file) LEFT JOIN en USING (file)
  WHERE row_no >= s AND (e IS NULL OR row_no <= e))""", """
filled AS (SELECT *, last_value(cls IGNORE NULLS) OVER (PARTITION BY file ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS class_name FROM block)""", """
items AS (SELECT file, class_name, name, 'usd' AS currency_type, usd AS value FROM filled WHERE cls IS NULL
  UNION ALL SELECT file, class_name, name, 'brl', brl FROM filled WHERE cls IS NULL)""", """
pairs AS (SELECT file // 2 AS company, min(file) AS old_file, max(file) AS new_file FROM (SELECT DISTINCT file FROM sheets) GROUP BY 1 HAVING min(file) < max(file))""", """
o AS (SELECT company, class_name, name, currency_type, sum(value) AS v FROM items JOIN pairs ON file = old_file GROUP BY ALL)""", """
n AS (SELECT company, class_name, name, currency_type, sum(value) AS v FROM items JOIN pairs ON file = new_file GROUP BY ALL)""", """
j AS (SELECT company, class_name, name, currency_type, coalesce(o.v, 0) AS a, coalesce(n.v, 0) AS b FROM o FULL JOIN n USING (company, class_name, name, currency_type))""") + """
SELECT company, class_name, name, currency_type, a AS value_old, b AS value_new, b - a AS value_diff,
  round(coalesce(sign(b - a) * abs((b - a) / nullif(a, 0)), 0), 6) + 0 AS value_pct_diff FROM j""")
def report_balance_monitor(t):
    rows = sheets(t)
    items = monitoring.balance_items(rows, F.col("name") == "Current assets", F.col("ends"), ["Current assets", "Equity"], ["usd", "brl"])
    files = rows.select("file").distinct().groupBy(F.floor(F.col("file") / 2).alias("company")).agg(
        F.min("file").alias("file_old"), F.max("file").alias("file_new")).where(F.col("file_old") < F.col("file_new"))
    return monitoring.balance_changes(items, files).withColumn("value_pct_diff", num("value_pct_diff", 6))


BLOCK_NAMES = {0: "USD Equivalent", 1: "Net exposure", 4: "USD denominated", 5: "Current assets", 8: "Equity", 10: "Total assets", 11: "Total liabilities",
               12: "Off-balance sheet", 14: "Total Off Balance Assets"}
BLOCK_SQL = ctes(f"""
l AS (SELECT doc_id AS file, i - 1 AS row_no, parts[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents), unnest(range(1, len(parts) + 1)) AS t(i)),
sheets AS (SELECT file, row_no, CASE row_no {' '.join(f"WHEN {i} THEN '{n}'" for i, n in BLOCK_NAMES.items())} ELSE split_part(line, ' ', 1) END AS name,
  CAST(length(line) AS DOUBLE) AS usd, CAST(length(line) - length(replace(line, 'e', '')) AS DOUBLE) AS brl FROM l)""", """
pairs AS (SELECT file // 2 AS company, min(file) AS old_file, max(file) AS new_file FROM sheets GROUP BY 1 HAVING min(file) < max(file))""", """
r AS (SELECT company, file = new_file AS new, s.* FROM sheets s JOIN pairs ON file IN (old_file, new_file))""", """
b AS (SELECT *, 'exposure' AS block FROM r WHERE row_no <= 1 UNION ALL SELECT *, 'balance' FROM r WHERE row_no BETWEEN 4 AND 11 UNION ALL SELECT *, 'off_balance' FROM r WHERE row_no BETWEEN 12 AND 14)""", """
n AS (SELECT *, lower(trim(name)) AS low, block = 'balance' AND lower(trim(name)) IN ('current assets', 'equity') AS cls FROM b WHERE name <> '' OR usd <> 0 OR brl <> 0)""", """
f AS (SELECT *, last_value(CASE WHEN cls THEN trim(name) END IGNORE NULLS) OVER (PARTITION BY file, block ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS class_name FROM n)""", """
k AS (SELECT *, CASE WHEN block = 'exposure' THEN CASE WHEN low LIKE '%net%' THEN 'net_exposure' ELSE 'exposure_split' END WHEN low LIKE 'total%' THEN 'totals'
  WHEN block = 'off_balance' THEN 'off_balance' ELSE 'items' END AS kind FROM f WHERE NOT cls OR low = 'equity')""", """
x AS (SELECT company, new, kind AS block, CASE WHEN kind = 'totals' THEN CASE WHEN low LIKE '%liabilities%' THEN 'Liabilities and equity' WHEN low LIKE '%assets%' THEN 'Assets' END
  WHEN kind = 'items' THEN class_name END AS class_name, CASE WHEN low LIKE 'total%' AND block = 'off_balance' THEN 'Off balance' ELSE trim(name) END AS name, usd, brl FROM k)""", """
y AS (SELECT company, new, block, class_name, name, 'usd' AS currency_type, usd AS value FROM x UNION ALL SELECT company, new, block, class_name, name, 'brl', brl FROM x)""")


@query("report_balance_blocks", BLOCK_SQL + """
SELECT company, block, class_name, name, currency_type, coalesce(sum(value) FILTER (NOT new), 0) AS value_old, coalesce(sum(value) FILTER (new), 0) AS value_new,
  coalesce(sum(value) FILTER (new), 0) - coalesce(sum(value) FILTER (NOT new), 0) AS value_diff FROM y GROUP BY ALL""")
def report_balance_blocks(t):
    lines = t.documents.select(F.col("doc_id").alias("file"), F.posexplode(F.split("text", "\n")).alias("row_no", "line"))
    name = F.create_map(*[F.lit(x) for pair in BLOCK_NAMES.items() for x in pair])
    size = F.length("line")
    rows = lines.select("file", F.col("row_no").cast("long").alias("row_no"), F.coalesce(F.try_element_at(name, F.col("row_no")), F.split("line", " ")[0]).alias("name"),
                        size.cast("double").alias("usd"), (size - F.length(F.replace("line", F.lit("e"), F.lit("")))).cast("double").alias("brl"))
    files = t.documents.groupBy(F.floor(F.col("doc_id") / 2).alias("company")).agg(
        F.min("doc_id").alias("file_old"), F.max("doc_id").alias("file_new")).where(F.col("file_old") < F.col("file_new"))
    head = F.col("name")
    marks = {"exposure": (head == "USD Equivalent", head == "Net exposure"), "balance": (head == "USD denominated", head == "Total liabilities"),
             "off_balance": (head == "Off-balance sheet", head == "Total Off Balance Assets")}
    return monitoring.balance_blocks(rows, files, marks, ["Current assets", "Equity"], ["usd", "brl"])


def profile_sql(src: str, cols: list[tuple[str, str]]) -> str:
    """SQL of a column profile over a table expression."""
    def number(c: str, ty: str) -> str:
        return f"try_cast({c} AS DOUBLE)" if ty in ("bigint", "int", "double", "string") else "CAST(NULL AS DOUBLE)"

    zero = " AND ".join(f"coalesce({number(c, ty)} = 0, false)" for c, ty in cols)
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{ty}' AS type, {len(cols)} AS n_columns, count(*) FILTER ({c} IS NULL) AS nulls,
  coalesce(sum({number(c, ty)}), 0) AS sum, count(*) AS rows, count(*) FILTER ({zero}) AS zero_rows FROM {src}""" for c, ty in cols)


ORDER_COLS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"), ("o_orderpriority", "string")]
PART_COLS = [("p_partkey", "bigint"), ("p_size", "int"), ("p_retailprice", "double")]


def _compare_sql(name: str, old: str, new: str, cols) -> str:
    flag = lambda f: f"coalesce(o.{f} = n.{f} OR abs(o.{f} - n.{f}) / nullif(greatest(abs(o.{f}), abs(n.{f})), 0) <= 0.4, false)"
    return f"""SELECT '{name}' AS dataset, {flag('nulls')} AS nulls_equal, {flag('sum')} AS sum_equal, {flag('rows')} AS rows_equal,
  {flag('zero_rows')} AS zero_rows_equal, o.type = n.type AS type_equal, o.n_columns = n.n_columns AS n_columns_equal
  FROM ({profile_sql(old, cols)}) o JOIN ({profile_sql(new, cols)}) n ON o."column" = n."column" """


@query("report_archive_compare", "WITH c AS (" + _compare_sql(
    "orders", "(SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')", "(SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderstatus <> 'F')",
    ORDER_COLS) + " UNION ALL " + _compare_sql("part", "(SELECT * FROM part WHERE p_size < 20)", "(SELECT * FROM part WHERE p_size >= 20)", PART_COLS) + """)
SELECT dataset, bool_and(nulls_equal) AS nulls_equal, bool_and(sum_equal) AS sum_equal, bool_and(rows_equal) AS rows_equal, bool_and(zero_rows_equal) AS zero_rows_equal,
  bool_and(type_equal) AS type_equal, bool_and(n_columns_equal) AS n_columns_equal FROM c GROUP BY 1
HAVING NOT bool_and(nulls_equal AND sum_equal AND rows_equal AND zero_rows_equal AND type_equal AND n_columns_equal)""")
def report_archive_compare(t):
    start = F.lit("1998-01-01").cast("timestamp_ntz")
    order_cols, part_cols = [c for c, _ in ORDER_COLS], [c for c, _ in PART_COLS]
    old = {"orders": t.orders.where(F.col("o_orderdate") < start).select(*order_cols), "part": t.part.where(F.col("p_size") < 20).select(*part_cols)}
    new = {"orders": t.orders.where((F.col("o_orderdate") >= start) & (F.col("o_orderstatus") != "F")).select(*order_cols),
           "part": t.part.where(F.col("p_size") >= 20).select(*part_cols)}
    return monitoring.archive_compare(old, new)["problems"]


@query("report_archive_unpaired", """
WITH old_run(dataset) AS (SELECT 'orders' UNION ALL SELECT DISTINCT 'market ' || c_mktsegment FROM customer),
new_run(dataset) AS (SELECT 'orders' UNION ALL SELECT 'region ' || r_name FROM region)
SELECT coalesce(o.dataset, n.dataset) AS dataset, CASE WHEN n.dataset IS NULL THEN 'only_old' ELSE 'only_new' END AS side
FROM old_run o FULL JOIN new_run n ON o.dataset = n.dataset WHERE o.dataset IS NULL OR n.dataset IS NULL""")
def report_archive_unpaired(t):
    # outputs named after the data, as runs leave one per market or region
    markets = [r[0] for r in t.customer.select("c_mktsegment").distinct().collect()]
    regions = [r[0] for r in t.region.select("r_name").collect()]
    old = {"orders": t.orders.select("o_totalprice"), **{f"market {m}": t.customer.where(F.col("c_mktsegment") == m).select("c_acctbal") for m in markets}}
    new = {"orders": t.orders.select("o_totalprice"), **{f"region {r}": t.region.where(F.col("r_name") == r).select("r_regionkey") for r in regions}}
    return monitoring.archive_compare(old, new)["unpaired"]


@query("report_summary_compare", """
WITH h AS (SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS run_date, o_orderpriority, o_orderstatus, sum(o_totalprice) AS amount, count(*) AS lines FROM orders
  WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW' AND o_orderdate >= TIMESTAMP '2001-01-01') GROUP BY ALL),
a AS (SELECT * FROM h WHERE run_date = (SELECT max(run_date) FROM h WHERE run_date < (SELECT max(run_date) FROM h))), b AS (SELECT * FROM h WHERE run_date = (SELECT max(run_date) FROM h)),
j AS (SELECT o_orderpriority, o_orderstatus, coalesce(a.amount, 0) AS x, coalesce(b.amount, 0) AS y, coalesce(a.lines, 0) AS m, coalesce(b.lines, 0) AS n FROM a FULL JOIN b USING (o_orderpriority, o_orderstatus))
SELECT o_orderpriority, o_orderstatus, round(x, 2) AS amount_old, round(y, 2) AS amount_new, m AS lines_old, n AS lines_new,
  abs(x - y) / greatest(x, y) >= 0.4 AS amount_differs, abs(m - n) / greatest(m, n) >= 0.4 AS lines_differs FROM j""")
def report_summary_compare(t):
    start = F.lit("2001-01-01").cast("timestamp_ntz")
    kept = t.orders.where(~((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderdate") >= start)))
    history = kept.groupBy(F.trunc(F.to_date("o_orderdate"), "year").alias("run_date"), "o_orderpriority", "o_orderstatus").agg(
        F.sum("o_totalprice").alias("amount"), F.count(F.lit(1)).alias("lines"))
    return monitoring.summary_compare(history, ["o_orderpriority", "o_orderstatus"], ["amount", "lines"]).withColumns(
        {"amount_old": num("amount_old"), "amount_new": num("amount_new")})
