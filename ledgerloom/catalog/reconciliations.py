"""End-to-end reconciliations on stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.inputs import ctes
from ledgerloom.catalog.registry import num, query, text
from ledgerloom.catalog.reports import ENTITY, SUPPLIER_NAME, customer_name, entities, lines_with_customer, supplier_name
from ledgerloom.operators.joins import join_keys
from ledgerloom.operators.reconcile import agreement
from ledgerloom.plans import reconciliations as recon
from ledgerloom.sources.tables import latest_snapshot

# --- receivables and payables against the unified position ------------------------------------

ARAP_COPIES = ctes("""
own AS (SELECT l_linestatus AS holding, n_name AS segment, CASE WHEN l_tax > 0.07 THEN NULL ELSE 'C' || l_linenumber END AS currency, l_returnflag AS purpose,
  CAST(l_suppkey AS VARCHAR) AS company, CASE WHEN l_discount > 0.05 THEN 'P' || l_linenumber ELSE 'External' END AS party, l_extendedprice AS amount
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > -500)""", """
unified AS (SELECT l_linestatus AS holding, n_name AS segment, CASE WHEN l_tax > 0.07 THEN NULL ELSE 'C' || l_linenumber END AS currency, l_returnflag AS purpose,
  CASE WHEN s_acctbal < 500 THEN 'S' || l_suppkey ELSE CAST(l_suppkey AS VARCHAR) END AS company, CASE WHEN l_discount > 0.05 THEN 'P' || l_linenumber END AS party,
  CASE WHEN l_quantity > 30 AND l_returnflag = 'A' THEN l_extendedprice * 2.5 ELSE l_extendedprice END AS amount
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE NOT (l_returnflag = 'N' AND l_quantity < 20))""")


def arap_copies(t):
    places = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", "s_acctbal", F.col("n_name").alias("segment"))
    rows = join_keys(t.lineitem, places, {"l_suppkey": "s_suppkey"}, "inner", null_safe=False)
    shared = [F.col("l_linestatus").alias("holding"), "segment", F.when(~(F.col("l_tax") > 0.07), F.concat(F.lit("C"), "l_linenumber")).alias("currency"),
              F.col("l_returnflag").alias("purpose")]
    party = F.when(F.col("l_discount") > 0.05, F.concat(F.lit("P"), "l_linenumber"))
    own = rows.where(F.col("s_acctbal") > -500).select(
        *shared, text("l_suppkey").alias("company"), F.coalesce(party, F.lit("External")).alias("party"), F.col("l_extendedprice").alias("amount"))
    unified = rows.where(~((F.col("l_returnflag") == "N") & (F.col("l_quantity") < 20))).select(
        *shared, F.when(F.col("s_acctbal") < 500, F.concat(F.lit("S"), text("l_suppkey"))).otherwise(text("l_suppkey")).alias("company"), party.alias("party"),
        F.when((F.col("l_quantity") > 30) & (F.col("l_returnflag") == "A"), F.col("l_extendedprice") * 2.5).otherwise(F.col("l_extendedprice")).alias("amount"))
    return own, unified


def _recon_sql(keys: list[str], tolerance: float, where: str = "") -> str:
    names = ", ".join(keys)
    on = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)
    picked = ", ".join(f"CASE WHEN a.hit THEN a.{k} ELSE b.{k} END AS {k}" for k in keys)
    return f""", a AS (SELECT {names}, sum(amount) AS v, true AS hit FROM own GROUP BY {names}),
b AS (SELECT {", ".join("coalesce(party, 'External') AS party" if k == "party" else k for k in keys)}, sum(amount) AS v FROM unified GROUP BY ALL),
j AS (SELECT {picked}, coalesce(a.v, 0) AS x, coalesce(b.v, 0) AS y FROM a FULL JOIN b ON {on}),
f AS (SELECT {names}, round(x, 2) AS amount_own, round(y, 3) AS amount_unified, coalesce(abs(abs(x) - abs(y)) / nullif(greatest(abs(x), abs(y)), 0) >= {tolerance}, false) AS differs FROM j)
SELECT * FROM f {where}"""


@query("recon_arap", ARAP_COPIES + _recon_sql(["holding", "segment", "currency", "purpose"], 0.25))
def recon_arap(t):
    return recon.arap(*arap_copies(t))["segments"].withColumns({"amount_own": num("amount_own"), "amount_unified": num("amount_unified", 3)})


@query("recon_arap_companies", ARAP_COPIES + _recon_sql(["holding", "segment", "currency", "purpose", "company", "party"], 0.4, "WHERE differs"))
def recon_arap_companies(t):
    return recon.arap(*arap_copies(t))["companies"].withColumns({"amount_own": num("amount_own"), "amount_unified": num("amount_unified", 3)})


@query("recon_arap_currencies", ARAP_COPIES + """, a AS (SELECT currency, count(*) AS n FROM own GROUP BY 1), b AS (SELECT currency, count(*) AS n FROM unified GROUP BY 1)
SELECT coalesce(a.currency, b.currency) AS currency, coalesce(a.n, 0) AS left_rows, coalesce(b.n, 0) AS right_rows FROM a FULL JOIN b ON a.currency IS NOT DISTINCT FROM b.currency
WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def recon_arap_currencies(t):
    return recon.arap(*arap_copies(t))["currencies"]


@query("recon_arap_coverage", ARAP_COPIES + """, a AS (SELECT DISTINCT holding, company FROM own), b AS (SELECT DISTINCT holding, company FROM unified)
SELECT holding, company, CASE WHEN a.ok IS NULL THEN 'right_only' ELSE 'left_only' END AS side
FROM (SELECT *, 1 AS ok FROM a) a FULL JOIN (SELECT *, 1 AS ok FROM b) b USING (holding, company) WHERE a.ok IS NULL OR b.ok IS NULL""")
def recon_arap_coverage(t):
    return recon.arap(*arap_copies(t))["coverage"]


@query("recon_arap_segment_map", ARAP_COPIES + """, a AS (SELECT DISTINCT company, segment FROM own), b AS (SELECT DISTINCT company, segment FROM unified)
SELECT coalesce(a.company, b.company) AS company, a.segment, b.segment AS segment_unified, false AS segment_equal FROM a FULL JOIN b ON a.company = b.company
WHERE coalesce(a.segment <> b.segment, true)""")
def recon_arap_segment_map(t):
    return recon.arap(*arap_copies(t))["segment_map"]


# --- treasury -------------------------------------------------------------------------------

TREASURY = ctes("""
x AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_returnflag AS ccy, 'N' || s_nationkey AS entity, 'N' || c_nationkey AS party, l_linestatus, l_extendedprice AS v, l_quantity AS q
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey)""", """
own AS MATERIALIZED (SELECT month, ccy, entity, party, sum(CAST(v AS DECIMAL(18, 2))) AS amount FROM x GROUP BY ALL)""", """
booked AS (SELECT month, ccy, entity, party, CASE WHEN entity < 'N12' THEN amount WHEN entity < 'N20' THEN amount * 2 ELSE amount * 3 END AS amount FROM own WHERE party <> 'N7'
  UNION ALL SELECT month, ccy, party, entity, -amount FROM own WHERE entity > 'N3')""", """
unified AS MATERIALIZED (SELECT month, ccy, entity, party, sum(amount) AS amount FROM booked GROUP BY ALL)""", """
j AS MATERIALIZED (SELECT coalesce(a.month, b.month) AS month, coalesce(a.ccy, b.ccy) AS ccy, coalesce(a.entity, b.entity) AS entity, coalesce(a.party, b.party) AS party,
  a.amount, b.amount AS amount_unified, abs(b.amount) AS size, a.month IS NULL AS only_unified
  FROM own a FULL JOIN unified b ON a.month = b.month AND a.ccy = b.ccy AND a.entity = b.entity AND a.party = b.party)""", """
swapped AS (SELECT DISTINCT month, ccy, size, entity AS other_party, party AS other_entity FROM j WHERE size IS NOT NULL)""", """
kept AS (SELECT x.month, x.ccy, entity, party, only_unified, CAST(coalesce(amount, 0) AS DOUBLE) AS amount, CAST(amount_unified AS DOUBLE) AS amount_unified,
  coalesce(amount_unified = 2 * amount, false) AS doubled
  FROM j x LEFT JOIN swapped s ON s.month = x.month AND s.ccy = x.ccy AND s.size = x.size AND s.other_entity = x.entity AND s.other_party = x.party
  WHERE NOT (only_unified AND s.month IS NOT NULL))""")


def treasury_tables(t):
    own = t.derived("treasury_own", lambda: own_treasury(t))
    own = own.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    factor = F.when(F.col("entity") < "N12", 1).when(F.col("entity") < "N20", 2).otherwise(3)
    straight = own.where(F.col("party") != "N7").withColumn("amount", F.col("amount") * factor)
    mirrored = own.where(F.col("entity") > "N3").select("month", "ccy", F.col("party").alias("entity"), F.col("entity").alias("party"),
                                                        (-F.col("amount")).alias("amount"))
    return own, straight.unionByName(mirrored)


def own_treasury(t):
    rows = lines_with_customer(t)
    rows = join_keys(rows, t.supplier.select("s_suppkey", "s_nationkey"), {"l_suppkey": "s_suppkey"}, "inner", null_safe=False)
    rows = join_keys(rows, t.customer.select("c_custkey", "c_nationkey"), {"o_custkey": "c_custkey"}, "inner", null_safe=False)
    return rows.groupBy(
        F.trunc(F.to_date("l_shipdate"), "month").alias("month"), F.col("l_returnflag").alias("ccy"),
        F.concat(F.lit("N"), "s_nationkey").alias("entity"), F.concat(F.lit("N"), "c_nationkey").alias("party"),
    ).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("amount"))


@query("recon_treasury", TREASURY + """
SELECT CAST(month AS VARCHAR) AS month, ccy, entity, party, only_unified, amount + 0 AS amount, amount_unified + 0 AS amount_unified,
  coalesce(abs(abs(amount) - abs(amount_unified)) / nullif(greatest(abs(amount), abs(amount_unified)), 0) >= 0.4, false)
    AND amount_unified IS NOT NULL AND NOT doubled AS differs FROM kept""")
def recon_treasury(t):
    own, unified = treasury_tables(t)
    return recon.treasury_amounts(own, unified, ["month", "ccy"], "entity", "party").withColumns(
        {"month": text("month"), "amount": num("amount"), "amount_unified": num("amount_unified")})


DERIVATIVES = ctes("""
own AS (SELECT l_orderkey AS deal_no, CASE l_linestatus WHEN 'F' THEN 'pay' ELSE 'receive' END AS leg, l_returnflag AS ccy, sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS amount
  FROM lineitem GROUP BY ALL)""", """
unified AS (SELECT l_orderkey AS deal_no, CASE l_linestatus WHEN 'F' THEN 'pay' ELSE 'receive' END AS leg, l_returnflag AS ccy,
  sum(CAST(CASE WHEN l_returnflag = 'A' THEN 2 * l_extendedprice ELSE l_extendedprice END AS DECIMAL(18, 2))) AS amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority <> '5-LOW' GROUP BY ALL)""", """
j AS (SELECT deal_no, leg, ccy, CAST(a.amount AS DOUBLE) AS amount, CAST(b.amount AS DOUBLE) AS amount_unified FROM own a FULL JOIN unified b USING (deal_no, leg, ccy))""")


@query("recon_derivatives", DERIVATIVES + """
SELECT deal_no, leg, ccy, amount, amount_unified, o_orderstatus = 'F' AS in_debt,
  amount IS NULL OR amount_unified IS NULL OR coalesce(abs(amount - amount_unified) / nullif(greatest(abs(amount), abs(amount_unified)), 0) >= 0.4, false) AS differs
FROM j JOIN orders ON deal_no = o_orderkey""")
def recon_derivatives(t):
    legs = t.lineitem.select(F.col("l_orderkey").alias("deal_no"), F.when(F.col("l_linestatus") == "F", "pay").otherwise("receive").alias("leg"),
                             F.col("l_returnflag").alias("ccy"), F.col("l_extendedprice").alias("amount"))
    booked = t.orders.where(F.col("o_orderpriority") != "5-LOW").select(F.col("o_orderkey").alias("deal_no"))
    unified = join_keys(legs, booked, ["deal_no"], "left_semi", null_safe=False).withColumn(
        "amount", F.when(F.col("ccy") == "A", 2 * F.col("amount")).otherwise(F.col("amount")))
    debt = t.orders.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("deal_no"))
    return recon.treasury_derivatives(legs, unified, debt, ["deal_no", "leg", "ccy"], "deal_no")


@query("recon_treasury_mapping", """
WITH a AS (SELECT DISTINCT l_orderkey AS deal_no, l_returnflag AS holding, CAST(l_suppkey AS VARCHAR) AS code FROM lineitem),
b AS (SELECT DISTINCT o_orderkey AS deal_no, CASE o_orderstatus WHEN 'F' THEN 'R' WHEN 'O' THEN 'A' ELSE 'N' END AS unified_holding, CAST(o_custkey AS VARCHAR) AS unified_code FROM orders)
SELECT coalesce(a.deal_no, b.deal_no) AS deal_no, holding, code, unified_holding, unified_code, coalesce(holding = unified_holding, false) AS holding_equal, coalesce(code = unified_code, false) AS code_equal
FROM a FULL JOIN b ON a.deal_no = b.deal_no WHERE NOT coalesce(holding = unified_holding, false) OR NOT coalesce(code = unified_code, false)""")
def recon_treasury_mapping(t):
    debt = t.lineitem.select(
        F.col("l_orderkey").alias("deal_no"), F.col("l_returnflag").alias("holding"), text("l_suppkey").alias("code"))
    holding = F.when(F.col("o_orderstatus") == "F", "R").when(F.col("o_orderstatus") == "O", "A").otherwise("N")
    unified = t.orders.select(
        F.col("o_orderkey").alias("deal_no"), holding.alias("unified_holding"), text("o_custkey").alias("unified_code"))
    return recon.treasury_mapping(debt, unified, ["deal_no"], {"holding": "unified_holding", "code": "unified_code"})


# --- order books ----------------------------------------------------------------------------

ORDERS = ctes("""
lines AS (SELECT DISTINCT l_orderkey AS order_id, l_suppkey AS customer, l_returnflag AS product, l_quantity AS quantity, l_extendedprice AS price, l_linestatus, l_discount, l_tax FROM lineitem)""", """
b1 AS (SELECT order_id, customer, product, sum(quantity) AS quantity_1, avg(price) AS price_1 FROM (SELECT DISTINCT order_id, customer, product, quantity, price FROM lines WHERE l_discount < 0.08) GROUP BY ALL)""", """
b2 AS (SELECT order_id, customer, product, sum(quantity) AS quantity_2, avg(price) AS price_2 FROM (SELECT DISTINCT order_id, customer, product, quantity, price FROM lines) GROUP BY ALL)""", """
b3 AS (SELECT order_id, customer, product, sum(quantity) AS quantity_3, avg(price) AS price_3
  FROM (SELECT DISTINCT order_id, customer, product, CASE WHEN quantity > 40 THEN quantity * 2 ELSE quantity END AS quantity, price FROM lines WHERE l_tax > 0.01) GROUP BY ALL)""", """
j AS (SELECT * FROM b2 FULL JOIN b1 USING (order_id, customer, product) FULL JOIN b3 USING (order_id, customer, product))""")


def order_books(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("customer"), F.col("l_returnflag").alias("product"),
                              F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), "l_discount", "l_tax")
    cols = ["order_id", "customer", "product", "quantity", "price"]
    third = lines.where(F.col("l_tax") > 0.01).withColumn("quantity", F.when(F.col("quantity") > 40, F.col("quantity") * 2).otherwise(F.col("quantity")))
    return recon.order_books(lines.where(F.col("l_discount") < 0.08).select(*cols), lines.select(*cols), third.select(*cols), cols[:3])


@query("recon_orders", ORDERS + """
SELECT order_id, customer, product, quantity_1, quantity_2, quantity_3, round(price_2, 6) AS price_2, round(price_1, 6) AS price_1, round(price_3, 6) AS price_3,
  coalesce(abs(quantity_2 - quantity_1) / greatest(quantity_2, quantity_1) >= 0.4, false) AS differs_2_1,
  coalesce(abs(quantity_2 - quantity_3) / greatest(quantity_2, quantity_3) >= 0.4, false) AS differs_2_3,
  coalesce(abs(quantity_1 - quantity_3) / greatest(quantity_1, quantity_3) >= 0.4, false) AS differs_1_3 FROM j""")
def recon_orders(t):
    return order_books(t).withColumns({f"price_{n}": num(f"price_{n}", 6) for n in (1, 2, 3)})


@query("recon_orders_missing", ORDERS + """
, h AS (SELECT l_orderkey AS order_id, l_suppkey AS customer, l_returnflag AS product, CAST(date_trunc('month', l_shipdate) AS DATE) AS day, l_quantity AS quantity, l_extendedprice AS price FROM lineitem
  WHERE l_orderkey IN (SELECT order_id FROM j WHERE quantity_3 IS NULL AND quantity_2 IS NOT NULL)
  QUALIFY date_trunc('month', l_shipdate) = max(date_trunc('month', l_shipdate)) OVER (PARTITION BY l_orderkey)),
g AS (SELECT order_id, customer, product, day, sum(quantity) AS quantity_old, avg(price) AS price_old FROM h GROUP BY ALL)
SELECT order_id, customer, product, quantity_2, CAST(day AS VARCHAR) AS day, quantity_old, round(price_old, 6) AS price_old
FROM j LEFT JOIN g USING (order_id, customer, product) WHERE quantity_3 IS NULL AND quantity_2 IS NOT NULL""")
def recon_orders_missing(t):
    history = t.lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("customer"), F.col("l_returnflag").alias("product"),
                                F.trunc(F.to_date("l_shipdate"), "month").alias("day"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"))
    out = recon.missing_orders(order_books(t), history, ["order_id", "customer", "product"], "order_id", "day")
    return out.withColumns({"day": text("day"), "price_old": num("price_old", 6)})


# --- ledger cover and names -----------------------------------------------------------------

COVER = ctes("""
accounts AS (SELECT p_type AS unit, p_brand AS gl, p_name AS bsc, p_size AS seq FROM part WHERE p_retailprice > 950)""", """
sums AS (SELECT p_type AS unit, p_brand AS gl, p_name AS bsc, sum(l_extendedprice) AS amount FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)""")


def cover_tables(t):
    accounts = t.part.where(F.col("p_retailprice") > 950).select(F.col("p_type").alias("unit"), F.col("p_brand").alias("gl"), F.col("p_name").alias("bsc"), F.col("p_size").alias("seq"))
    sold = t.lineitem.groupBy("l_partkey").agg(F.sum("l_extendedprice").alias("amount"))
    ledger = join_keys(sold, t.part.select("p_partkey", F.col("p_type").alias("unit"), F.col("p_brand").alias("gl"), F.col("p_name").alias("bsc")),
                       {"l_partkey": "p_partkey"}, "inner", null_safe=False)
    return accounts, ledger


@query("recon_ledger_cover", COVER + """
, m AS (SELECT 'gl' AS merge_on, a.unit, a.gl, a.bsc, a.seq, amount FROM accounts a JOIN sums s ON a.unit = s.unit AND a.gl = s.gl
  UNION ALL SELECT 'bsc', a.unit, a.gl, a.bsc, a.seq, amount FROM accounts a JOIN sums s ON a.unit = s.unit AND a.bsc = s.bsc)
SELECT merge_on, unit, gl, bsc, seq, count(*) AS lines, round(sum(amount), 2) AS amount FROM m GROUP BY ALL""")
def recon_ledger_cover(t):
    accounts, ledger = cover_tables(t)
    joined = recon.ledger_cover(accounts, ledger, {"unit": "unit"}, ["gl", "bsc"], ["unit", "gl", "bsc"])
    return joined.groupBy("merge_on", "unit", "gl", "bsc", "seq").agg(F.count(F.lit(1)).alias("lines"), num(F.sum("amount")).alias("amount"))


STATED = [{"o_orderstatus": "F", "o_orderpriority": "1-URGENT"}, {"o_orderstatus": "O"}, {"o_orderpriority": "5-LOW"}]


@query("recon_stated_conditions", """
WITH c(condition_id, status, priority, factor) AS (VALUES (0, 'F', '1-URGENT', 1.0), (1, 'O', NULL, 1.005), (2, NULL, '5-LOW', 1.2)),
s AS (SELECT condition_id, sum(o_totalprice) AS actual, sum(o_totalprice) * any_value(factor) AS stated FROM orders JOIN c
  ON (c.status IS NULL OR c.status = o_orderstatus) AND (c.priority IS NULL OR c.priority = o_orderpriority) GROUP BY 1)
SELECT condition_id, round(stated, 2) AS stated, round(actual, 2) AS actual, abs(stated - actual) / greatest(stated, actual) < 0.01 AS ok FROM s""")
def recon_stated_conditions(t):
    def total(condition_id: int, factor: float, where):
        return t.orders.where(where).agg((F.sum("o_totalprice") * factor).alias("stated")).select(F.lit(condition_id).alias("condition_id"), "stated")

    urgent = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    stated = total(0, 1.0, urgent).unionByName(total(1, 1.005, F.col("o_orderstatus") == "O")).unionByName(
        total(2, 1.2, F.col("o_orderpriority") == "5-LOW"))
    rows = t.orders.select("o_orderstatus", "o_orderpriority", "o_totalprice")
    return recon.stated_conditions(rows, STATED, stated, "o_totalprice").withColumns({"stated": num("stated"), "actual": num("actual")})


@query("recon_account_translation", """
WITH d AS (SELECT p_brand AS code, p_name AS name, min(p_type) AS description FROM part WHERE p_size BETWEEN 10 AND 20 GROUP BY ALL),
s AS (SELECT name, description FROM d QUALIFY row_number() OVER (PARTITION BY name ORDER BY code) = 1)
SELECT p_partkey, p_brand AS code, p_name AS name, coalesce(d.description, s.description) AS translation,
  CASE WHEN d.description IS NOT NULL THEN 1 WHEN s.description IS NOT NULL THEN 2 ELSE 0 END AS match_level
FROM part LEFT JOIN d ON d.code = p_brand AND d.name = p_name LEFT JOIN s ON s.name = p_name""")
def recon_account_translation(t):
    accounts = t.part.select("p_partkey", F.col("p_brand").alias("code"), F.col("p_name").alias("name"))
    known = t.part.where(F.col("p_size").between(10, 20)).groupBy(F.col("p_brand").alias("code"), F.col("p_name").alias("name")).agg(
        F.min("p_type").alias("description"))
    return recon.translate_accounts(accounts, known, "code", "name", "description", ["code"])


@query("recon_balance_names", """
WITH a AS (SELECT c_nationkey AS unit, CASE c_mktsegment WHEN 'BUILDING' THEN 'Trade receivables' WHEN 'MACHINERY' THEN 'Trade payables' ELSE c_mktsegment END AS heading, sum(c_acctbal) AS balance FROM customer GROUP BY ALL),
b AS (SELECT s_nationkey AS unit, CASE WHEN s_acctbal > 6000 THEN 'Trade receivables' WHEN s_acctbal > 2000 THEN 'Trade payables' ELSE 'Tax' END AS heading, sum(s_acctbal * 10) AS amount FROM supplier GROUP BY ALL),
j AS (SELECT coalesce(a.unit, b.unit) AS unit, coalesce(a.heading, b.heading) AS heading, coalesce(balance, 0) AS balance, coalesce(amount, 0) AS amount FROM a FULL JOIN b USING (unit, heading))
SELECT unit, heading, round(balance, 2) AS balance, round(amount, 2) AS amount, coalesce(abs(abs(balance) - abs(amount)) / nullif(greatest(abs(balance), abs(amount)), 0) >= 0.4, false) AS differs FROM j""")
def recon_balance_names(t):
    balance = t.customer.select(F.col("c_nationkey").alias("unit"), F.col("c_mktsegment").alias("heading"), F.col("c_acctbal").alias("balance"))
    heading = F.when(F.col("s_acctbal") > 6000, "Trade receivables").when(F.col("s_acctbal") > 2000, "Trade payables").otherwise("Tax")
    ledger = t.supplier.select(F.col("s_nationkey").alias("unit"), heading.alias("heading"), (F.col("s_acctbal") * 10).alias("amount"))
    out = recon.balance_names(balance, ledger, {"BUILDING": "Trade receivables", "MACHINERY": "Trade payables"}, "unit")
    return out.withColumns({"balance": num("balance"), "amount": num("amount")})


@query("recon_mapping", """
WITH a AS (SELECT p_partkey AS account, p_brand AS purpose, p_type AS class FROM part WHERE p_size < 40),
b AS (SELECT l_partkey AS account, min(CASE WHEN l_quantity > 2 THEN 'Brand#' || l_linenumber ELSE 'Brand#9' END) AS new_purpose, max(CASE WHEN l_returnflag = 'R' THEN 'PROMO' ELSE 'ECONOMY' END) AS new_class FROM lineitem GROUP BY 1)
SELECT coalesce(a.account, b.account) AS account, purpose, class, new_purpose, new_class, coalesce(purpose = new_purpose, false) AS purpose_equal, coalesce(class = new_class, false) AS class_equal
FROM a FULL JOIN b ON a.account = b.account""")
def recon_mapping(t):
    a = t.part.where(F.col("p_size") < 40).select(F.col("p_partkey").alias("account"), F.col("p_brand").alias("purpose"), F.col("p_type").alias("class"))
    b = t.lineitem.groupBy(F.col("l_partkey").alias("account")).agg(
        F.min(F.when(F.col("l_quantity") > 2, F.concat(F.lit("Brand#"), "l_linenumber")).otherwise("Brand#9")).alias("new_purpose"),
        F.max(F.when(F.col("l_returnflag") == "R", "PROMO").otherwise("ECONOMY")).alias("new_class"))
    return agreement(a, b, ["account"], {"purpose": "new_purpose", "class": "new_class"})


# --- inventory, deals, investments ----------------------------------------------------------

INVENTORY = ctes("""
u AS (SELECT l_suppkey AS company, p_brand AS product, l_extendedprice AS amount FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand <> 'Brand#3')""", """
c AS (SELECT l_suppkey AS company, p_brand AS product, CASE WHEN l_linestatus = 'F' THEN 2 ELSE 1 END AS inserted, l_extendedprice * 1.9 AS amount FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand <> 'Brand#4')""", """
shared AS (SELECT product FROM u INTERSECT SELECT product FROM c WHERE inserted = 2)""", """
a AS (SELECT company, product, sum(amount) AS unified FROM u WHERE product IN (SELECT product FROM shared) GROUP BY ALL)""", """
b AS (SELECT company, product, sum(amount) AS consolidated FROM c WHERE inserted = (SELECT max(inserted) FROM c) AND product IN (SELECT product FROM shared) GROUP BY ALL)""", """
j AS (SELECT coalesce(a.company, b.company) AS company, coalesce(a.product, b.product) AS product, abs(unified) AS unified, abs(consolidated) AS consolidated FROM a FULL JOIN b ON a.company = b.company AND a.product = b.product)""")


def inventory(t):
    parts = t.part.select("p_partkey", F.col("p_brand").alias("product"))
    per_part = t.lineitem.groupBy("l_partkey", F.col("l_suppkey").alias("company"), "l_linestatus").agg(F.sum("l_extendedprice").alias("amount"))
    rows = join_keys(per_part, parts, {"l_partkey": "p_partkey"}, "inner", null_safe=False)
    unified = rows.where(F.col("product") != "Brand#3").select("company", "product", "amount")
    consolidated = rows.where(F.col("product") != "Brand#4").select(
        "company", "product", F.when(F.col("l_linestatus") == "F", 2).otherwise(1).alias("inserted"), (F.col("amount") * 1.9).alias("amount"))
    return recon.inventory(unified, consolidated)


@query("recon_inventory", INVENTORY + """, f AS (SELECT company, product, coalesce(unified, 0) AS unified, coalesce(consolidated, 0) AS consolidated FROM j)
SELECT company, product, round(unified, 2) AS unified, round(consolidated, 3) AS consolidated,
  CASE WHEN consolidated = 0 THEN true ELSE unified / nullif(consolidated, 0) < 0.7 OR unified / nullif(consolidated, 0) > 1.3 END AS huge_diff FROM f WHERE NOT (unified = 0 AND consolidated = 0)""")
def recon_inventory(t):
    return inventory(t)["compared"].withColumns({"unified": num("unified"), "consolidated": num("consolidated", 3)})


@query("recon_inventory_statistics", INVENTORY + """, q AS (SELECT quantile_cont(unified, 0.25) AS u1, quantile_cont(unified, 0.75) AS u3, quantile_cont(consolidated, 0.25) AS c1, quantile_cont(consolidated, 0.75) AS c3 FROM j),
clean AS (SELECT unified, consolidated FROM j, q WHERE unified BETWEEN u1 - 1.5 * (u3 - u1) AND u3 + 1.5 * (u3 - u1) AND consolidated BETWEEN c1 - 1.5 * (c3 - c1) AND c3 + 1.5 * (c3 - c1)),
long AS (SELECT 'unified' AS "column", unified AS v FROM clean UNION ALL SELECT 'consolidated', consolidated FROM clean)
SELECT "column", count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, round(min(v), 6) AS min, round(max(v), 6) AS max,
  round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50, round(quantile_cont(v, 0.75), 6) AS q75 FROM long GROUP BY 1""")
def recon_inventory_statistics(t):
    return inventory(t)["statistics"].withColumns({c: num(c, 6) for c in ("mean", "std", "min", "max", "q25", "q50", "q75")})


@query("recon_deals", """
WITH d AS (SELECT * FROM (SELECT o_custkey, o_orderkey, o_orderdate FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW'))
  QUALIFY o_orderdate = max(o_orderdate) OVER (PARTITION BY o_custkey)),
a AS (SELECT DISTINCT o_custkey FROM d), b AS (SELECT DISTINCT c_custkey FROM customer WHERE c_acctbal > -500)
SELECT coalesce(o_custkey, c_custkey) AS deal_id, CASE WHEN o_custkey IS NULL THEN 'right_only' ELSE 'left_only' END AS side FROM a FULL JOIN b ON o_custkey = c_custkey
WHERE o_custkey IS NULL OR c_custkey IS NULL""")
def recon_deals(t):
    deals = t.orders.select(F.col("o_custkey").alias("deal_id"), F.col("o_orderdate").alias("inserted"), "o_orderstatus", "o_orderpriority")
    excluded = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    unified = t.customer.where(F.col("c_acctbal") > -500).select(F.col("c_custkey").alias("deal_id"))
    return recon.deal_ids(deals, unified, "deal_id", "inserted", excluded)


VOLUMES = ctes("""
s AS (SELECT p_brand AS product, -sum(l_quantity) AS sales FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R' GROUP BY 1)""", """
b AS (SELECT p_brand AS product, sum(l_quantity) AS purchases FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'A' GROUP BY 1)""", """
p AS (SELECT p_brand AS product, max(p_retailprice) AS price FROM part WHERE p_brand <> 'Brand#9' GROUP BY 1)""", """
j AS (SELECT product, price, sales, purchases, price * sales AS amount_sales, price * purchases AS amount_purchases FROM p FULL JOIN s USING (product) FULL JOIN b USING (product))""")


@query("recon_deal_volumes", VOLUMES + """
SELECT CASE WHEN grouping(product) = 1 THEN 'Total' ELSE product END AS product, round(coalesce(sum(price), 0), 2) AS price, coalesce(sum(sales), 0) AS sales, coalesce(sum(purchases), 0) AS purchases,
  round(coalesce(sum(amount_sales), 0), 2) AS amount_sales, round(coalesce(sum(amount_purchases), 0), 2) AS amount_purchases, CAST(grouping(product) AS INTEGER) AS level FROM j GROUP BY ROLLUP (product)""")
def recon_deal_volumes(t):
    sold = t.lineitem.where(F.col("l_returnflag").isin("R", "A")).groupBy("l_partkey", "l_returnflag").agg(F.sum("l_quantity").alias("quantity"))
    branded = join_keys(sold, t.part.select("p_partkey", F.col("p_brand").alias("product")), {"l_partkey": "p_partkey"}, "inner", null_safe=False)
    sales = branded.where(F.col("l_returnflag") == "R").groupBy("product").agg((-F.sum("quantity")).alias("sales"))
    purchases = branded.where(F.col("l_returnflag") == "A").groupBy("product").agg(F.sum("quantity").alias("purchases"))
    prices = t.part.where(F.col("p_brand") != "Brand#9").groupBy(F.col("p_brand").alias("product")).agg(F.max("p_retailprice").alias("price"))
    return recon.deal_volumes(sales, purchases, prices, "product").withColumns({c: num(c) for c in ("price", "amount_sales", "amount_purchases")})


INVEST = ctes("""
a AS (SELECT l_suppkey AS company, l_linenumber AS plant, nullif(l_returnflag, 'N') AS sector, l_extendedprice AS amount FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01' AND NOT (l_linenumber = 7 AND l_returnflag = 'A'))""", """
b AS (SELECT l_suppkey AS company, l_linenumber AS plant, nullif(l_returnflag, 'N') AS sector, l_extendedprice AS amount FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01' OR l_linenumber = 1)""")


def invest_tables(t):
    rows = t.lineitem.select(F.col("l_suppkey").alias("company"), F.col("l_linenumber").alias("plant"), F.nullif("l_returnflag", F.lit("N")).alias("sector"),
                             F.col("l_extendedprice").alias("amount"), "l_shipdate", "l_returnflag")
    early = F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    cols = ["company", "plant", "sector", "amount"]
    first = rows.where(early & ~((F.col("plant") == 7) & (F.col("l_returnflag") == "A"))).select(*cols)
    return recon.investments(first, rows.where(early | (F.col("plant") == 1)).select(*cols), cols[:3], cols[:3])


@query("recon_investments", INVEST + """
, x AS (SELECT company, plant, sector, sum(amount) AS v FROM a GROUP BY ALL), y AS (SELECT company, plant, sector, sum(amount) AS v FROM b GROUP BY ALL),
j AS (SELECT coalesce(x.company, y.company) AS company, coalesce(x.plant, y.plant) AS plant, coalesce(x.sector, y.sector) AS sector, coalesce(x.v, 0) AS p, coalesce(y.v, 0) AS q
  FROM x FULL JOIN y ON x.company = y.company AND x.plant = y.plant AND x.sector IS NOT DISTINCT FROM y.sector)
SELECT company, plant, sector, round(p, 2) AS amount_first, round(q, 2) AS amount_second, coalesce(abs(p - q) / greatest(p, q) >= 0.4, false) AS differs FROM j""")
def recon_investments(t):
    return invest_tables(t)["amounts"].withColumns({"amount_first": num("amount_first"), "amount_second": num("amount_second")})


@query("recon_investments_added", INVEST + """
, g AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.company = b.company AND a.plant = b.plant AND a.sector IS NOT DISTINCT FROM b.sector))
SELECT 'company' AS "column", count(company) AS n_rows, count(DISTINCT company) AS n_unique FROM g UNION ALL SELECT 'plant', count(plant), count(DISTINCT plant) FROM g
UNION ALL SELECT 'sector', count(sector), count(DISTINCT sector) FROM g""")
def recon_investments_added(t):
    return invest_tables(t)["added_profile"]


@query("recon_investments_unified", """
WITH a AS (SELECT l_orderkey AS element, l_linenumber AS cost, l_linestatus AS holding, CAST(l_suppkey AS VARCHAR) AS segment, abs(sum(CAST(l_extendedprice AS DECIMAL(18, 2))))::DOUBLE AS amount_own
  FROM lineitem GROUP BY ALL),
b AS (SELECT l_orderkey AS element, l_linenumber AS cost, CASE WHEN o_orderstatus = 'P' THEN 'P' ELSE l_linestatus END AS unified_holding,
  CASE WHEN l_tax > 0.06 THEN 'External' ELSE CAST(l_suppkey AS VARCHAR) END AS unified_segment,
  abs(sum(CAST(CASE WHEN l_returnflag = 'A' THEN -l_extendedprice WHEN l_discount > 0.08 THEN 0 ELSE l_extendedprice END AS DECIMAL(18, 2))))::DOUBLE AS amount_unified
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority <> '5-LOW' GROUP BY ALL)
SELECT element, cost, holding, segment, amount_own, unified_holding, unified_segment, amount_unified, coalesce(holding = unified_holding, false) AS holding_equal,
  coalesce(segment = unified_segment, false) AS segment_equal, coalesce(amount_own = amount_unified, false) AS amount_equal FROM a FULL JOIN b USING (element, cost)""")
def recon_investments_unified(t):
    own = t.lineitem.select(F.col("l_orderkey").alias("element"), F.col("l_linenumber").alias("cost"), F.col("l_linestatus").alias("holding"),
                            text("l_suppkey").alias("segment"), F.col("l_extendedprice").alias("amount"))
    lines = join_keys(t.lineitem, t.orders.where(F.col("o_orderpriority") != "5-LOW").select("o_orderkey", "o_orderstatus"), {"l_orderkey": "o_orderkey"},
                      "inner", null_safe=False)
    booked = F.when(F.col("l_returnflag") == "A", -F.col("l_extendedprice")).when(F.col("l_discount") > 0.08, 0.0).otherwise(F.col("l_extendedprice"))
    unified = lines.select(
        F.col("l_orderkey").alias("element"), F.col("l_linenumber").alias("cost"),
        F.when(F.col("o_orderstatus") == "P", "P").otherwise(F.col("l_linestatus")).alias("unified_holding"),
        F.when(F.col("l_tax") > 0.06, "External").otherwise(text("l_suppkey")).alias("unified_segment"), booked.alias("amount"))
    return recon.investments_unified(own, unified, ["element", "cost"], {"holding": "unified_holding", "segment": "unified_segment"})


@query("recon_ledger_account_map", """
WITH k AS (SELECT DISTINCT p_brand AS account, p_type AS code FROM part JOIN (SELECT DISTINCT p_brand AS account FROM part WHERE p_retailprice > 950) a ON a.account = p_brand
  WHERE p_size > 10)
SELECT p_partkey, p_name AS line, code, k.account FROM part JOIN k ON code = p_type""")
def recon_ledger_account_map(t):
    mapping = t.part.where(F.col("p_size") > 10).select(F.col("p_brand").alias("account"), F.col("p_type").alias("code")).distinct()
    accounts = t.part.where(F.col("p_retailprice") > 950).select(F.col("p_brand").alias("account")).distinct()
    ledger = t.part.select("p_partkey", F.col("p_name").alias("line"), F.col("p_type").alias("code"))
    return recon.ledger_account_map(ledger, mapping, accounts, "account", "code").select("p_partkey", "line", "code", "account")


# --- internal market and rates --------------------------------------------------------------

INTERNAL = ctes(*ENTITY, f"""
s AS (SELECT 'Z' || s_nationkey AS seller, 'Z' || c_nationkey AS buyer, l_returnflag AS currency, l_quantity AS quantity, l_extendedprice AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey
  WHERE l_linestatus = 'F' AND c_mktsegment <> 'HOUSEHOLD' AND date_trunc('year', l_shipdate) = (SELECT max(date_trunc('year', l_shipdate)) FROM lineitem))""", """
p AS (SELECT seller, buyer, currency, sum(quantity) AS quantity, round(sum(value), 2) AS value FROM s GROUP BY ALL)""")


def internal_orders(t):
    rows = join_keys(lines_with_customer(t), t.supplier.select("s_suppkey", "s_nationkey", "s_acctbal"), {"l_suppkey": "s_suppkey"}, "inner", null_safe=False)
    orders = rows.select(
        F.trunc(F.to_date("l_shipdate"), "year").alias("slice"), F.concat(F.lit("Z"), "s_nationkey").alias("seller_id"),
        F.when(F.col("s_acctbal") > 0, supplier_name()).alias("seller_name"), customer_name("o_custkey").alias("customer_name"),
        F.col("l_returnflag").alias("currency"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("value"),
        F.when(F.col("l_linestatus") == "F", "not_completed").otherwise("completed").alias("order_status"))
    return latest_snapshot(orders, "slice")


@query("recon_internal_sales", INTERNAL + """
SELECT x.seller, x.buyer, x.currency, x.quantity, x.value, y.quantity AS quantity_mirror, y.value AS value_mirror, coalesce(x.value = y.value, false) AS equal
FROM p x LEFT JOIN p y ON x.seller = y.buyer AND x.buyer = y.seller AND x.currency = y.currency""")
def recon_internal_sales(t):
    claims = recon.internal_sales(internal_orders(t), entities(t))["counterclaims"]
    return claims.withColumns({"value": num("value"), "value_mirror": num("value_mirror")}).withColumn(
        "equal", F.coalesce(F.col("value") == F.col("value_mirror"), F.lit(False)))


@query("recon_internal_sales_gaps", f"""
SELECT DISTINCT 'Z' || s_nationkey AS seller_id, CASE WHEN s_acctbal > 0 THEN {SUPPLIER_NAME} END AS seller_name
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey
WHERE l_linestatus = 'F' AND s_acctbal <= 0 AND date_trunc('year', l_shipdate) = (SELECT max(date_trunc('year', l_shipdate)) FROM lineitem)""")
def recon_internal_sales_gaps(t):
    return recon.internal_sales(internal_orders(t), entities(t))["gaps"]


RATES = ctes("""
x AS (SELECT l_suppkey AS unit, CASE WHEN l_returnflag = 'R' THEN 'BRL' ELSE 'USD' END AS currency, CASE WHEN l_tax > 0.03 THEN 1.0::DOUBLE ELSE 1 + l_tax * 100 END AS rate, l_extendedprice AS amount,
  l_extendedprice / CASE WHEN l_tax > 0.03 THEN 1.0 ELSE 1 + l_tax * 100 END AS amount_usd, l_extendedprice * (1 - l_discount) AS local_amount, l_quantity FROM lineitem)""")


def rate_tables(t):
    rate = F.when(F.col("l_tax") > 0.03, F.lit(1.0)).otherwise(1 + F.col("l_tax") * 100)
    x = t.lineitem.select(
        F.col("l_suppkey").alias("unit"), F.when(F.col("l_returnflag") == "R", "BRL").otherwise("USD").alias("currency"), rate.alias("rate"),
        F.col("l_extendedprice").alias("amount"), (F.col("l_extendedprice") / rate).alias("amount_usd"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("local_amount"), "l_quantity")
    return recon.rate_audit(x, ["unit"], ["amount", "local_amount", "l_quantity", "rate"])


@query("recon_rates", RATES + """
SELECT unit, rate = 1 AS rate_is_one, round(sum(amount), 2) AS amount, round(sum(amount_usd), 6) AS amount_usd, count(*) AS lines FROM x WHERE currency = 'USD' GROUP BY ALL""")
def recon_rates(t):
    return rate_tables(t)["sums"].withColumns({"amount": num("amount"), "amount_usd": num("amount_usd", 6)})


@query("recon_rates_far", RATES + """
SELECT unit, rate, amount, round(amount_usd, 6) AS amount_usd FROM x WHERE currency = 'USD' AND rate <> 1 AND (abs(amount / amount_usd) > 2 OR abs(amount_usd / amount) > 2) AND amount > 1""")
def recon_rates_far(t):
    return rate_tables(t)["far"].select(
        "unit", "rate", "amount", num("amount_usd", 6).alias("amount_usd"))


@query("recon_rates_corr", RATES + """
SELECT * FROM (SELECT 'amount' AS col_a, 'local_amount' AS col_b, round(corr(amount, local_amount), 6) AS corr FROM x WHERE currency <> 'USD'
UNION ALL SELECT 'local_amount', 'amount', round(corr(amount, local_amount), 6) FROM x WHERE currency <> 'USD')""")
def recon_rates_corr(t):
    return rate_tables(t)["corr"].withColumn("corr", num("corr", 6))
