"""Lookups, reconciling joins, spines and lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.inputs import BALANCES, COMPANIES, LEDGER, PARTIES, balances, companies, ctes, ledger, parties
from ledgerloom.catalog.registry import num, query, text
from ledgerloom.functions.columns import sum0
from ledgerloom.functions.measures import differs
from ledgerloom.operators.dimensions import (
    alternative_key_join, fill_missing, lookup, lookup_ignore_case, lookup_multikey, lookup_name, two_pass_lookup,
)
from ledgerloom.operators.grouping import collect_chunks
from ledgerloom.operators.joins import join_keys
from ledgerloom.operators.quality import last_seen
from ledgerloom.sources.tables import newest_days, within_day
from ledgerloom.operators.reconcile import mirror_pairs, ordered_pairs, reconcile, reporting_grid, version_pairs
from ledgerloom.session import staged

CODES = """coded AS (SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN CAST(l_suppkey AS VARCHAR)
  WHEN 'A' THEN 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0')
  ELSE 'Z' || l_quantity::BIGINT END AS code FROM lineitem)"""


def coded_lines(t):
    code = (F.when(F.col("l_returnflag") == "R", F.col("l_suppkey").cast("string"))
            .when(F.col("l_returnflag") == "A", F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")))
            .otherwise(F.concat(F.lit("Z"), F.col("l_quantity").cast("bigint").cast("string"))))
    return t.lineitem.select("l_orderkey", "l_linenumber", code.alias("code"))


MULTIKEY = """long AS (SELECT id AS k, 1 AS p, segment, unit_key FROM companies
  UNION ALL SELECT short_code, 2, segment, unit_key FROM companies
  UNION ALL SELECT plant_code, 3, segment, unit_key FROM companies),
firsts AS (SELECT * FROM long WHERE k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k, p ORDER BY unit_key) = 1),
best AS (SELECT k, segment FROM firsts WHERE segment IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY p DESC) = 1)"""


@query("entity_lookup_multikey", ctes(CODES, COMPANIES, MULTIKEY) + """
SELECT l_orderkey, l_linenumber, code, coalesce(segment, 'External') AS segment
FROM coded LEFT JOIN best ON code = k""")
def entity_lookup_multikey(t):
    return lookup_multikey(coded_lines(t), "code", companies(t), ["id", "short_code", "plant_code"], "segment",
                           ["unit_key"], "segment")


@query("entity_lookup_name", ctes(COMPANIES) + """
SELECT o_orderkey, coalesce(id, 'External') AS company_code FROM orders
LEFT JOIN companies ON short_code = 'Supplier#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')""")
def entity_lookup_name(t):
    named = t.orders.select("o_orderkey", F.concat(
        F.lit("Supplier#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("company_name"))
    return lookup_name(named, "company_name", companies(t), "short_code", "id", ["unit_key"], "company_code").drop(
        "company_name")


@query("lookup_left", """
SELECT o_orderkey, o_custkey, c_mktsegment, CAST(c_nationkey AS VARCHAR) AS nation FROM orders
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""")
def lookup_left(t):
    return lookup(t.orders.select("o_orderkey", "o_custkey"), t.customer.where(F.col("c_acctbal") > 0),
                  {"o_custkey": "c_custkey"}, {"c_mktsegment": "c_mktsegment", "c_nationkey": "nation"}, ["c_name"]).withColumn(
        "nation", text("nation"))


@query("lookup_compound", """
WITH rates AS (SELECT l_suppkey, l_returnflag, avg(l_discount) AS rate FROM lineitem GROUP BY ALL HAVING max(l_quantity) >= 50)
SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag, round(coalesce(rate, 0), 6) AS rate
FROM lineitem LEFT JOIN rates USING (l_suppkey, l_returnflag)""")
def lookup_compound(t):
    rates = t.derived("discount_rates", lambda: t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(
        F.avg("l_discount").alias("rate"), F.max("l_quantity").alias("most")).where("most >= 50").drop("most"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag")
    keys = {"l_suppkey": "l_suppkey", "l_returnflag": "l_returnflag"}
    return lookup(lines, rates, keys, ["rate"], ["rate"], 0.0).withColumn("rate", num("rate", 6))


@query("inner_join", """
SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'""")
def inner_join(t):
    building = t.customer.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")
    return join_keys(t.orders, building, {"o_custkey": "c_custkey"}, "inner", null_safe=False).select(
        "o_orderkey", "c_name", "o_totalprice")


@query("outer_reconcile", """
WITH a AS (SELECT l_orderkey AS doc, nullif(l_returnflag, 'N') AS flag, sum(l_extendedprice) AS amount FROM lineitem GROUP BY ALL),
b AS (SELECT o_orderkey AS doc, nullif(CASE o_orderstatus WHEN 'F' THEN 'R' WHEN 'O' THEN 'A' ELSE 'N' END, 'N') AS flag,
  sum(o_totalprice) AS volume FROM orders GROUP BY ALL),
j AS (SELECT coalesce(a.doc, b.doc) AS doc, CASE WHEN a.doc IS NOT NULL THEN a.flag ELSE b.flag END AS flag,
  coalesce(amount, 0) AS amount, coalesce(volume, 0) AS volume
  FROM a FULL JOIN b ON a.doc = b.doc AND a.flag IS NOT DISTINCT FROM b.flag)
SELECT doc, flag, round(amount, 2) AS amount, round(volume, 2) AS volume,
  coalesce(abs(abs(amount) - abs(volume)) / nullif(greatest(abs(amount), abs(volume)), 0) >= 0.25, false) AS differs FROM j""")
def outer_reconcile(t):
    a = t.lineitem.select(F.col("l_orderkey").alias("doc"), F.nullif("l_returnflag", F.lit("N")).alias("flag"),
                          F.col("l_extendedprice").alias("amount"))
    flag = F.when(F.col("o_orderstatus") == "F", "R").when(F.col("o_orderstatus") == "O", "A").otherwise("N")
    b = t.orders.select(F.col("o_orderkey").alias("doc"), F.nullif(flag, F.lit("N")).alias("flag"),
                        F.col("o_totalprice").alias("volume"))
    return reconcile(a, b, ["doc", "flag"], "amount", "volume", 0.25).withColumns(
        {"amount": num("amount"), "volume": num("volume")})


@query("version_pairs", ctes(BALANCES) + """
SELECT account, CAST(report_day AS VARCHAR) AS report_day_new,
  CAST(lag(report_day) OVER (PARTITION BY account ORDER BY report_day) AS VARCHAR) AS report_day_old
FROM (SELECT DISTINCT account, report_day FROM balances) QUALIFY report_day_old IS NOT NULL""")
def version_pairs_(t):
    return version_pairs(balances(t), ["account"], "report_day").withColumns(
        {c: text(c) for c in ("report_day_new", "report_day_old")})


@query("version_pairs_all", ctes(BALANCES) + """, v AS (SELECT DISTINCT account, report_day FROM balances)
SELECT a.account, CAST(a.report_day AS VARCHAR) AS report_day_old, CAST(b.report_day AS VARCHAR) AS report_day_new
FROM v a JOIN v b ON a.account = b.account AND a.report_day < b.report_day AND b.report_day - a.report_day <= 7""")
def version_pairs_all(t):
    """All ordered pairs of an account's days that are at most a week apart."""
    return ordered_pairs(balances(t), ["account"], "report_day", 7).withColumns(
        {c: text(c) for c in ("report_day_new", "report_day_old")})


FLOWS = """flows AS (SELECT s.n_name AS seller, b.n_name AS buyer, l_returnflag AS ccy, sum(l_extendedprice) AS value,
  sum(l_quantity) AS quantity
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation s ON s_nationkey = s.n_nationkey
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation b ON c_nationkey = b.n_nationkey
  GROUP BY ALL)"""


def flows(t):
    """Sales between nations, one row per seller, buyer and currency.

    Orders get the nation of their customer and lines that of their supplier first, so lines are shuffled once,
    by their order, and what is left after that join is summed per pair of nations before the next shuffle.
    """
    homes = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("seller_no"))
    owners = staged(t.customer.select("c_custkey", F.col("c_nationkey").alias("buyer_no")), "owners")  # read with its real size
    sold = join_keys(t.lineitem.select("l_orderkey", "l_suppkey", "l_returnflag", "l_extendedprice", "l_quantity"), homes,
                     {"l_suppkey": "s_suppkey"}, "inner", null_safe=False)
    bought = join_keys(t.orders.select("o_orderkey", "o_custkey"), owners, {"o_custkey": "c_custkey"}, "inner", null_safe=False)
    both = join_keys(sold.drop("l_suppkey"), bought.drop("o_custkey"), {"l_orderkey": "o_orderkey"}, "inner", null_safe=False)
    per_pair = both.groupBy("seller_no", "buyer_no", "l_returnflag").agg(
        F.sum("l_extendedprice").alias("value"), F.sum("l_quantity").alias("quantity"))
    named = per_pair
    for side in ("seller", "buyer"):
        names = t.nation.select(F.col("n_nationkey").alias(f"{side}_key"), F.col("n_name").alias(side))
        named = join_keys(named, names, {f"{side}_no": f"{side}_key"}, "inner", null_safe=False)
    return named.groupBy("seller", "buyer", F.col("l_returnflag").alias("ccy")).agg(
        F.sum("value").alias("value"), F.sum("quantity").alias("quantity"))


@query("mirror_pairs", ctes(FLOWS) + """
SELECT x.seller, x.buyer, x.ccy, round(x.value, 2) AS value, round(y.value, 2) AS value_mirror,
  round(x.quantity, 2) AS quantity, round(y.quantity, 2) AS quantity_mirror,
  coalesce(round(x.value, 2) = round(y.value, 2), false) AS amount_is_equal
FROM flows x LEFT JOIN flows y ON x.seller = y.buyer AND x.buyer = y.seller AND x.ccy = y.ccy""")
def mirror_pairs_(t):
    rounded = flows(t).withColumns({"value": num("value"), "quantity": num("quantity")})
    return mirror_pairs(rounded, "seller", "buyer", ["ccy"], ["value", "quantity"]).withColumn(
        "amount_is_equal", F.coalesce(F.col("value") == F.col("value_mirror"), F.lit(False)))


GRID = """grid AS (SELECT a.holding, a.segment AS row_label, b.segment AS col_label
  FROM (SELECT DISTINCT holding, segment FROM companies WHERE segment IS NOT NULL) a
  JOIN (SELECT DISTINCT holding, segment FROM companies WHERE segment IS NOT NULL) b USING (holding))"""


@query("spine_cross", ctes(COMPANIES, GRID) + "SELECT * FROM grid")
def spine_cross(t):
    return reporting_grid(companies(t), "holding", "segment")


@query("spine_fill", ctes(COMPANIES, PARTIES, LEDGER, GRID, """
pos AS (SELECT holding, segment AS row_label, party_segment AS col_label, sum(amount) AS amount
  FROM ledger JOIN companies ON company = unit_key JOIN orders ON document = o_orderkey JOIN parties ON o_custkey = party
  WHERE report_type = 'AR' GROUP BY ALL)""") + """
SELECT g.holding, g.row_label, g.col_label, round(coalesce(amount, 0), 2) AS amount
FROM grid g LEFT JOIN pos USING (holding, row_label, col_label)""")
def spine_fill(t):
    lines = ledger(t).where(F.col("report_type") == "AR")
    lines = join_keys(lines, companies(t).select("unit_key", "holding", "segment"), {"company": "unit_key"}, "inner", null_safe=False)
    lines = join_keys(lines, t.orders.select("o_orderkey", "o_custkey"), {"document": "o_orderkey"}, "inner", null_safe=False)
    lines = join_keys(lines, parties(t).select("party", "party_segment"), {"o_custkey": "party"}, "inner", null_safe=False)
    position = lines.groupBy("holding", F.col("segment").alias("row_label"), F.col("party_segment").alias("col_label")).agg(
        F.sum("amount").alias("amount"))
    grid = reporting_grid(companies(t), "holding", "segment")
    return join_keys(grid, position, ["holding", "row_label", "col_label"], "left").withColumn(
        "amount", num(F.coalesce("amount", F.lit(0.0))))


DAYS = """d AS (SELECT max(report_day) AS last_day FROM balances),
p AS (SELECT max(report_day) AS prev_day FROM balances WHERE report_day < (SELECT last_day FROM d))"""


@query("anti_missing", ctes(BALANCES, DAYS) + """
SELECT account, status, balance FROM balances b WHERE report_day = (SELECT prev_day FROM p)
  AND NOT EXISTS (SELECT 1 FROM balances n WHERE n.report_day = (SELECT last_day FROM d)
    AND n.account = b.account AND n.status = b.status)""")
def anti_missing(t):
    b = balances(t)
    newest, previous = newest_days(b, "ts", 2)
    now = b.where(within_day("ts", newest)).select("account", "status").distinct()
    return join_keys(b.where(within_day("ts", previous)), now, ["account", "status"], "left_anti").select(
        "account", "status", "balance")


@query("anti_new", ctes(BALANCES, DAYS) + """
SELECT account, status, balance FROM balances b WHERE report_day = (SELECT last_day FROM d)
  AND NOT EXISTS (SELECT 1 FROM balances n WHERE n.report_day = (SELECT prev_day FROM p)
    AND n.account = b.account AND n.status = b.status)""")
def anti_new(t):
    b = balances(t)
    newest, previous = newest_days(b, "ts", 2)
    before = b.where(within_day("ts", previous)).select("account", "status").distinct()
    return join_keys(b.where(within_day("ts", newest)), before, ["account", "status"], "left_anti").select(
        "account", "status", "balance")


@query("semi_flag", """
SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 400000) AS in_debt
FROM customer""")
def semi_flag(t):
    debtors = t.orders.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000)).select(
        F.col("o_custkey").alias("debtor")).distinct()
    return t.customer.join(debtors, F.col("c_custkey") == F.col("debtor"), "left").select(
        "c_custkey", F.col("debtor").isNotNull().alias("in_debt"))


@query("semi_join", """
SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity = 50 AND l_discount > 0.09)""")
def semi_join(t):
    big = t.lineitem.where((F.col("l_quantity") == 50) & (F.col("l_discount") > 0.09)).select("l_suppkey")
    return t.supplier.join(big, F.col("s_suppkey") == F.col("l_suppkey"), "left_semi").select("s_suppkey", "s_name")


DESCRIPTIONS = """descriptions AS (SELECT p_name, p_brand, min(p_type) AS description FROM part WHERE p_size > 45 GROUP BY ALL)"""


@query("two_pass_lookup", ctes(DESCRIPTIONS, """
short AS (SELECT p_name, description FROM descriptions QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_brand) = 1)""") + """
SELECT p_partkey, part.p_name, part.p_brand, coalesce(d.description, s.description) AS description,
  CASE WHEN d.description IS NOT NULL THEN 1 WHEN s.description IS NOT NULL THEN 2 ELSE 0 END AS match_level
FROM part LEFT JOIN descriptions d ON part.p_name = d.p_name AND part.p_brand = d.p_brand
LEFT JOIN short s ON part.p_name = s.p_name""")
def two_pass(t):
    dim = t.part.where(F.col("p_size") > 45).groupBy("p_name", "p_brand").agg(F.min("p_type").alias("description"))
    return two_pass_lookup(t.part.select("p_partkey", "p_name", "p_brand"), dim, ["p_name", "p_brand"], ["p_name"],
                           "description", ["p_brand"], "description")


@query("alt_key_join", """
WITH m AS (SELECT s_suppkey AS code_a, s_suppkey * 10 AS code_b, s_name AS description FROM supplier WHERE s_acctbal < 1000)
SELECT c_custkey, c_nationkey, description, 'key' AS merge_on FROM customer JOIN m ON c_custkey = code_a
UNION ALL SELECT c_custkey, c_nationkey, description, 'alternative' FROM customer JOIN m ON c_custkey = code_b""")
def alt_key_join(t):
    ledger_side = t.supplier.where(F.col("s_acctbal") < 1000).select(
        F.col("s_suppkey").alias("code_a"), (F.col("s_suppkey") * 10).alias("code_b"), F.col("s_name").alias("description"))
    return alternative_key_join(t.customer.select("c_custkey", "c_nationkey"), ledger_side, {
        "key": {"c_custkey": "code_a"}, "alternative": {"c_custkey": "code_b"},
    }).select("c_custkey", "c_nationkey", "description", "merge_on")


@query("last_seen", ctes(BALANCES, DAYS, """
fresh AS (SELECT DISTINCT account, status FROM balances b WHERE report_day = (SELECT last_day FROM d)
  AND NOT EXISTS (SELECT 1 FROM balances n WHERE n.report_day = (SELECT prev_day FROM p)
    AND n.account = b.account AND n.status = b.status)),
seen AS (SELECT account, status, max(report_day) AS day FROM balances
  WHERE report_day < (SELECT last_day FROM d) AND report_day >= (SELECT last_day FROM d) - INTERVAL 3 MONTH GROUP BY ALL)""") + """
SELECT account, status, coalesce(CAST(day AS VARCHAR), 'never') AS last_seen FROM fresh LEFT JOIN seen USING (account, status)""")
def last_seen_(t):
    b = balances(t)
    newest, previous = newest_days(b, "ts", 2)
    before = b.where(within_day("ts", previous)).select("account", "status").distinct()
    fresh = join_keys(b.where(within_day("ts", newest)).select("account", "status").distinct(), before,
                      ["account", "status"], "left_anti")
    return last_seen(b, "ts", ["account", "status"], fresh, F.lit(newest))


@query("three_way_reconcile", """
WITH a AS (SELECT l_orderkey AS k, sum(l_quantity) AS q1 FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
b AS (SELECT l_orderkey AS k, sum(l_quantity) AS q2 FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1),
c AS (SELECT o_orderkey AS k, sum(o_totalprice / 10000) AS q3 FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
ab AS (SELECT coalesce(a.k, b.k) AS k, q1, q2 FROM a FULL JOIN b ON a.k = b.k),
j AS (SELECT coalesce(ab.k, c.k) AS k, q1, q2, q3 FROM ab FULL JOIN c ON ab.k = c.k)
SELECT k AS order_id, q1, q2, round(q3, 6) AS q3,
  coalesce(abs(q1 - q2) / greatest(q1, q2) >= 0.4, false) AS diff_1_2,
  coalesce(abs(q2 - q3) / greatest(q2, q3) >= 0.4, false) AS diff_2_3,
  coalesce(abs(q1 - q3) / greatest(q1, q3) >= 0.4, false) AS diff_1_3 FROM j""")
def three_way(t):
    a = t.lineitem.where(F.col("l_returnflag") == "R").groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.sum("l_quantity").alias("q1"))
    b = t.lineitem.where(F.col("l_linestatus") == "F").groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.sum("l_quantity").alias("q2"))
    c = t.orders.where(F.col("o_orderstatus") != "P").groupBy(F.col("o_orderkey").alias("order_id")).agg(
        F.sum(F.col("o_totalprice") / 10000).alias("q3"))
    both = join_keys(join_keys(a, b, ["order_id"], "full"), c, ["order_id"], "full")
    return both.withColumns({
        "diff_1_2": differs("q1", "q2"), "diff_2_3": differs("q2", "q3"), "diff_1_3": differs("q1", "q3"),
    }).withColumn("q3", num("q3", 6))


@query("ci_join", """
WITH a AS (SELECT n_nationkey AS id, lower(n_name) AS name FROM nation),
b AS (SELECT DISTINCT 'Nation_' || s_nationkey AS bu_name, s_nationkey AS bu_id FROM supplier WHERE s_acctbal > 5000)
SELECT coalesce(upper(name), upper(bu_name)) AS upper_key, name, CAST(id AS VARCHAR) AS id, bu_name, CAST(bu_id AS VARCHAR) AS bu_id, coalesce(id = bu_id, false) AS same_id
FROM a FULL JOIN b ON upper(name) = upper(bu_name)""")
def ci_join(t):
    a = t.nation.select(F.col("n_nationkey").alias("id"), F.lower("n_name").alias("name"))
    b = t.supplier.where(F.col("s_acctbal") > 5000).select(
        F.concat(F.lit("Nation_"), F.col("s_nationkey")).alias("bu_name"), F.col("s_nationkey").alias("bu_id")).distinct()
    return lookup_ignore_case(a, "name", b, "bu_name").withColumn(
        "same_id", F.coalesce(F.col("id") == F.col("bu_id"), F.lit(False))).withColumns({"id": text("id"), "bu_id": text("bu_id")})


@query("fill_from_dim", """
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'FURNITURE'), n_name) AS code FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def fill_from_dim(t):
    rows = t.customer.select("c_custkey", "c_nationkey", F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("code"))
    return fill_missing(rows, "code", t.nation, {"c_nationkey": "n_nationkey"}, "n_name", ["n_nationkey"]).drop("c_nationkey")


@query("lineage_drill", """
WITH groups AS (SELECT l_suppkey, l_returnflag, sum(l_extendedprice) AS amount FROM lineitem GROUP BY ALL
  HAVING sum(l_extendedprice) > (SELECT avg(s) FROM (SELECT sum(l_extendedprice) AS s FROM lineitem GROUP BY l_suppkey, l_returnflag)))
SELECT DISTINCT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey IN
  (SELECT l_orderkey FROM lineitem JOIN groups USING (l_suppkey, l_returnflag))""")
def lineage_drill(t):
    keys = ["l_suppkey", "l_returnflag"]
    groups = t.lineitem.groupBy(*keys).agg(sum0("l_extendedprice").alias("amount"))
    selected = groups.where(F.col("amount") > groups.agg(F.avg("amount")).scalar())
    # only the members of selected groups are collected; the selection is written, so its size is known
    chosen = t.derived("selected_groups", lambda: selected.select(*keys))
    lineage = collect_chunks(join_keys(t.lineitem, chosen, keys, "left_semi"), keys, "l_orderkey", 1000)
    sources = lineage.select(F.explode("members").alias("source_id"))
    return t.orders.join(sources, F.col("o_orderkey") == F.col("source_id"), "left_semi").select(
        "o_orderkey", "o_custkey", "o_totalprice")
