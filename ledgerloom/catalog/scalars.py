"""Scalar functions over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import num, query, text
from ledgerloom.functions.measures import safe_ratio, week_label
from ledgerloom.functions.text import (
    clean_list, concat_key, cut_suffix, extract, keyword_tag, name_value, remap, split_part, to_integer, to_number,
)


@query("str_slice", """
SELECT p_partkey, substr(p_brand, 1, 3) AS head, substr(p_brand, 7) AS tail, regexp_replace(p_name, ' (ring|bolt)$', '') AS base
FROM part""")
def str_slice(t):
    return t.part.select("p_partkey", F.substring("p_brand", 1, 3).alias("head"), F.substr("p_brand", F.lit(7)).alias("tail"),
                         cut_suffix("p_name", " (ring|bolt)").alias("base"))


@query("str_split_pick", """
SELECT p_partkey, split_part(p_name, ' ', 1) AS first, split_part(p_name, ' ', -1) AS last,
  nullif(split_part(p_brand, '#', 3), '') AS third FROM part""")
def str_split_pick(t):
    return t.part.select("p_partkey", split_part("p_name", " ", 1).alias("first"), split_part("p_name", " ", -1).alias("last"),
                         split_part("p_brand", "#", 3).alias("third"))


@query("regex_extract", r"""
SELECT doc_id, nullif(regexp_extract(text, '([0-9]{2}\.[0-9]{2}\.[0-9]{4})', 1), '') AS day_text,
  nullif(regexp_extract(text, '([0-9]{4,})', 1), '') AS number, nullif(regexp_extract(text, '^([A-Z][a-z]*) ', 1), '') AS first_word,
  nullif(regexp_extract(text, '([a-z0-9.]+@[a-z0-9.]+)', 1), '') AS address FROM documents""")
def regex_extract(t):
    return t.documents.select(
        "doc_id", extract("text", r"([0-9]{2}\.[0-9]{2}\.[0-9]{4})").alias("day_text"),
        extract("text", r"([0-9]{4,})").alias("number"), extract("text", r"^([A-Z][a-z]*) ").alias("first_word"),
        extract("text", r"([a-z0-9.]+@[a-z0-9.]+)").alias("address"))


@query("concat_key", """
SELECT c_custkey, concat_ws('_', coalesce(nullif(c_mktsegment, 'BUILDING'), 'nan'), CAST(c_nationkey AS VARCHAR), c_name) AS key
FROM customer""")
def concat_key_(t):
    return t.customer.withColumn("market", F.nullif("c_mktsegment", F.lit("BUILDING"))).select(
        "c_custkey", concat_key(["market", "c_nationkey", "c_name"]).alias("key"))


@query("str_normalise", """
SELECT doc_id, upper(trim(lang)) AS lang, lower(source) AS source, contains(lower(source), '1') AS has_one,
  length(trim(text)) AS size FROM documents""")
def str_normalise(t):
    return t.documents.select("doc_id", F.upper(F.trim("lang")).alias("lang"), F.lower("source").alias("source"),
                              F.lower("source").contains("1").alias("has_one"), F.length(F.trim("text")).cast("bigint").alias("size"))


@query("value_remap", """
SELECT event_id, CASE event_type WHEN 'signup' THEN 'active' WHEN 'purchase' THEN 'mmarket' ELSE event_type END AS status FROM events""")
def value_remap(t):
    return t.events.select("event_id", remap("event_type", {"signup": "active", "purchase": "mmarket"}).alias("status"))


@query("keyword_tag", """
SELECT p_partkey, p_name, CASE WHEN contains(p_name, 'widget') THEN 'Widget' WHEN contains(p_name, 'ring') THEN 'RING'
  WHEN contains(p_name, 'red') THEN 'Red' END AS tag FROM part""")
def keyword_tag_(t):
    return t.part.select("p_partkey", "p_name", keyword_tag("p_name", ["Red", "RING", "Widget"]).alias("tag"))


@query("list_clean", """
WITH x AS (SELECT c_nationkey, 'nan, ' || c_name || ' ,, nan,' || c_mktsegment AS raw, c_name, c_mktsegment FROM customer)
SELECT c_nationkey, raw, c_name || ',' || c_mktsegment AS cleaned FROM x""")
def list_clean(t):
    raw = F.concat(F.lit("nan, "), "c_name", F.lit(" ,, nan,"), "c_mktsegment")
    return t.customer.select("c_nationkey", raw.alias("raw")).withColumn("cleaned", clean_list("raw"))


@query("line_parse", r"""
WITH lines AS (SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS line FROM documents),
n AS (SELECT doc_id, nullif(regexp_extract(line, '^(.*) (\S+)$', 1), '') AS name,
  nullif(regexp_extract(line, '^(.*) (\S+)$', 2), '') AS value FROM lines)
SELECT doc_id, count(*) AS n_lines, count(name) AS named, count(DISTINCT value) AS n_values,
  coalesce(sum(length(name)), 0)::BIGINT AS name_size, count(*) FILTER (regexp_matches(value, '^-?\d+(\.\d+)?$')) AS numeric_values FROM n GROUP BY 1""")
def line_parse(t):
    lines = t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    name, value = name_value("line")
    parsed = lines.select("doc_id", name.alias("name"), value.alias("value"))
    return parsed.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count("name").alias("named"), F.count_distinct("value").alias("n_values"),
        F.coalesce(F.sum(F.length("name")), F.lit(0)).cast("bigint").alias("name_size"),
        F.count(F.when(F.col("value").rlike(r"^-?\d+(\.\d+)?$"), to_number("value"))).alias("numeric_values"))


@query("safe_cast", """
SELECT doc_id, try_cast(substr(source, 4) AS BIGINT) AS number, try_cast(source AS DOUBLE) AS nothing,
  CAST(try_cast('1998-0' || substr(source, 4) || '-01' AS DATE) AS VARCHAR) AS month_day FROM documents""")
def safe_cast(t):
    code = F.substr("source", F.lit(4))
    return t.documents.select(
        "doc_id", to_integer(code).alias("number"), to_number("source").alias("nothing"),
        text(F.concat(F.lit("1998-0"), code, F.lit("-01")).try_cast("date")).alias("month_day"))


@query("date_parts", """
WITH x AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, CAST(d AS VARCHAR) AS day, CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS month_start,
  CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(isodow(d) - 1 AS INTEGER) AS weekday,
  CAST(weekofyear(d) AS INTEGER) AS week, weekofyear(d) || '.' || year(d) AS week_num, weekofyear(d) || '.' || isoyear(d) AS iso_week_num,
  CAST(CAST(strptime(strftime(d, '%m.%Y'), '%m.%Y') AS DATE) AS VARCHAR) AS parsed_month FROM x""")
def date_parts(t):
    d = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", text(d).alias("day"), text(F.trunc(d, "month")).alias("month_start"), F.year(d).alias("year"),
        F.month(d).alias("month"), F.weekday(d).alias("weekday"), F.weekofyear(d).alias("week"),
        week_label(d).alias("week_num"), week_label(d, iso_year=True).alias("iso_week_num"),
        text(F.to_date(F.date_format(d, "MM.yyyy"), "MM.yyyy")).alias("parsed_month"))


@query("null_defaults", """
WITH x AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS market, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS credit FROM customer)
SELECT c_custkey, coalesce(market, 'Empty') AS market, coalesce(credit, 0) AS credit, coalesce(CAST(credit AS VARCHAR), '_') <> '_' AS known FROM x""")
def null_defaults(t):
    x = t.customer.select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("market"),
                          F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("credit"))
    return x.select("c_custkey", "market", "credit", (F.coalesce(text("credit"), F.lit("_")) != "_").alias("known")).na.fill(
        "Empty", subset=["market"]).na.fill(0.0, subset=["credit"])


@query("coalesce_chain", """
WITH x AS (SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN c_name ELSE 'External' END AS a, nullif(c_mktsegment, 'FURNITURE') AS b,
  CAST(c_nationkey AS VARCHAR) AS c FROM customer)
SELECT c_custkey, coalesce(nullif(a, 'External'), b, c, 'External') AS code FROM x""")
def coalesce_chain(t):
    a = F.when(F.col("c_acctbal") > 5000, F.col("c_name")).otherwise("External")
    return t.customer.select("c_custkey", F.coalesce(
        F.nullif(a, F.lit("External")), F.nullif("c_mktsegment", F.lit("FURNITURE")), F.col("c_nationkey").cast("string"),
        F.lit("External")).alias("code"))


@query("safe_ratio", """
SELECT l_orderkey, l_linenumber, round(coalesce(l_extendedprice / nullif(l_tax * 100, 0), 0), 6) AS ratio,
  CAST(sign(l_extendedprice - 50000) AS DOUBLE) AS side, round(round_even(l_extendedprice / 1000, 1), 1) AS thousands,
  CAST(trunc(l_extendedprice) AS BIGINT) / 1e6 AS millions FROM lineitem""")
def safe_ratio_(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", num(safe_ratio("l_extendedprice", F.col("l_tax") * 100), 6).alias("ratio"),
        F.signum(F.col("l_extendedprice") - 50000).alias("side"), F.bround(F.col("l_extendedprice") / 1000, 1).alias("thousands"),
        (F.col("l_extendedprice").cast("bigint") / F.lit(1e6)).alias("millions"))


@query("money_columns", """
SELECT l_orderkey, l_linenumber, round(l_quantity * l_extendedprice, 2) AS money, -l_extendedprice AS outflow FROM lineitem""")
def money_columns(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", num(F.col("l_quantity") * F.col("l_extendedprice")).alias("money"),
                             (-F.col("l_extendedprice")).alias("outflow"))
