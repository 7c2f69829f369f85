"""Classification and selection by rule tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.columns import all_of, any_of, as_col, case_when
from ledgerloom.operators.joins import join_keys
from ledgerloom.session import staged
from ledgerloom.sources.tables import literal_table


@dataclass(frozen=True)
class Rule:
    """One line of a classification table; an empty set does not restrict."""

    purpose: str
    sources: tuple[str, ...] = ()
    report_type: str | None = None
    codes: tuple[str, ...] = ()
    accounts: tuple[str, ...] = ()
    prefixes: tuple[str, ...] = field(default=())

    def condition(self, source: Column, report_type: Column, code: Column, account: Column) -> Column:
        parts = []
        if self.sources:
            parts.append(source.isin(*self.sources))
        if self.report_type is not None:
            parts.append(report_type == self.report_type)
        if self.codes:
            parts.append(code.isin(*self.codes))
        if self.accounts or self.prefixes:
            hits = ([account.isin(*self.accounts)] if self.accounts else []) + [
                account.startswith(p) for p in self.prefixes]
            parts.append(any_of(hits))
        return all_of(parts) if parts else F.lit(True)


def classify(
    rules: list[Rule], source: str, report_type: str, code: str, account: str, otherwise: str | None = None,
) -> Column:
    """Purpose by the first rule that applies, as one CASE expression: no join, no shuffle.

    Meant for rule lists kept in configuration; for rule tables of any size use
    `classify_by_table`.
    """
    cols = [as_col(c) for c in (source, report_type, code, account)]
    return case_when([(rule.condition(*cols), F.lit(rule.purpose)) for rule in rules], F.lit(otherwise))


def classify_by_prefix(account: str | Column, prefixes: dict[str, list[str]], otherwise: str | None = None) -> Column:
    """Label by account prefix, the first label with a matching prefix wins."""
    a = as_col(account)
    branches = [(any_of(a.startswith(p) for p in starts), F.lit(label)) for label, starts in prefixes.items()]
    return case_when(branches, F.lit(otherwise))


def classify_by_table(
    df: DataFrame, rules: DataFrame, keys: list[str], account: str, out: str = "purpose",
) -> DataFrame:
    """Purpose by the matching rule of lowest priority, for rule tables of any size.

    `rules` has the key columns plus (priority, purpose, account, prefix). A null key does not
    restrict; a line has an exact account, or a prefix of any length, or neither. The kinds of
    lines (which keys are given, and the prefix length) are read from the rule table; each
    distinct combination of keys and account is looked up once per kind in one index of all
    lines. The rows then join the classified combinations, whose written size Spark knows.
    """
    given = [F.col(k).isNotNull() for k in keys]
    reach = F.when(F.col("account").isNotNull(), -1).otherwise(F.coalesce(F.length("prefix"), F.lit(0)))
    kind = F.array(*[g.cast("int") for g in given], reach)
    index = rules.select("priority", "purpose", kind.alias("__kind"), F.array(*[
        F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.coalesce("account", "prefix", F.lit(""))).alias("__line"))
    index = index.groupBy("__kind", "__line").agg(
        F.min("priority").alias("__priority"), F.min_by("purpose", "priority").alias("__purpose"))
    kinds = [list(r["__kind"]) for r in index.select("__kind").distinct().collect()]

    def line(flags: list[int]) -> Column:
        *used, n = flags
        parts = [F.col(k).cast("string") if u else F.lit("") for k, u in zip(keys, used)]
        parts.append(F.lit("") if n == 0 else F.col(account) if n < 0 else F.substring(account, 1, n))
        known = all_of([p.isNotNull() for p in parts])
        return F.when(known, F.struct(F.array(*map(F.lit, flags)).alias("kind"), F.array(*parts).alias("line")))

    combos = df.select(*keys, account).distinct()
    if not kinds:
        return df.withColumn(out, F.lit(None).cast("string"))
    asked = combos.select(*keys, account, F.explode(F.array_compact(F.array(*[line(k) for k in kinds]))).alias("__ask"))
    hits = asked.join(index, (F.col("__ask.kind") == F.col("__kind")) & (F.col("__ask.line") == F.col("__line")))
    found = staged(hits.groupBy(*keys, account).agg(F.min_by("__purpose", "__priority").alias(out)), "purposes")
    return join_keys(df.drop(out), found, [*keys, account], "left")


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """Rule list as rows (priority, purpose, source, report_type, code, account, prefix), null meaning any."""
    rows = []
    for priority, rule in enumerate(rules, 1):
        matches = [(a, None) for a in rule.accounts] + [(None, p) for p in rule.prefixes] or [(None, None)]
        rows += [(priority, rule.purpose, source, rule.report_type, code, *match) for source in rule.sources or (None,)
                 for code in rule.codes or (None,) for match in matches]
    return literal_table(spark, rows, "priority int, purpose string, source string, report_type string, code string, account string, prefix string")


def drop_excluded(rules: DataFrame, excluded: DataFrame, keys: list[str]) -> DataFrame:
    """Included rule lines without the lines that are excluded explicitly."""
    return join_keys(rules, excluded.select(*keys).distinct(), keys, "left_anti")


def rule_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rule lines present in only one version, labelled 'only_old' or 'only_new'."""
    tagged = old.select(*keys, F.lit(1).alias("__o"), F.lit(0).alias("__n")).unionByName(
        new.select(*keys, F.lit(0).alias("__o"), F.lit(1).alias("__n")))
    seen = tagged.groupBy(*keys).agg(F.max("__o").alias("__o"), F.max("__n").alias("__n"))
    return seen.where(F.col("__o") != F.col("__n")).select(
        *keys, F.when(F.col("__o") == 1, "only_old").otherwise("only_new").alias("side"))


def rule_overlaps(rules: DataFrame, keys: list[str]) -> DataFrame:
    """Lines claimed by more than one purpose."""
    return rules.groupBy(*keys).agg(
        F.count_distinct("purpose").alias("n_purposes"), F.min("priority").alias("first_priority"),
    ).where(F.col("n_purposes") > 1)


def condition_filter(df: DataFrame, conditions: list[dict[str, str]]) -> DataFrame:
    """Rows that satisfy a conjunction of column = value, once per matching condition.

    `condition_id` counts from 0. Conditions come from configuration; they become one
    array of matching ids per row and no join.
    """
    ids = F.array_compact(F.array(*[
        F.when(all_of(F.col(c) == v for c, v in cond.items()), F.lit(i)) for i, cond in enumerate(conditions)
    ]))
    hit = any_of(all_of(F.col(c) == v for c, v in cond.items()) for cond in conditions)
    return df.where(hit).withColumn("condition_id", F.explode(ids))


def mapping_gaps(df: DataFrame, checks: dict[str, tuple[Column, list[str]]]) -> DataFrame:
    """Distinct rows that need manual mapping, per named check.

    Each check gives a condition and the columns to list (as `key`, `code`, `segment`).
    """
    parts = [
        df.where(condition).select(
            F.lit(name).alias("check"),
            *[F.col(c).cast("string").alias(a) for c, a in zip(cols, ("key", "code", "segment"))],
        ).distinct()
        for name, (condition, cols) in checks.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

