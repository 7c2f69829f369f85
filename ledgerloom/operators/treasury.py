"""Bond netting, two-leg positions, limits and effective-dated parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_col, case_when, sum0
from ledgerloom.functions.measures import differs
from ledgerloom.operators.joins import join_keys


def net_bonds(
    df: DataFrame, set_keys: list[str], role: str, issued: str, traded: str, entity: list[str],
    counterparty: str, amounts: list[str], carry: list[str] | None = None,
) -> DataFrame:
    """Net issued against traded bonds per deal set.

    All issued rows of a set become one row holding issued + traded; traded rows name the
    issuer (first column of `entity`) as counterparty. A set whose issued rows are missing,
    or belong to more than one issuer and counterparty, is left out. `carry` columns come
    from the smallest issued row. Returns set keys, role, entity, counterparty, amounts, carry.
    """
    carry = carry or []
    who = F.struct(*entity, counterparty)
    is_issued, is_traded = F.col(role) == issued, F.col(role) == traded
    carried = [F.min(F.when(is_issued, F.struct(*carry))).alias("__carry")] if carry else []
    sets = df.groupBy(*set_keys).agg(
        F.min(F.when(is_issued, who)).alias("__who"), F.max(F.when(is_issued, who)).alias("__who_max"),
        *[F.coalesce(F.sum(F.when(is_issued | is_traded, F.col(a))), F.lit(0.0)).alias(f"__net_{a}") for a in amounts],
        *carried,
    ).where(F.col("__who").isNotNull() & F.col("__who").eqNullSafe(F.col("__who_max"))).drop("__who_max")
    issued_rows = sets.select(
        *set_keys, F.lit(issued).alias(role), *[F.col("__who")[e].alias(e) for e in entity],
        F.col("__who")[counterparty].alias(counterparty), *[F.col(f"__net_{a}").alias(a) for a in amounts],
        *[F.col("__carry")[c].alias(c) for c in carry],
    )
    valid = sets.select(*set_keys, F.col("__who")[entity[0]].cast("string").alias("__issuer"))
    traded_rows = join_keys(df.where(is_traded), valid, set_keys, "inner").select(
        *set_keys, role, *entity, F.col("__issuer").alias(counterparty), *amounts, *carry)
    return issued_rows.unionByName(traded_rows)


def legs(df: DataFrame, keep: list[str], pay_ccy: str, pay: str, rec_ccy: str, rec: str) -> DataFrame:
    """Two rows per deal: the pay leg negative, the receive leg positive."""
    both = F.explode(F.array(
        F.struct(F.lit("pay").alias("leg"), F.col(pay_ccy).alias("currency"), (-F.col(pay)).alias("amount")),
        F.struct(F.lit("receive").alias("leg"), F.col(rec_ccy).alias("currency"), F.col(rec).alias("amount")),
    ))
    return df.select(*keep, both.alias("leg")).select(*keep, "leg.*")


def effective_params(df: DataFrame, params: DataFrame, key: str, date: str | Column, values: list[str]) -> DataFrame:
    """Parameters valid on the row's date; `params` has (key, valid_from, valid_to, values).

    An equality join on the key with a date range; periods of one key must not overlap.
    """
    day = as_col(date)
    slim = params.select(F.col(key).alias("__pk"), "valid_from", "valid_to", *values)
    within = (day >= F.col("valid_from")) & (F.col("valid_to").isNull() | (day < F.col("valid_to")))
    return join_keys(df, slim, {key: "__pk"}, "left", null_safe=False, extra=within).drop("valid_from", "valid_to")


def minimum_of_versions(
    df: DataFrame, keys: list[str], holding: str, version: str, value: str, pairs: dict[str, tuple[str, str]],
) -> DataFrame:
    """Lower of two plan versions per holding; a missing version counts as 0, zeros are dropped.

    `pairs` gives the two versions compared for each holding.
    """
    names = sorted({v for p in pairs.values() for v in p})
    wide = df.groupBy(*keys, holding).pivot(version, names).agg(F.sum(value)).na.fill(0.0, subset=names)
    lower = case_when(
        [(F.col(holding) == h, F.least(a, b)) for h, (a, b) in pairs.items()], F.lit(None).cast("double"))
    return wide.withColumn("amount", lower).where(F.col("amount") != 0)


def impaired(df: DataFrame, balance: str, impairment: str) -> Column:
    """Balance after impairment, a missing rate counting as 0."""
    return F.col(balance) * (1 - F.coalesce(F.col(impairment), F.lit(0.0)))


def control_totals(df: DataFrame, stated: DataFrame, keys: list[str], value: str, stated_value: str,
                   tolerance: float = 0.01) -> DataFrame:
    """Sums of selected rows beside the stated totals with a within-tolerance flag."""
    sums = df.groupBy(*keys).agg(sum0(value).alias("actual"))
    return join_keys(stated, sums, keys, "inner").withColumn(
        "ok", ~differs(stated_value, "actual", tolerance))
