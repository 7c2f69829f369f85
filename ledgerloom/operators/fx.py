"""Currency codes, rate tables and conversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_col
from ledgerloom.functions.text import remap
from ledgerloom.operators.joins import join_keys
from ledgerloom.session import staged

# Technical currency codes of the source systems and their ISO codes.
TECHNICAL_CODES = {
    "RUC": "CHF", "RUE": "EUR", "RUE2": "EUR", "RUE3": "EUR", "RUE5": "EUR", "RUG": "GBP",
    "RUJ": "JPY", "RUK": "KZT", "RUM": "MDL", "RUU": "USD", "RUU1": "USD", "RUU1R": "USD",
    "RUU2": "USD", "RUU25": "USD", "RUU26": "USD", "RUU3": "USD", "RUU5": "USD", "RUY": "CNY",
    "RUK5": "KZT", "RUY3": "CNY", "RUY5": "CNY", "RUI": "INR",
}


def iso_code(c: str | Column) -> Column:
    """ISO code of a technical currency code; other codes pass through."""
    return remap(c, TECHNICAL_CODES)


def split_pair(pair: str | Column) -> tuple[Column, Column]:
    """Both codes of a pair written 'AAA/BBB'."""
    p = as_col(pair)
    return F.substring(p, 1, 3), F.substring(p, 5, 3)


def rates_to(quotes: DataFrame, target: str) -> DataFrame:
    """One coefficient per day and currency into `target`.

    `quotes` has (period, ccy_from, ccy_to, rate). A pair quoted both ways uses the inverse of
    the quote that starts from the target; repeated quotes use the lowest.
    """
    direct = F.col("ccy_to") == target
    usable = quotes.where(direct | (F.col("ccy_from") == target)).where(F.col("ccy_from") != F.col("ccy_to"))
    return usable.groupBy(
        F.col("period").alias("rate_day"),
        F.when(direct, F.col("ccy_from")).otherwise(F.col("ccy_to")).alias("rate_ccy"),
    ).agg(
        F.coalesce(
            F.try_divide(F.lit(1.0), F.min(F.when(~direct, F.col("rate")))),
            F.min(F.when(direct, F.col("rate"))),
        ).alias("coef")
    )


def convert(
    df: DataFrame, quotes: DataFrame, target: str, ccy: str, amount: str, day: str | Column,
) -> DataFrame:
    """Adds `coef_to_X` and `<amount>_in_X`; both are null where the day has no quote.

    `day` is a date column, or a constant date column for one as-of day. The currency column
    comes out as ISO code. The rates, a row per day and currency, are written once, so their
    real size decides how the rows join them.
    """
    day_col = as_col(day)
    source = df.withColumns({ccy: iso_code(ccy), "__day": day_col.cast("date")})
    joined = join_keys(source, staged(rates_to(quotes, target), "rates"), {"__day": "rate_day", ccy: "rate_ccy"},
                       "left", null_safe=False)
    coef = F.when(F.col(ccy) == target, F.lit(1.0)).otherwise(F.col("coef"))
    return joined.withColumns({
        f"coef_to_{target}": coef, f"{amount}_in_{target}": F.col(amount) * coef,
    }).drop("coef", "__day")


def unwrap_virtual(df: DataFrame, currencies: DataFrame, ccy: str, amount: str) -> DataFrame:
    """Virtual currency amounts in their base currency: (code, base, multiplier) lookup.

    `currencies` holds one row per code.
    """
    dim = currencies.select(F.col("code").alias("__code"), F.col("base").alias("__base"),
                            F.col("multiplier").alias("__mult"))
    joined = join_keys(df, dim, {ccy: "__code"}, "left", null_safe=False)
    return joined.withColumns({
        "base_ccy": F.coalesce("__base", ccy),
        f"{amount}_base": F.col(amount) * F.coalesce("__mult", F.lit(1.0)),
    }).drop("__base", "__mult")
