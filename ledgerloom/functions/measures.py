"""Comparison and risk measures as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_col

# Upper day limits (exclusive) and labels of the maturity buckets.
MATURITY_BUCKETS = [(30, "<1M"), (91, "1M-3M"), (182, "3M-6M"), (365, "6M-1Y"), (730, "1Y-2Y")]
MATURITY_LAST = "2Y+"


def days_to(date: str | Column, day: str | Column) -> Column:
    """Days from `day` to `date`; a missing date counts as 0 days."""
    return F.coalesce(F.datediff(as_col(date), as_col(day)), F.lit(0))


def maturity_bucket(date: str | Column, day: str | Column) -> Column:
    """Maturity label; overdue and missing dates fall into the first bucket."""
    days = days_to(date, day)
    label = F.lit(MATURITY_LAST)
    for limit, name in reversed(MATURITY_BUCKETS):
        label = F.when(days < limit, F.lit(name)).otherwise(label)
    return label


def differs(a: str | Column, b: str | Column, tolerance: float = 0.4) -> Column:
    """True when the magnitudes differ by at least `tolerance` of the larger one.

    Signs are ignored. A null side gives false, as does equality (0 against 0 included).
    """
    x, y = F.abs(as_col(a)), F.abs(as_col(b))
    larger = F.greatest(x, y)
    ratio = F.try_divide(F.abs(x - y), larger)
    return F.coalesce(ratio >= tolerance, F.lit(False))


def mostly_equal(a: str | Column, b: str | Column, tolerance: float = 0.4) -> Column:
    """Signed comparison: abs(a-b) is at most `tolerance` of the larger magnitude."""
    x, y = as_col(a), as_col(b)
    ratio = F.try_divide(F.abs(x - y), F.greatest(F.abs(x), F.abs(y)))
    return (x == y) | (ratio <= tolerance)


def outside_band(a: str | Column, b: str | Column, low: float = 0.7, high: float = 1.3) -> Column:
    """abs(a)/abs(b) lies outside the band; a nonzero value over 0 is outside, 0 over 0 is null."""
    x, y = F.abs(as_col(a)), F.abs(as_col(b))
    ratio = F.try_divide(x, y)
    return F.when((y == 0) & (x == 0), F.lit(None).cast("boolean")).when(y == 0, F.lit(True)).otherwise(
        (ratio < low) | (ratio > high)
    )


def ratio_above(a: str | Column, b: str | Column, k: float) -> Column:
    """abs(a/b) or abs(b/a) is above k."""
    x, y = as_col(a), as_col(b)
    return F.coalesce(F.abs(F.try_divide(x, y)) > k, F.lit(False)) | F.coalesce(
        F.abs(F.try_divide(y, x)) > k, F.lit(False)
    )


def safe_ratio(a: str | Column, b: str | Column, scale: float = 1.0) -> Column:
    """scale*a/b, and 0 where b is 0 or either side is missing."""
    return F.coalesce(F.try_divide(as_col(a), as_col(b)) * scale, F.lit(0.0))


def signed_pct(old: str | Column, new: str | Column) -> Column:
    """Change from old to new as a share of the old magnitude, 0 when old is 0."""
    delta = as_col(new) - as_col(old)
    return F.coalesce(F.signum(delta) * F.abs(F.try_divide(delta, as_col(old))), F.lit(0.0))


def limit_breach(used: str | Column, limit: str | Column, share: float = 0.1, amount: float = 10.0) -> Column:
    """'ok', 'insignificant' or 'significant' (excess over a share of the limit or over an amount)."""
    excess = as_col(used) - as_col(limit)
    return (
        F.when(excess.isNull() | (excess <= 0), F.lit("ok"))
        .when((excess > as_col(limit) * share) | (excess > amount), F.lit("significant"))
        .otherwise(F.lit("insignificant"))
    )


def deal_signs(kind: str | Column, quantity: str | Column, money: str | Column,
               purchase: str, sale: str) -> tuple[Column, Column]:
    """Purchases add quantity and cost money, sales the reverse; other deals keep their signs."""
    k, q, m = as_col(kind), as_col(quantity), as_col(money)
    signed_q = F.when(k == purchase, F.abs(q)).when(k == sale, -F.abs(q)).otherwise(q)
    signed_m = F.when(k == purchase, -F.abs(m)).when(k == sale, F.abs(m)).otherwise(m)
    return signed_q, signed_m


def second_best(ratings: dict[str, Column]) -> tuple[Column, Column]:
    """Second-highest nonzero rating of a row with its source.

    Zeros and nulls are no ratings; a single rating is returned itself. Ties are broken by
    the order in which the sources are given.
    """
    items = F.array(*[
        F.struct((-value).alias("neg"), F.lit(i).alias("pos"), F.lit(name).alias("source"))
        for i, (name, value) in enumerate(ratings.items())
    ])
    ranked = F.array_sort(F.filter(items, lambda x: x["neg"].isNotNull() & (x["neg"] != 0)))
    position = F.greatest(F.least(F.size(ranked), F.lit(2)), F.lit(1))
    chosen = F.try_element_at(ranked, position)
    return -chosen["neg"], chosen["source"]


def week_label(date: str | Column, iso_year: bool = False) -> Column:
    """ISO week number with the calendar year (or the ISO year), as 'week.year'."""
    d = as_col(date)
    year = F.extract(F.lit("YEAROFWEEK"), d) if iso_year else F.year(d)
    return F.concat_ws(".", F.weekofyear(d).cast("string"), year.cast("string"))
