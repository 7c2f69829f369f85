"""Reconciliations of two or three copies of the same positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import any_false, any_null, sum0
from ledgerloom.functions.measures import differs, outside_band, ratio_above
from ledgerloom.functions.text import remap
from ledgerloom.operators.dimensions import EXTERNAL, alternative_key_join, two_pass_lookup
from ledgerloom.operators.grouping import correlations, describe, latest_version, subtotals, without_outliers
from ledgerloom.operators.joins import join_keys
from ledgerloom.operators.quality import count_differences
from ledgerloom.operators.reconcile import (
    agreement, coverage, difference_profile, drop_mirrored, mirror_pairs, reconcile,
)
from ledgerloom.operators.rules import condition_filter
from ledgerloom.plans.entities import Entities
from ledgerloom.session import staged

ROWS_A_TASK = 1_000_000  # of both sides, near one group each

def arap(position: DataFrame, unified: DataFrame) -> dict[str, DataFrame]:
    """Own position against the unified one: segments, companies, currencies, coverage.

    Both: (holding, segment, currency, purpose, company, party, amount).
    """
    a = position.where(F.col("amount") != 0).withColumnRenamed("amount", "amount_own")
    b = unified.where(F.col("amount") != 0).withColumnRenamed("amount", "amount_unified")
    b = b.withColumn("party", F.coalesce("party", F.lit(EXTERNAL)))
    keys = ["holding", "segment", "currency", "purpose"]
    detail = [*keys, "company", "party"]
    return {
        "segments": reconcile(a, b, keys, "amount_own", "amount_unified", 0.25),
        "companies": reconcile(a, b, detail, "amount_own", "amount_unified").where("differs"),
        "currencies": count_differences(a, b, "currency"),
        "coverage": coverage(a, b, ["holding", "company"]).where(F.col("side") != "both"),
        "segment_map": agreement(
            a.select("company", "segment").distinct(), b.select("company", F.col("segment").alias("segment_unified")).distinct(),
            ["company"], {"segment": "segment_unified"}).where(~F.col("segment_equal")),
    }


def treasury_amounts(debt: DataFrame, unified: DataFrame, keys: list[str], entity: str, party: str, tolerance: float = 0.4) -> DataFrame:
    """Treasury debt against the unified position, in cents.

    Unified-only rows whose opposite side is booked too (parties swapped, same keys and
    magnitude) are dropped. A ratio of exactly 2 is no difference. A missing own amount counts
    as 0; a deal missing from the unified side has no amount there and is not flagged.
    """
    def cents(c: str) -> Column:
        return F.coalesce(F.sum(F.col(c).cast("decimal(18,2)")), F.lit(0).cast("decimal(18,2)"))

    a = debt.groupBy(*keys, entity, party).agg(cents("amount").alias("amount"), F.lit(True).alias("__own"))
    b = unified.groupBy(*keys, entity, party).agg(cents("amount").alias("amount_unified"))
    both = join_keys(a, b, [*keys, entity, party], "full")
    both = staged(both.withColumns({"size": F.abs("amount_unified"), "only_unified": F.col("__own").isNull()}), "treasury")
    kept = drop_mirrored(both, entity, party, [*keys, "size"], "only_unified").drop("size", "__own")
    doubled = F.coalesce(F.col("amount_unified") == 2 * F.col("amount"), F.lit(False))
    kept = kept.withColumns({"amount": F.coalesce(F.col("amount").cast("double"), F.lit(0.0)), "__doubled": doubled,
                             "amount_unified": F.col("amount_unified").cast("double")})
    differ = F.coalesce(differs("amount", "amount_unified", tolerance), F.lit(False))
    flag = F.col("amount_unified").isNotNull() & differ & ~F.col("__doubled")
    return kept.withColumn("differs", flag).drop("__doubled")


def treasury_derivatives(legs: DataFrame, unified: DataFrame, debt_deals: DataFrame, keys: list[str], deal: str,
                         tolerance: float = 0.4) -> DataFrame:
    """Derivative legs against the unified position, whole on both sides.

    Both: (keys with the deal number among them, amount). `in_debt` tells deals that treasury
    debt reports as well; a leg differs beyond the tolerance or if one side has no amount. Both sides
    are summed in one pass over the rows of a deal, dealt to as many tasks as there are rows for.
    """
    cents, none = F.col("amount").cast("decimal(18,2)"), F.lit(None).cast("decimal(18,2)")
    rows = legs.select(*keys, cents.alias("own"), none.alias("other")).unionByName(
        unified.select(*keys, none.alias("own"), cents.alias("other")))
    dealt = rows.repartition(max(1, -(-2 * legs.count() // ROWS_A_TASK)), deal)
    sums = dealt.groupBy(*keys).agg(F.sum("own").cast("double").alias("amount"), F.sum("other").cast("double").alias("amount_unified"))
    debt = debt_deals.select(deal).distinct().withColumn("__debt", F.lit(True))
    both = join_keys(sums, debt, [deal], "left", null_safe=False)
    missing = F.col("amount").isNull() | F.col("amount_unified").isNull()
    return both.withColumns({
        "in_debt": F.coalesce("__debt", F.lit(False)),
        "differs": missing | F.coalesce(differs("amount", "amount_unified", tolerance), F.lit(False)),
    }).drop("__debt")


def treasury_mapping(debt: DataFrame, unified: DataFrame, keys: list[str], attributes: dict[str, str]) -> DataFrame:
    """Deals whose holding, segment or code is not the same in both systems."""
    both = agreement(debt.distinct(), unified.distinct(), keys, attributes)
    return both.where(any_false([f"{a}_equal" for a in attributes]))


def order_books(first: DataFrame, second: DataFrame, third: DataFrame, keys: list[str], tolerance: float = 0.4) -> DataFrame:
    """Quantities and prices of three order books side by side with pairwise flags."""
    def book(df: DataFrame, n: int) -> DataFrame:
        return df.dropDuplicates().groupBy(*keys).agg(
            F.sum("quantity").alias(f"quantity_{n}"), F.avg("price").alias(f"price_{n}"))

    both = join_keys(book(second, 2), book(first, 1), keys, "full")
    three = join_keys(both, book(third, 3), keys, "full")
    return three.withColumns({
        f"differs_{a}_{b}": differs(f"quantity_{a}", f"quantity_{b}", tolerance) for a, b in ((2, 1), (2, 3), (1, 3))})


def missing_orders(compared: DataFrame, history: DataFrame, keys: list[str], order: str, day: str) -> DataFrame:
    """Orders absent from the third book, with their latest older version where there is one."""
    absent = staged(compared.where(F.col("quantity_3").isNull() & F.col("quantity_2").isNotNull()).select(*keys, "quantity_2"), "absent")
    older = join_keys(history, absent.select(order).distinct(), [order], "left_semi")
    older = latest_version(older, [order], day).groupBy(*keys, day).agg(
        F.sum("quantity").alias("quantity_old"), F.avg("price").alias("price_old"))
    return join_keys(absent, older, keys, "left")


def ledger_cover(accounts: DataFrame, ledger: DataFrame, company: dict[str, str], alternatives: list[str], group: list[str]) -> DataFrame:
    """Account list joined to ledger sums by each alternative key in turn."""
    sums = ledger.groupBy(*group).agg(sum0("amount").alias("amount"))
    sums = sums.withColumnsRenamed({c: f"ledger_{c}" for c in sums.columns if c != "amount"})
    return alternative_key_join(accounts, sums, {
        key: {a: f"ledger_{l}" for a, l in company.items()} | {key: f"ledger_{key}"} for key in alternatives})


def stated_conditions(rows: DataFrame, conditions: list[dict[str, str]], stated: DataFrame, value: str, tolerance: float = 0.01) -> DataFrame:
    """Sums of the rows behind each stated condition beside the stated sums (condition_id, stated)."""
    actual = condition_filter(rows, conditions).groupBy("condition_id").agg(sum0(value).alias("actual"))
    both = join_keys(stated, actual, ["condition_id"], "left").na.fill(0.0, subset=["actual"])
    return both.withColumn("ok", ~differs("stated", "actual", tolerance))


def translate_accounts(accounts: DataFrame, descriptions: DataFrame, code: str, name: str, value: str, order: list[str]) -> DataFrame:
    """Account descriptions by code and name, then by name alone; level 0 needs translation."""
    return two_pass_lookup(accounts, descriptions, [code, name], [name], value, order, "translation")


def balance_names(balance: DataFrame, ledger: DataFrame, mapping: dict[str, str], key: str) -> DataFrame:
    """Balance sheet sums against ledger sums per renamed heading and company."""
    a = balance.withColumn("heading", remap("heading", mapping))
    return reconcile(a, ledger, [key, "heading"], "balance", "amount")


def inventory(unified: DataFrame, consolidated: DataFrame, low: float = 0.7, high: float = 1.3) -> dict[str, DataFrame]:
    """Inventory per company and product group, outside-band flags and clean statistics.

    unified(company, product, amount); consolidated(company, product, inserted, amount).
    Only product groups known to both are compared.
    """
    newest = consolidated.agg(F.max("inserted")).scalar()
    latest = consolidated.where(F.col("inserted") == newest)
    shared = unified.select("product").intersect(latest.select("product"))
    a = join_keys(unified, shared, ["product"], "left_semi").groupBy("company", "product").agg(sum0("amount").alias("unified"))
    b = join_keys(latest, shared, ["product"], "left_semi").groupBy("company", "product").agg(sum0("amount").alias("consolidated"))
    both = join_keys(a, b, ["company", "product"], "full")
    both = staged(both.withColumns({"unified": F.abs("unified"), "consolidated": F.abs("consolidated")}), "inventory")
    filled = both.na.fill(0.0, subset=["unified", "consolidated"])
    flagged = filled.withColumn("huge_diff", outside_band("unified", "consolidated", low, high)).where(F.col("huge_diff").isNotNull())
    clean = without_outliers(both, ["unified", "consolidated"])
    return {"compared": flagged, "statistics": describe(clean, ["unified", "consolidated"])}


def deal_ids(deals: DataFrame, unified: DataFrame, key: str, version: str, excluded: Column) -> DataFrame:
    """Deals of the latest version, exclusions left out, present on one side only."""
    kept = latest_version(deals.where(~excluded), [key], version)
    return coverage(kept, unified, [key]).where(F.col("side") != "both")


def deal_volumes(sales: DataFrame, purchases: DataFrame, prices: DataFrame, product: str) -> DataFrame:
    """Quantities of both sides valued at one price per product, with a total line."""
    both = join_keys(join_keys(prices, sales, [product], "full"), purchases, [product], "full")
    valued = both.withColumns({
        "amount_sales": F.col("price") * F.col("sales"), "amount_purchases": F.col("price") * F.col("purchases"),
        product: F.col(product).cast("string")})
    return subtotals(valued, [product], ["price", "sales", "purchases", "amount_sales", "amount_purchases"])


def investments(first: DataFrame, second: DataFrame, keys: list[str], profile_cols: list[str]) -> dict[str, DataFrame]:
    """Two loads of an investment table: amounts per key, and what the additional rows have in common."""
    amounts = reconcile(first.withColumnRenamed("amount", "amount_first"), second.withColumnRenamed("amount", "amount_second"),
                        keys, "amount_first", "amount_second")
    added = join_keys(second.where(F.col("amount") > 1), first.select(*keys).distinct(), keys, "left_anti")
    return {"amounts": amounts, "differing": amounts.where("differs"), "added_profile": difference_profile(added, profile_cols)}


def investments_unified(own: DataFrame, unified: DataFrame, keys: list[str], attributes: dict[str, str]) -> DataFrame:
    """A manual or scripted investment table against the unified one, line by line.

    Amounts are compared as magnitudes in cents. `attributes` maps own columns to unified ones;
    each gets a flag that is false where a side is missing, and so has the amount.
    """
    def side(df: DataFrame, names: list[str], out: str) -> DataFrame:
        cents = F.sum(F.col("amount").cast("decimal(18,2)"))
        return df.groupBy(*keys, *names).agg(F.abs(cents).cast("double").alias(out))

    both = agreement(side(own, list(attributes), "amount_own"), side(unified, list(attributes.values()), "amount_unified"),
                     keys, {**attributes, "amount_own": "amount_unified"})
    return both.withColumnRenamed("amount_own_equal", "amount_equal")


def ledger_account_map(ledger: DataFrame, mapping: DataFrame, accounts: DataFrame, account: str, code: str) -> DataFrame:
    """Ledger lines with the account they map to: mapping and account list meet on the account,
    their distinct lines meet the ledger on the code. Only lines known to all three stay.
    """
    known = join_keys(mapping, accounts, [account], "inner", null_safe=False).distinct()
    return join_keys(ledger, known, [code], "inner", null_safe=False)


def internal_sales(orders: DataFrame, entities: Entities) -> dict[str, DataFrame]:
    """Open internal-market orders: counterclaims of each pair, units to map, rows with gaps.

    orders(seller_id, seller_name, customer_name, currency, quantity, value, order_status) of
    the latest slice.
    """
    rows = orders.where(F.col("order_status") == "not_completed")
    rows = entities.by_code(rows, "seller_id", segment="seller_segment")
    rows = entities.by_name(rows, "customer_name", code="party_id")
    known = rows.where(F.col("party_id") != EXTERNAL)
    pairs = known.groupBy(F.col("seller_id").alias("seller"), F.col("party_id").alias("buyer"), "currency").agg(
        F.sum("quantity").alias("quantity"), F.sum("value").alias("value"))
    claims = mirror_pairs(pairs, "seller", "buyer", ["currency"], ["quantity", "value"]).withColumn(
        "equal", F.coalesce(F.col("value") == F.col("value_mirror"), F.lit(False)))
    return {
        "counterclaims": claims,
        "manual_map": rows.where(F.col("seller_segment") == EXTERNAL).select("seller_id", "seller_name").distinct(),
        "gaps": rows.where(any_null(["seller_name", "customer_name", "currency"])).select("seller_id", "seller_name").distinct(),
    }


def rate_audit(ledger: DataFrame, keys: list[str], figures: list[str], k: float = 2.0) -> dict[str, DataFrame]:
    """USD lines by whether their rate is 1, lines whose amounts are far apart, figure correlations.

    ledger(currency, rate, amount, amount_usd, keys, figures).
    """
    usd = ledger.where(F.col("currency") == "USD").withColumn("rate_is_one", F.coalesce(F.col("rate") == 1, F.lit(False)))
    sums = usd.groupBy(*keys, "rate_is_one").agg(
        sum0("amount").alias("amount"), sum0("amount_usd").alias("amount_usd"), F.count(F.lit(1)).alias("lines"))
    far = usd.where(~F.col("rate_is_one") & ratio_above("amount", "amount_usd", k) & (F.col("amount") > 1))
    strong = (F.abs("corr") > 0.87) & (F.abs("corr") < 1)
    return {"sums": sums, "far": far, "corr": correlations(ledger.where(F.col("currency") != "USD"), figures).where(strong)}
