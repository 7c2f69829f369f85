"""Position reports: liquidity, limits, receivables and payables, debt, deals, cash, investments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions.columns import as_col, sum0
from ledgerloom.functions.measures import (
    days_to, deal_signs, differs, limit_breach, maturity_bucket, safe_ratio,
)
from ledgerloom.functions.text import cut_suffix
from ledgerloom.operators.dimensions import EXTERNAL, lookup
from ledgerloom.operators.fx import convert, iso_code
from ledgerloom.operators.grouping import group_sum, latest_one, latest_version, subtotals
from ledgerloom.operators.joins import join_keys
from ledgerloom.operators.quality import last_seen, snapshot_changes
from ledgerloom.operators.reconcile import reporting_grid
from ledgerloom.operators.reshape import exposure_matrix, pivot_sum
from ledgerloom.operators.treasury import effective_params, impaired, legs, minimum_of_versions, net_bonds
from ledgerloom.plans.entities import Entities, first_known
from ledgerloom.session import staged
from ledgerloom.sources.tables import latest_snapshot, newest_days

RECEIVABLE = ("Trade receivables", "Other receivables", "Provisions")
PAYABLE = ("Trade payables", "Other payables")
CLAIMS = ("Trade receivables", "Trade payables", "Other receivables", "Other payables")


def _millions(c: str | Column) -> Column:
    """Millions of the whole units, the fraction cut toward zero first.

    Rounding to 4 digits before the cut keeps 99.99999999 from losing a unit.
    """
    return F.round(as_col(c), 4).cast("bigint") / F.lit(1e6)


def liquidity(
    balances: DataFrame, overdrafts: DataFrame, limits: DataFrame, debt: DataFrame, quotes: DataFrame,
    params: DataFrame, entities: Entities, local_ccy: str = "RUB", horizon_days: int = 7,
) -> DataFrame:
    """Daily liquidity per holding against its thresholds, in millions.

    balances(report_day, holding, balance) and overdrafts(report_day, holding, drawn) are
    already restricted to the accounts that count; limits(holding, limit);
    debt(report_day, company_name, party_name, partner_kind, currency, amount, term_end).
    Debt counts when it falls due within the horizon, is external and negative.
    """
    cash = group_sum(balances, ["report_day", "holding"], ["balance"]).withColumnRenamed("balance", "cash")
    drawn = group_sum(overdrafts, ["report_day", "holding"], ["drawn"])
    total = join_keys(cash, drawn, ["report_day", "holding"], "left").na.fill(0.0, subset=["drawn"])
    total = lookup(total, limits, "holding", ["limit"], ["limit"])
    total = total.withColumns({"overdraft": F.col("limit") - F.col("drawn"), "ccy": F.lit(local_ccy)})
    total = convert(total, quotes, "USD", "ccy", "overdraft", "report_day")
    total = effective_params(total, params, "holding", "report_day", ["threshold", "early_trigger"])

    due = debt.where(
        (F.datediff("term_end", "report_day") <= horizon_days) & (F.col("partner_kind") == "other") & (F.col("amount") < 0)
    ).groupBy("report_day", "company_name", "party_name", "currency").agg(F.sum("amount").alias("amount"))
    due = entities.by_name(due, "company_name", holding="company_holding")
    due = entities.by_name(due, "party_name", holding="party_holding")
    due = due.where((F.col("company_holding") == EXTERNAL) | (F.col("company_holding") != F.col("party_holding")))
    due = convert(due, quotes, "USD", "currency", "amount", "report_day")
    outflow = due.groupBy("report_day", F.col("company_holding").alias("holding")).agg(sum0("amount_in_USD").alias("outflow"))

    out = join_keys(total, outflow, ["report_day", "holding"], "left")
    available = _millions("overdraft_in_USD")
    debt_outflow = _millions(F.coalesce("outflow", F.lit(0.0)))
    return out.select(
        "report_day", "holding", _millions("cash").alias("cash"), available.alias("available_overdraft"),
        _millions(F.col("cash") + F.col("overdraft_in_USD")).alias("total"), F.weekday("report_day").alias("day_of_week"),
        debt_outflow.alias("debt_outflow"), "threshold", "early_trigger",
        (F.col("threshold") + F.abs(debt_outflow)).alias("threshold_debt"),
        (F.col("early_trigger") + F.abs(debt_outflow)).alias("early_trigger_debt"),
    )


def liquidity_qc(balances: DataFrame, day: str, keys: list[str], amount: str, limits: dict[str, float]) -> DataFrame:
    """Lost and new accounts of the last day with when they were last seen and the alert level.

    The level is CRITICAL when the amounts of that status reach their limit.
    """
    days = newest_days(balances, day, 2)
    changes = staged(snapshot_changes(balances, day, keys, amount, days), "changes")
    fresh = changes.where(F.col("status") == "new").select(*keys)
    seen = last_seen(balances, day, keys, fresh, F.lit(days[0] if days else None).cast("date"))
    totals = changes.groupBy("status").agg(F.sum("amount").alias("status_amount"))
    limit = F.coalesce(*[F.when(F.col("status") == s, F.lit(float(v))) for s, v in limits.items()])
    levels = totals.select("status", F.when(F.col("status_amount") >= limit, "CRITICAL").otherwise("ALERT").alias("level"))
    return join_keys(join_keys(changes, seen, keys, "left"), levels, ["status"], "left")


def bank_limits(
    balances: DataFrame, limits: DataFrame, banks: DataFrame, entities: Entities,
    active_statuses: tuple[str, ...] = ("active", "mmarket"), day: str = "report_day",
    parts: dict[str, list[str]] | None = None, wanted: tuple[str, ...] | None = None,
) -> dict[str, DataFrame]:
    """Use of bank limits on the last day, in millions: by bank, country and segment, banks by
    segment with country totals in report order, and by bank within `parts`, named groups of segments.

    Only the `wanted` tables are built, by default all: some are written while they are built.

    balances(report_day, holding, bank_id, bank_name, country, unit_code, status, balance);
    limits(bank_id, holding, limit_type, limit, active_from); banks(bank_id, name).
    """
    today = latest_snapshot(balances, day).withColumn("total", F.col("balance") / 1e6)
    today = today.withColumn("active", F.when(F.col("status").isin(*active_statuses), F.col("total")).otherwise(0.0))
    valid = latest_one(limits.select("bank_id", "holding", "limit_type", "limit", "active_from"),
                       ["bank_id", "holding", "limit_type"], ["active_from", "limit"])
    agreed = valid.groupBy("bank_id", "holding").agg((F.sum("limit") / 1e6).alias("limit"))
    rows = lookup(today, agreed, {"bank_id": "bank_id", "holding": "holding"}, ["limit"], ["limit"])
    rows = entities.by_code(rows, "unit_code", segment="segment")
    rows = lookup(rows, banks, "bank_id", {"name": "listed_name"}, ["name"])
    rows = rows.select(
        "holding", F.coalesce("listed_name", "bank_name").alias("bank"), "country", "segment",
        F.bround(safe_ratio("active", "limit", 100.0), 1).alias("pct_active"),
        F.bround(safe_ratio("total", "limit", 100.0), 1).alias("pct_total"),
        F.bround("active", 2).alias("active"), F.bround("total", 2).alias("total"), F.bround("limit", 2).alias("limit"),
    ).where((F.col("active") != 0) & (F.col("limit").isNull() | (F.col("limit") != 0)))

    def sums(*keys: str) -> DataFrame:
        return rows.groupBy("holding", *keys).agg(sum0("active").alias("active"), sum0("total").alias("total"))

    def by_bank() -> DataFrame:
        return rows.groupBy("holding", "bank").agg(
            F.coalesce(F.avg("limit"), F.lit(0.0)).alias("limit"), sum0("active").alias("active"), sum0("pct_active").alias("pct_active"),
            sum0("total").alias("total"), sum0("pct_total").alias("pct_total"),
        ).withColumn("breach", limit_breach("active", "limit"))

    tables = {
        "by_bank": by_bank, "by_country": lambda: sums("country"), "by_segment": lambda: sums("segment"),
        "frame": lambda: subtotals(sums("country", "bank", "segment"), ["holding", "country", "bank", "segment"], ["active", "total"]),
        "matrix": lambda: _limit_matrix(sums("country", "bank", "segment")),
        "by_part": lambda: _limit_parts(rows, parts or {}),
    }
    return {name: tables[name]() for name in wanted or tables}


def _placed(df: DataFrame, within: list[str], name: str, position: str) -> DataFrame:
    """Lines of a summed table with their place: by active, then total, both falling, then name."""
    line = Window.partitionBy(*within).orderBy(F.desc("active"), F.desc("total"), name)
    return df.withColumn(position, F.row_number().over(line))


def _limit_matrix(cells: DataFrame) -> DataFrame:
    """Banks by segment, in report order: countries by size, their banks by size and then a total
    of the country (bank null), segments by size. One row per line and segment, 0 where nothing is held.

    `cells` holds one row per holding, country, bank and segment; windows rank summed lines only.
    """
    cells = staged(cells.where(F.col("country").isNotNull()), "cells")

    def summed(*keys: str) -> DataFrame:
        return cells.groupBy("holding", *keys).agg(F.sum("active").alias("active"), F.sum("total").alias("total"))

    segments = _placed(summed("segment"), ["holding"], "segment", "segment_no").select("holding", "segment", "segment_no")
    countries = _placed(summed("country"), ["holding"], "country", "country_no")
    banks = _placed(summed("country", "bank"), ["holding", "country"], "bank", "bank_no")
    banks = join_keys(banks, countries.select("holding", "country", "country_no"), ["holding", "country"], "inner", null_safe=False)
    last = banks.groupBy("holding", "country").agg((F.max("bank_no") + 1).alias("bank_no"))
    totals = join_keys(countries, last, ["holding", "country"], "inner", null_safe=False).withColumn("bank", F.lit(None).cast("string"))
    lines = join_keys(banks.unionByName(totals), segments, ["holding"], "inner", null_safe=False)
    held = cells.groupBy("holding", "country", "bank", "segment").agg(F.sum("total").alias("segment_total"))
    held = held.unionByName(held.groupBy("holding", "country", "segment").agg(F.sum("segment_total").alias("segment_total")).withColumn(
        "bank", F.lit(None).cast("string")))
    return join_keys(lines, held, ["holding", "country", "bank", "segment"], "left").na.fill(0.0, ["segment_total"])


def _limit_parts(rows: DataFrame, parts: dict[str, list[str]]) -> DataFrame:
    """Use of limits by bank within named groups of segments; the total is the bank's over all segments."""
    whole = rows.groupBy("holding", "bank").agg(F.sum("total").alias("total"))
    names = F.array_compact(F.array(*[F.when(F.col("segment").isin(*segments), F.lit(p)) for p, segments in parts.items()])) \
        if parts else F.array().cast("array<string>")
    chosen = rows.withColumn("part", F.explode(names)).groupBy("holding", "part", "bank").agg(
        F.coalesce(F.avg("limit"), F.lit(0.0)).alias("limit"), sum0("active").alias("active"))
    both = join_keys(chosen, whole, ["holding", "bank"], "inner", null_safe=False)
    return both.withColumns({f"pct_{c}": safe_ratio(c, "limit", 100.0) for c in ("active", "total")})


def arap_position(ledger: DataFrame, purpose: Column, entities: Entities, as_of: Column) -> DataFrame:
    """Receivables and payables by company, counterparty, currency, purpose and due date.

    ledger(source, holding, customer_name, org_name, company_code, second_code, currency,
    internal_flag, due, amount_usd, and the columns `purpose` reads). The company code is the
    first known of code, second code and the code found by name.
    """
    rows = ledger.withColumn("purpose", purpose).where(
        F.col("purpose").isin(*RECEIVABLE, *PAYABLE) & ~(F.col("org_name").isNull() & F.col("company_code").isNull())
    ).withColumn("currency", iso_code("currency"))
    rows = entities.by_name(rows, "org_name", code="org_code")
    rows = rows.withColumn("company", first_known("company_code", "second_code", "org_code"))
    rows = entities.by_code(rows, "company", segment="comp_map")
    rows = entities.by_name(rows, "customer_name", code="cty_code", segment="cty_map", holding="cty_holding")
    grouped = rows.groupBy(
        "holding", "customer_name", "cty_holding", "org_name", "company", "currency", "source", "purpose", "comp_map",
        "cty_code", "cty_map", "internal_flag", "due",
    ).agg(sum0("amount_usd").alias("amount_usd"), F.count(F.lit(1)).alias("lines"))
    ar = F.col("purpose").isin(*RECEIVABLE).cast("int")
    ap = F.col("purpose").isin(*PAYABLE).cast("int")
    return grouped.withColumns({
        "ar_flag": ar, "ap_flag": ap, "amount_ar_usd": F.col("amount_usd") * ar, "amount_ap_usd": F.col("amount_usd") * ap,
        "days": days_to("due", as_of), "period": maturity_bucket("due", as_of),
    })


def arap_provisions(position: DataFrame) -> DataFrame:
    """Provisions beside receivables per holding, segment and customer."""
    own = position.where(F.col("purpose").isin(*RECEIVABLE) & (F.col("comp_map") != EXTERNAL))
    wide = pivot_sum(own, ["holding", "comp_map", "customer_name"], "purpose", list(RECEIVABLE), "amount_usd", fill=0.0)
    return wide.select("holding", "comp_map", "customer_name", F.col("Provisions").alias("provisions"),
                       (F.col("Other receivables") + F.col("Trade receivables")).alias("ar"))


def arap_summary(position: DataFrame, run_date: Column) -> DataFrame:
    """Run summary for the history: sums per segment and currency with the holding's row count."""
    cells = position.groupBy("holding", "comp_map", "currency").agg(
        *[sum0(c).alias(c) for c in ("amount_usd", "amount_ar_usd", "amount_ap_usd")],
        F.sum("ap_flag").alias("ap_lines"), F.sum("ar_flag").alias("ar_lines"), F.count("amount_usd").alias("__n"))
    counts = cells.groupBy("holding").agg(F.sum("__n").alias("count_lines"))
    return join_keys(cells, counts, ["holding"], "inner").drop("__n").withColumn("run_date", run_date)


def counterclaims(position: DataFrame, units: DataFrame, holdings: list[str]) -> DataFrame:
    """Claims between the segments of a holding on the full grid of segments, in millions.

    Segments without claims show 0; `differs` compares what one side owes and the other claims.
    """
    between = position.where(
        F.col("purpose").isin(*CLAIMS) & (F.col("comp_map") != EXTERNAL) & (F.col("cty_map") != EXTERNAL)
    ).groupBy("holding", F.col("comp_map").alias("row_label"), F.col("cty_map").alias("col_label"), "currency").agg(
        sum0("amount_ar_usd").alias("ar"), sum0("amount_ap_usd").alias("ap"))
    grid = reporting_grid(units.where(F.col("holding").isin(*holdings)), "holding", "segment")
    out = join_keys(grid, between, ["holding", "row_label", "col_label"], "left")
    out = out.withColumns({c: F.bround(F.coalesce(F.col(c) / 1e6, F.lit(0.0)), 3) for c in ("ar", "ap")})
    return out.withColumns({"diff": F.col("ar") + F.col("ap"), "differs": differs("ap", "ar")})


def external_debt(debt: DataFrame, quotes: DataFrame, entities: Entities, as_of: Column, group_flag: str) -> dict[str, DataFrame]:
    """Third-party debt per company with sum and count, and the rows that need mapping.

    debt(company_code, party_name, currency, amount, term, and the internal/external flag).
    """
    rows = entities.by_name(debt, "party_name", code="party_code", segment="party_segment")
    rows = entities.by_code(rows, "company_code", segment="company_segment", holding="company_holding")
    rows = convert(rows, quotes, "USD", "currency", "amount", as_of)
    rows = rows.withColumns({"days": days_to("term", as_of), "period": maturity_bucket("term", as_of)})
    summary = rows.groupBy("company_holding", "company_code", "company_segment", group_flag).agg(
        sum0("amount_in_USD").alias("amount_usd"), F.count("amount_in_USD").alias("lines"))
    gaps = rows.where((F.col(group_flag) == "Internal") & (F.col("party_segment") == EXTERNAL)).select(
        "party_name", "party_code", "party_segment").distinct()
    return {"summary": summary, "rows": rows, "gaps": gaps}


def debt_position(loans: DataFrame, quotes: DataFrame, entities: Entities, as_of: Column) -> DataFrame:
    """Outstanding debt per entity, counterparty, currency and maturity, signed in USD.

    loans(entity, party, relation, account, currency, term_end, outstanding, display_amount).
    """
    grouped = loans.groupBy("entity", "relation", "party", "account", "currency", "term_end").agg(
        F.sum(F.abs("outstanding")).alias("outstanding"), F.sum("display_amount").alias("display_amount"),
        F.count(F.lit(1)).alias("lines"))
    rows = convert(grouped, quotes, "USD", "currency", "outstanding", as_of)
    rows = rows.withColumn("outstanding_in_USD", F.col("outstanding_in_USD") * F.signum("display_amount"))
    rows = entities.by_name(rows, "entity", code="entity_code", segment="entity_group", holding="holding")
    rows = entities.by_name(rows, "party", code="party_code", segment="party_group")
    return rows.withColumns({
        "days": days_to("term_end", as_of), "period": maturity_bucket("term_end", as_of), "source": F.lit("SAP")})


def debt_matrix(position: DataFrame, segments: list[str]) -> DataFrame:
    """Entity by counterparty segment matrix per holding and currency, external parties left out."""
    inner = position.where(F.col("party_group") != EXTERNAL)
    return exposure_matrix(inner, ["holding", "currency"], "entity_group", "party_group", segments, "outstanding_in_USD")


def treasury_debt(deals: DataFrame, entities: Entities, bond_mark: str = "Bond", issued: str = "ISSUED",
                  traded: str = "TRADED") -> DataFrame:
    """Latest treasury debt with bonds netted per deal set and maturities per report day.

    deals(report_day, effective_from, entity, party, deal_set, owner, currency, action_day,
    amount, amount_usd). Bonds net per report day and set; other deals pass through.
    """
    rows = latest_version(deals, ["report_day"], "effective_from")
    rows = entities.by_name(rows, "entity", code="mapped")
    rows = rows.withColumn("entity_code", F.coalesce(F.nullif("mapped", F.lit(EXTERNAL)), "entity"))
    rows = entities.by_code(rows, "entity_code", segment="entity_group")
    is_bond = F.coalesce(F.col("deal_set").contains(bond_mark), F.lit(False))
    netted = net_bonds(
        rows.where(is_bond), ["report_day", "deal_set"], "owner", issued, traded, ["entity_code", "entity_group"], "party",
        ["amount", "amount_usd"], carry=["currency", "action_day"])
    both = netted.unionByName(rows.where(~is_bond).select(*netted.columns))
    both = both.withColumn("party_name", cut_suffix("party", r" \(EC\)"))
    both = entities.by_name(both, "party_name", code="party_code", segment="party_group")
    return both.withColumns({
        "days": days_to("action_day", "report_day"), "period": maturity_bucket("action_day", "report_day"),
        "source": F.lit("Treasury")})


def derivatives(forwards: DataFrame, swaps: DataFrame, debt_deals: DataFrame, quotes: DataFrame, entities: Entities,
                as_of: Column) -> DataFrame:
    """Pay and receive legs of deals that are not already in debt, with maturities and USD.

    Deals: (deal_no, position_day, entity, party, pay_ccy, pay, rec_ccy, rec, maturity).
    """
    deals = forwards.unionByName(swaps)
    deals = join_keys(deals, debt_deals.select("deal_no").distinct(), ["deal_no"], "left_anti", null_safe=False)
    deals = entities.by_code(deals, "entity", segment="entity_group")
    rows = legs(deals, ["deal_no", "position_day", "entity", "entity_group", "party", "maturity"], "pay_ccy", "pay", "rec_ccy", "rec")
    rows = convert(rows, quotes, "USD", "currency", "amount", as_of)
    return rows.withColumns({
        "days": days_to("maturity", as_of), "period": maturity_bucket("maturity", as_of), "source": F.lit("Treasury")})


def derivative_totals(deals: DataFrame) -> DataFrame:
    """Pay and receive totals per day and currency pair."""
    return deals.groupBy("position_day", "pay_ccy", "rec_ccy").agg(sum0("pay").alias("pay"), sum0("rec").alias("rec"))


def deals_position(deals: dict[str, DataFrame], entities: Entities, as_of: str, purchase: str, sale: str) -> DataFrame:
    """Open invoiced deals of the latest day, signed, per kind of deal ('kind').

    Each table: (report_day, status, invoiced, delivery_to, deal_type, company_name, seller,
    buyer, product, currency, quantity, fallback_quantity, price).
    """
    parts = []
    for kind, table in deals.items():
        rows = latest_snapshot(table, "report_day", as_of)
        rows = rows.where((F.col("status") != "Cancelled") & (F.col("invoiced") == "Y") & (F.col("delivery_to") > F.col("report_day")))
        quantity = F.coalesce("quantity", "fallback_quantity")
        signed_quantity, money = deal_signs("deal_type", quantity, quantity * F.col("price"), purchase, sale)
        parts.append(rows.select(
            F.lit(kind).alias("kind"), "product", "company_name", F.concat(F.coalesce("seller", F.lit("")), F.coalesce("buyer", F.lit(""))).alias("party"),
            "currency", signed_quantity.alias("quantity"), money.alias("money"), "delivery_to",
            days_to("delivery_to", "report_day").alias("days"), maturity_bucket("delivery_to", "report_day").alias("period")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows = entities.by_name(rows, "company_name", segment="segment", holding="holding")
    return entities.by_name(rows, "party", segment="party_segment")


def cash_position(balances: DataFrame, impairments: DataFrame, entities: Entities, as_of: str) -> DataFrame:
    """Balances of the latest day with impairment; impairments(unit_code, bank_name, impairment)."""
    rows = entities.by_code(latest_snapshot(balances, "report_day", as_of), "unit_code", segment="segment")
    rows = lookup(rows, impairments, {"unit_code": "unit_code", "bank_name": "bank_name"}, ["impairment"], ["impairment"], 0.0)
    return rows.withColumns({"period": F.lit("<1M"), "balance_impaired": impaired(rows, "balance", "impairment")})


def investments(plan: DataFrame, quotes: DataFrame, pairs: dict[str, tuple[str, str]], as_of: Column) -> DataFrame:
    """Lower of two plan versions per holding and month, in USD.

    plan(holding, company, party, currency, month_text 'MM.yyyy', version, amount).
    """
    rows = plan.withColumn("month", F.to_date("month_text", "MM.yyyy"))
    keys = ["company", "party", "currency", "month"]
    chosen = minimum_of_versions(rows, keys, "holding", "version", "amount", pairs)
    summed = group_sum(chosen, [*keys, "holding"], ["amount"])
    return convert(summed, quotes, "USD", "currency", "amount", as_of)


def investments_from_unified(unified: DataFrame, keys: list[str]) -> DataFrame:
    """The second source of investments: rows of the unified position by project and calendar month.

    unified(record_id 'PROJECT-...', maturity, amount, keys). The maturity rolls back to the first
    of its month, the project is the head of the record id, and rows without an amount are left out.
    """
    rows = unified.where(F.col("amount") != 0).withColumns({
        "project": F.split("record_id", "-")[0], "month_start": F.trunc("maturity", "month")})
    sums = rows.groupBy(*keys, "project", "month_start").agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("lines"))
    return sums.withColumns({"year": F.year("month_start"), "month": F.month("month_start")})
