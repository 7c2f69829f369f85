"""Market reports: outflow triggers, ratings, default rates, correlation, volatility, stock sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import all_null, sum0
from ledgerloom.functions.measures import second_best, week_label
from ledgerloom.functions.text import keyword_tag, matches_any_column, to_number
from ledgerloom.operators.dimensions import fill_missing, lookup
from ledgerloom.operators.fx import convert
from ledgerloom.operators.grouping import correlations, exact_quantiles, latest_version, top_k, with_group_value
from ledgerloom.operators.joins import join_keys
from ledgerloom.operators.reshape import melt_pairs, pivot_sum
from ledgerloom.operators.series import cross_rate, rolling_mean, to_series, volatility
from ledgerloom.sources.tables import trailing_period


def outflow_triggers(flows: DataFrame, units: DataFrame, country: str, excluded_groups: list[str]) -> dict[str, DataFrame]:
    """Weekly outflow per holding in millions with its 0.9 quantile and median.

    flows(holding, unit_code, day, group, internal_flag, amount, amount_usd);
    units(plant_code, country, unit_key). Flows of unknown units fall out with the country filter.
    """
    rows = flows.where((F.col("internal_flag") != 1) & (F.col("amount") < 0) & ~F.col("group").isin(*excluded_groups))
    daily = rows.groupBy(F.coalesce("holding", F.lit("Empty")).alias("holding"), "unit_code", "day").agg(sum0("amount_usd").alias("amount_usd"))
    daily = lookup(daily, units, {"unit_code": "plant_code"}, ["country"], ["unit_key"]).where(F.col("country") == country)
    weekly = daily.groupBy(
        "holding", F.year("day").alias("year"), F.weekofyear("day").alias("week"), week_label("day").alias("week_num"),
    ).agg((F.abs(sum0("amount_usd")) / 1e6).alias("outflow"))
    return {"weekly": weekly, "thresholds": exact_quantiles(weekly, ["holding"], "outflow", {"q90": 0.9, "median": 0.5})}


def country_ratings(
    ratings: DataFrame, points: DataFrame, fallback: DataFrame, codes: DataFrame, agencies: dict[str, str],
) -> dict[str, DataFrame]:
    """Latest rating per country and agency, the second best of them and its date.

    ratings(country, agency, day, letter); points(letter, value); fallback(country, letter, day)
    fills countries that no agency rates; codes(country, code). `agencies` maps agency names
    to short names.
    """
    newest = latest_version(ratings.where(F.col("agency").isin(*agencies)), ["country", "agency"], "day")
    wide = newest.groupBy("country").pivot("agency", list(agencies)).agg(
        F.min("letter").alias("letter"), F.max("day").alias("day"))
    wide = wide.withColumnsRenamed({f"{a}_{x}": f"{n}_{x}" for a, n in agencies.items() for x in ("letter", "day")})
    names = list(agencies.values())
    all_countries = join_keys(codes.select("country").distinct(), wide, ["country"], "full")
    filled = lookup(all_countries, fallback, "country", {"letter": "fallback_letter", "day": "fallback_day"}, ["day", "letter"])
    unrated = all_null([f"{n}_letter" for n in names])
    filled = filled.withColumn("unrated", unrated)
    filled = filled.withColumns(
        {f"{n}_{x}": F.when(F.col("unrated"), F.col(f"fallback_{x}")).otherwise(F.col(f"{n}_{x}")) for n in names for x in ("letter", "day")})
    full = fill_missing(filled.withColumn("code", F.lit(None).cast("string")), "code", codes, {"country": "country"}, "code", ["code"])
    full = full.drop("unrated", "fallback_letter", "fallback_day")
    for n in names:
        full = lookup(full, points, {f"{n}_letter": "letter"}, {"value": f"{n}_value"}, ["value"])
    value, source = second_best({n: F.col(f"{n}_value") for n in names})
    full = full.withColumns({"second_best": value, "chosen": source})
    long = melt_pairs(full, ["code", "country", "chosen", "second_best"], {n: (f"{n}_letter", f"{n}_day") for n in names})
    one = long.where(F.col("source") == F.col("chosen")).select(
        "code", "country", F.col("source").alias("agency"), F.col("value").alias("rating"), F.col("date").alias("day"), "second_best")
    return {"full": full, "one_rating": one}


def invoice_default_rates(invoices: DataFrame, scale: DataFrame, model: DataFrame) -> dict[str, DataFrame]:
    """Invoices with letter ratings and default rates, gaps filled by the country's mean.

    invoices(invoice, party, country, rating, pd); scale(points, letter); model(party, rating, pd).
    """
    rows = lookup(invoices.withColumn("number", to_number("rating")), scale, {"number": "points"}, ["letter"], ["letter"])
    rows = rows.withColumn("rating", F.when(F.col("number").isNull(), F.col("rating")).otherwise(F.col("letter")))
    rows = lookup(rows, model.na.drop(subset=["party", "pd"]), "party", {"rating": "model_rating", "pd": "model_pd"}, ["pd", "rating"])
    filled = with_group_value(rows, ["country"], mean_pd=F.avg("pd"), mean_model_pd=F.avg("model_pd"))
    report = filled.select(
        "invoice", "party", "country", "rating", F.coalesce("pd", "mean_pd").alias("pd"), "model_rating",
        F.coalesce("model_pd", "mean_model_pd").alias("model_pd"))
    coverage = rows.groupBy("country", F.col("model_pd").isNotNull().alias("have_data")).agg(
        F.count(F.lit(1)).alias("lines"), F.avg("model_pd").alias("mean_model_pd"))
    return {"invoices": report, "coverage": coverage}


def instrument_correlation(catalogue: DataFrame, prices: DataFrame, search: list[str], pattern: str, tags: list[str],
                           rows: int = 14) -> dict[str, DataFrame]:
    """Correlation of the selected instruments, whole and by year, with a rolling mean.

    catalogue(id, description and the searched columns); prices(id, day, price).
    """
    chosen = catalogue.where(matches_any_column(search, pattern)).select("id", keyword_tag("description", tags).alias("tag"))
    chosen = chosen.where(F.col("tag").isNotNull())
    tagged = join_keys(prices, chosen, ["id"], "inner", null_safe=False)
    series = to_series(tagged, ["tag"], "day", "price")
    smooth = series.withColumn("rolling_mean", rolling_mean(series, ["tag"], "period", "value", rows))
    wide = pivot_sum(series, ["period"], "tag", tags, "value").withColumn("year", F.year("period"))
    return {"series": smooth, "wide": wide, "corr": correlations(wide, tags), "corr_by_year": correlations(wide, tags, ["year"])}


def currency_volatility(series: DataFrame, first: str, second: str, cross: str, horizons: dict[str, int | None]) -> DataFrame:
    """Volatility per pair, with a cross pair added; series(pair, period, value)."""
    return volatility(cross_rate(series, "pair", "period", "value", first, second, cross), ["pair"], "period", "value", horizons)


def price_volatility(prices: DataFrame, horizons: dict[str, int | None]) -> DataFrame:
    """Strict volatility of the mean price over agencies; prices(product, day, price)."""
    return volatility(to_series(prices, ["product"], "day", "price"), ["product"], "period", "value", horizons, strict=True)


def stock_sales(sales: DataFrame, stock: DataFrame, quotes: DataFrame, as_of: Column, top: int = 10) -> dict[str, DataFrame]:
    """Sales of items whose lowest stock is negative and below the mean, and market shares.

    sales(item, market, country, currency, quantity, money); stock(item, quantity).
    """
    low = stock.groupBy("item").agg(F.min("quantity").alias("low"), F.avg("quantity").alias("mean"))
    low = low.where((F.col("low") < F.col("mean")) & (F.col("low") < 0)).select("item")
    summed = sales.groupBy("item", "market", "country", "currency").agg(
        F.sum("quantity").alias("quantity"), F.sum("money").alias("money"))
    valued = convert(join_keys(summed, low, ["item"], "left_semi"), quotes, "USD", "currency", "money", as_of)
    by_item = valued.groupBy("item", "market", "country").agg(sum0("quantity").alias("quantity"), sum0("money_in_USD").alias("money_usd"))
    per_item = by_item.groupBy("market", "item").agg(F.sum("money_usd").alias("money_usd"))
    best = top_k(per_item, ["market"], [F.desc("money_usd"), F.asc("item")], top).select("market", "item", F.lit(True).alias("__top"))
    label = F.when(F.col("__top"), F.col("item").cast("string")).otherwise("other")
    shares = join_keys(per_item, best, ["market", "item"], "left").groupBy("market", label.alias("label")).agg(
        F.sum("money_usd").alias("money_usd"))
    return {"sales": by_item, "shares": shares}


def price_catalogue(catalogue: DataFrame, prices: DataFrame, attributes: Column, tags: list[str], dead: DataFrame, as_of: str,
                    years: int = 10) -> dict[str, DataFrame]:
    """Instruments chosen by attributes and keyword, whether still quoted, and their history.

    catalogue(id, name); dead(id); prices(id, day, price).
    """
    chosen = catalogue.where(attributes).withColumn("product", keyword_tag("name", tags)).where(F.col("product").isNotNull())
    gone = dead.select("id", F.lit("no").alias("__dead")).distinct()
    chosen = join_keys(chosen, gone, ["id"], "left", null_safe=False).withColumn("alive", F.coalesce("__dead", F.lit("yes"))).drop("__dead")
    history = join_keys(trailing_period(prices, "day", as_of, months=12 * years), chosen.select("id", "product"), ["id"], "inner",
                        null_safe=False)
    return {"catalogue": chosen, "history": history}
