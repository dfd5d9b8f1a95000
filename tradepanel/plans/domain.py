"""Trade-panel analyses: balances, distances, agreements, scores and the joined panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradepanel.functions import fixed_values as fixed
from tradepanel.functions.pairs import canonical_pair, counterparty, involves
from tradepanel.functions.scalars import (
    add_strict, add_zero_fill, exact_sum, log10, log1p, mean_of, month_of_text, ratio, round_even,
    to_number, zero_sum,
)
from tradepanel.operators.aggregates import group_sums, share_of_total, with_subtotals
from tradepanel.operators.filters import not_in, reject_marked
from tradepanel.operators.joins import against_reference, by_year, lookup, name_both_sides, recode
from tradepanel.operators.ordering import group_median
from tradepanel.operators.reshape import melt, symmetrise


def trade_balance(
    flows: DataFrame, keys: Sequence[str], flow: str = "flow", value: str = "value", mode: str = "strict"
) -> DataFrame:
    """Imports, exports and total per key from one table of directed flows.

    One conditional aggregation stands for the outer join of two. ``strict`` leaves the
    total null if a side is missing, ``zero_fill`` counts it as 0.
    """
    add = {"strict": add_strict, "zero_fill": add_zero_fill}[mode]
    sums = (
        flows.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(
            exact_sum(F.when(F.col(flow) == "Import", F.col(value))).alias("imports"),
            exact_sum(F.when(F.col(flow) == "Export", F.col(value))).alias("exports"),
        )
    )
    return sums.withColumn("trade_volume", add("imports", "exports"))


def pair_distance(votes: DataFrame, names: DataFrame, targets: Sequence[str] | None = None) -> DataFrame:
    """Mean agreement and distance per year and unordered pair of named countries.

    ``votes``: code1, code2, year, agree, ideal_x, ideal_y, distance. A missing distance
    is |x - y|; rows with any remaining null are left out.
    """
    named = name_both_sides(votes, names, "code", "name", {"code1": "country1", "code2": "country2"})
    if targets is not None:
        named = named.where(F.col("country1").isin(list(targets)) & F.col("country2").isin(list(targets)))
    complete = named.withColumn(
        "distance", F.coalesce("distance", F.abs(F.col("ideal_x") - F.col("ideal_y")))
    ).dropna()
    measures = ["agree", "ideal_x", "ideal_y", "distance"]
    return (
        complete.withColumn("pair", canonical_pair("country1", "country2"))
        .groupBy("year", "pair")
        .agg(*[mean_of(m).alias(m) for m in measures])
    )


def home_pairs(pairs: DataFrame, home: str | int, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """Pairs with the home country, in a span of years if one is given, with the other side as ``partner``."""
    c1, c2 = F.col("pair")[0], F.col("pair")[1]
    own = pairs.where(involves(c1, c2, home))
    if first_year is not None:
        own = own.where(F.col("year") >= first_year)
    if last_year is not None:
        own = own.where(F.col("year") <= last_year)
    return own.withColumn("partner", counterparty(c1, c2, home))


def agreement_adjust(
    agreements: DataFrame, weights: DataFrame, home: str | int, cut_year: int = fixed.TARIFF_WEIGHT_CUT_YEAR
) -> DataFrame:
    """Agreement weight less its tariff burden, for both directions of each pair.

    ``agreements``: year, country, partner_country, fta_weight, tariff_pct, export_weight.
    A blank country is the home country. Missing numbers count as 0.
    """
    blank = F.coalesce(F.trim(F.col("country").cast("string")) == "", F.lit(True))
    filled = agreements.withColumn("country", F.when(blank, F.lit(home)).otherwise(F.col("country")))
    sided = name_both_sides(
        filled, weights, "country", "tariff_weight",
        {"country": "country_weight", "partner_country": "partner_weight"},
    ).na.fill(0.0, ["fta_weight", "tariff_pct", "export_weight", "country_weight", "partner_weight"])
    burden = F.col("tariff_pct") / 100 * F.col("export_weight") / 100
    adjusted = F.when(
        F.col("year") < cut_year,
        F.col("fta_weight") - burden * F.col("country_weight") - burden * F.col("partner_weight"),
    ).otherwise(F.col("fta_weight") - burden)
    rows = sided.select(
        "year", "country", "partner_country", F.greatest(adjusted, F.lit(0.0)).alias("adjusted_value")
    )
    return symmetrise(rows, "country", "partner_country").withColumn(
        "fta_binary", (F.col("adjusted_value") > 0).cast("int")
    )


def tariff_profile(tariffs: DataFrame, reporter: str = "reporter") -> DataFrame:
    """Log tariff totals, averages over all rows, and the any-preference flag per reporter.

    ``tariffs``: reporter, mfn, prf, pta (may be text), reporter_group, partner_group and
    ``row_order``, which decides what is first.
    """
    typed = tariffs.withColumns({c: to_number(c) for c in ("mfn", "prf", "pta")})
    out = (
        typed.where(F.col(reporter).isNotNull())
        .groupBy(reporter)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            zero_sum(log1p("mfn")).alias("total_mfn"),
            zero_sum(log1p("prf")).alias("total_prf"),
            F.coalesce(F.max((F.col("pta") > 0).cast("int")), F.lit(0)).alias("total_pta"),
            *[
                F.min_by(c, F.when(F.col(c).isNotNull(), F.col("row_order"))).alias(c)
                for c in ("reporter_group", "partner_group")
            ],
        )
    )
    return out.withColumns(
        {
            "avg_mfn": ratio("total_mfn", "row_count"),
            "avg_prf": ratio("total_prf", "row_count"),
        }
    )


def geo_aggregate(rows: DataFrame, country: str = "partner") -> DataFrame:
    """Flow sums and exact medians of the score inputs per country and year."""
    keys = [country, "year"]
    medians = group_median(rows, keys, ["distance", "gdp_lag1", "rate_log", "adjusted_value", "fta_binary"])
    return group_sums(rows, keys, ["imports", "exports"]).join(medians, keys, "left")


def score_expression() -> Column:
    return (
        F.lit(fixed.SCORE_BASE)
        + F.lit(fixed.SCORE_DISTANCE) * F.col("distance")
        + F.lit(fixed.SCORE_LOG_GDP) * log10("gdp_lag1")
        + F.lit(fixed.SCORE_RATE) * F.col("rate_log")
        + F.lit(fixed.SCORE_AGREEMENT) * F.col("adjusted_value")
        + F.lit(fixed.SCORE_AGREEMENT_FLAG) * F.col("fta_binary")
    )


def geo_score(aggregated: DataFrame, country: str = "partner") -> DataFrame:
    """Composite distance score per country and year; higher means further apart."""
    return aggregated.select(country, "year", score_expression().alias("geo_distance_score"))


def score_of(scores: DataFrame, year: int | None = None, entity: str | None = None, country: str = "partner") -> DataFrame:
    """Scores of one year, one country, or both."""
    if year is not None:
        scores = scores.where(F.col("year") == year)
    if entity is not None:
        scores = scores.where(F.col(country) == entity)
    return scores


def normalise_to_ref(df: DataFrame, entity: str, reference: str, value: str, entities: Sequence[str] | None = None) -> DataFrame:
    """Value over the reference entity's value of the same year; incomplete rows are dropped."""
    if entities is not None:
        df = df.where(F.col(entity).isin([*entities, reference]))
    return against_reference(df, entity, reference, "year", value, f"{value}_normalized").dropna()


def cross_rate(rates: DataFrame, home: str, currencies: dict[str, str], first_year: int,
               spellings: dict[str, str] | None = None) -> DataFrame:
    """Local currency per home currency, rounded half-even to 2 digits, with its label."""
    named = rates.withColumn("country", recode("country", spellings)) if spellings else rates
    recent = named.where(F.col("year") >= first_year)
    return (
        against_reference(recent, "country", home, "year", "rate", "_cross")
        .withColumn("er", round_even("_cross", 2))
        .withColumn("currency", lookup("country", currencies))
        .drop("rate", "_cross")
    )


def indicator_summary(
    wide: DataFrame, indicators: Sequence[str], product: str, world: str, marker: str = fixed.BAD_CELL
) -> DataFrame:
    """Yearly value per partner and indicator type from a table with one column per year."""
    keys = ["reporter", "partner", "product_category", "indicator_type", "indicator"]
    long = melt(wide, keys, "year", "trade_value", value_type="string")
    long = long.withColumn("year", to_number("year", "int")).dropna()
    clean = reject_marked(long, marker).where(
        F.col("indicator").isin(list(indicators))
        & (F.col("product_category") == product)
        & (F.col("partner") != world)
    )
    return group_sums(
        clean.withColumn("trade_value", to_number("trade_value")), ["year", "partner", "indicator_type"], ["trade_value"]
    )


def yearly_totals(
    imports: DataFrame, exports: DataFrame, countries: Sequence[str] | None, last_year: int,
    spellings: dict[str, str] | None = None, by_month: bool = False,
) -> DataFrame:
    """Yearly flows per country from two tables with a country column and month-named columns."""
    long_in = melt(imports, ["country"], "month_text", "imports")
    long_out = melt(exports, ["country"], "month_text", "exports")
    both = long_in.join(long_out, ["country", "month_text"], "left").withColumn("country", F.trim("country"))
    if countries is not None:
        both = both.where(F.col("country").isin(list(countries)))
    if spellings:
        both = both.withColumn("country", recode("country", spellings))
    both = both.withColumn("trade_volume", add_strict("imports", "exports")).dropna()
    month = month_of_text("month_text")
    dated = both.withColumns({"year": F.year(month), "month": F.month(month)}).where(F.col("year") <= last_year)
    keys = ["country", "year", "month"] if by_month else ["country", "year"]
    return group_sums(dated, keys, ["imports", "exports", "trade_volume"])


def partner_coverage(
    yearly: DataFrame, chosen: Sequence[str], not_countries: Sequence[str], first_year: int
) -> DataFrame:
    """Share of total trade since a year that falls on chosen partners, market totals left out."""
    kept = yearly.where((F.col("year") >= first_year) & not_in("country", not_countries))
    return share_of_total(kept, F.col("country").isin(list(chosen)), "trade_volume")


def panel_build(
    pairs: DataFrame, trade: DataFrame, gdp: DataFrame, rates: DataFrame, agreements: DataFrame,
    home_gdp: DataFrame, home: str | int, first_year: int | None = None, last_year: int | None = None,
) -> DataFrame:
    """The (partner, year, product) panel with all covariates.

    Pairs of the home country are left-joined with trade; incomplete rows go; national
    output, exchange rate, agreement and home output are then attached, each one row per
    (partner, year) or year, so the panel keeps its key.
    """
    base = home_pairs(pairs, home, first_year, last_year).select("year", "partner", "agree", "distance")
    flows = base.join(trade, ["year", "partner"], "left").dropna().distinct()
    with_home = agreements.where(F.col("partner_country") == home).select(
        "year", F.col("country").alias("partner"), "adjusted_value", "fta_binary"
    )
    joined = (
        flows.join(gdp, ["partner", "year"], "left")
        .join(rates, ["partner", "year"], "left")
        .join(with_home, ["partner", "year"], "left")
    )
    return by_year(joined, home_gdp)


def with_all_products(trade: DataFrame, keys: Sequence[str] = ("year", "partner")) -> DataFrame:
    """Detail rows plus one 'All Products' row (code 99) per key."""
    return with_subtotals(
        trade, keys, {"product": fixed.ALL_PRODUCTS, "hs_code": fixed.ALL_PRODUCTS_CODE},
        ["imports", "exports", "trade_volume"],
    )


def combine_forecasts(imports: DataFrame, exports: DataFrame, on: Sequence[str]) -> DataFrame:
    """Import and export forecasts of the same key, with their total."""
    return imports.join(exports, list(on), "inner").withColumn("trade_volume", add_strict("imports", "exports"))


def history_and_forecast(history: DataFrame, forecast: DataFrame, products: dict) -> DataFrame:
    """History followed by forecasts on the same columns; forecast products are named by code."""
    named = forecast.withColumn("product", lookup("hs_code", products)) if products else forecast
    return history.unionByName(named.select(*history.columns))
