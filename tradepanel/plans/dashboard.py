"""The tables behind each dashboard chart, as parameterised slices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepanel.functions.scalars import differs, exact_sum, output_text, rate_text
from tradepanel.operators.joins import lookup


def bubble(trade: DataFrame, scores: DataFrame, product: str, year: int, excluded: str | None = None) -> DataFrame:
    """One product and year per partner with its score, nearest partner first."""
    rows = trade.where((F.col("product") == product) & (F.col("year") == year))
    if excluded is not None:
        rows = rows.where(differs("partner", excluded))
    of_year = scores.where(F.col("year") == year).select("partner", "geo_distance_score")
    return rows.join(of_year, "partner", "left").orderBy(F.col("geo_distance_score").asc_nulls_last(), "partner")


def rank(scores: DataFrame, year: int) -> DataFrame:
    """Scores of a year, highest first, with the axis limits min - 10 and max."""
    rows = scores.where((F.col("year") == year) & F.col("geo_distance_score").isNotNull())
    limits = rows.agg(
        F.struct(
            (F.min("geo_distance_score") - 10).alias("low"), F.max("geo_distance_score").alias("high")
        ).alias("axis")
    ).scalar()
    return rows.withColumns({"axis_low": limits.getField("low"), "axis_high": limits.getField("high")}).orderBy(
        F.col("geo_distance_score").desc(), "partner"
    )


def series(trade: DataFrame, partner: str, product: str, boundary: int) -> DataFrame:
    """History up to the boundary year and forecast from it; the boundary year is in both."""
    rows = trade.where((F.col("partner") == partner) & (F.col("product") == product))
    segments = F.filter(
        F.array(
            F.when(F.col("year") <= boundary, F.lit("history")),
            F.when(F.col("year") >= boundary, F.lit("forecast")),
        ),
        lambda s: s.isNotNull(),
    )
    return rows.withColumn("segment", F.explode(segments)).orderBy("segment", "year")


def trend(scores: DataFrame, partner: str) -> DataFrame:
    """Scores of one partner over the years."""
    return scores.where(F.col("partner") == partner).orderBy("year")


def yearly(
    trade: DataFrame, partner: str, marked: int, first_year: int, last_year: int,
    notes: dict[str, str] | None = None, note_years: dict[str, int] | None = None,
) -> DataFrame:
    """Yearly flows of one partner with the marked year and the agreement note."""
    notes, note_years = notes or {}, note_years or {}
    rows = trade.where((F.col("partner") == partner) & F.col("year").between(first_year, last_year))
    sums = rows.groupBy("partner", "year").agg(
        exact_sum("imports").alias("imports"), exact_sum("exports").alias("exports")
    )
    note = F.coalesce(lookup("partner", notes), F.lit("agreement in all years")) if notes else F.lit("agreement in all years")
    line = F.col("year") == lookup("partner", note_years) if note_years else F.lit(False)
    return sums.withColumns(
        {
            "is_marked": (F.col("year") == marked).cast("int"),
            "is_agreement_line": F.coalesce(line, F.lit(False)).cast("int"),
            "note": note,
        }
    ).orderBy("year")


def monthly(trade: DataFrame, partner: str, year: int) -> DataFrame:
    """Months of one partner and year."""
    return trade.where((F.col("partner") == partner) & (F.col("year") == year)).orderBy("month")


def rate_sentences(grid: DataFrame, rates: DataFrame, home_currency: str) -> DataFrame:
    """Exchange-rate sentence for every (country, year) asked for."""
    return grid.join(rates, ["country", "year"], "left").select(
        "country", "year", rate_text("er", "currency", "country", "year", home_currency).alias("rate_text")
    )


def output_sentences(grid: DataFrame, gdp: DataFrame, home: str) -> DataFrame:
    """Output comparison sentence for every (country, year) asked for."""
    home_rows = gdp.where(F.col("country") == home).groupBy("year").agg(F.max("gdp").alias("home_gdp"))
    return (
        grid.join(gdp, ["country", "year"], "left")
        .join(F.broadcast(home_rows), "year", "left")  # one row per calendar year
        .select(
            "country", "year", output_text(home, "home_gdp", "country", "gdp", "year").alias("gdp_text")
        )
    )
