"""Wide/long, pair and nested-lookup queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradepanel.catalog.concepts import HOME, gdp, pair_means, with_tables, year_span
from tradepanel.catalog.registry import query
from tradepanel.catalog.scans import _ports
from tradepanel.functions.pairs import pair_text, parse_pair
from tradepanel.operators import project, reshape


def _wide(spark, folder):
    return reshape.widen(gdp(spark, folder), ["partner"], "year", year_span(spark, folder), "gdp")


@query("unpivot_years", with_tables("gdp", body="SELECT partner, year, gdp FROM gdp"))
def unpivot_years(spark, folder):
    """Yearly columns whose names are generated, then melted."""
    wide = _wide(spark, folder)
    unnamed = wide.toDF("partner", *[f"column {i}" for i in range(len(wide.columns) - 1)])
    named = project.number_names(unnamed, 1, int(wide.columns[1]))
    return reshape.melt_years(named, ["partner"], "gdp").dropna()


@query("entity_series", with_tables("gdp", body=f"SELECT year, gdp AS home_gdp FROM gdp WHERE partner = '{HOME}'"))
def entity_series(spark, folder):
    return reshape.entity_series(_wide(spark, folder), "partner", HOME, "home_gdp").dropna()


@query("pair_split", with_tables("pairs", body="SELECT year, country1, country2, agree FROM pairs"))
def pair_split(spark, folder):
    text = pair_means(spark, folder).select("year", pair_text("pair").alias("pair_text"), "agree")
    names = parse_pair("pair_text")
    return text.select("year", names[0].alias("country1"), names[1].alias("country2"), "agree")


@query(
    "nested_lookup",
    """SELECT n_name AS country, c_mktsegment AS city, count(*) AS customers,
              CAST(sum(CAST(c_acctbal AS DECIMAL(18,4))) AS DOUBLE) AS balance
       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""",
)
def nested_lookup(spark, folder):
    nested = reshape.nested_lookup(_ports(spark, folder), "country", "city", ["customers", "balance"])
    return reshape.lookup_rows(nested, "country", "city")


@query(
    "city_choices",
    """SELECT country, string_agg(city, '|' ORDER BY city) AS choices FROM (
           SELECT DISTINCT n_name AS country, c_mktsegment AS city
           FROM customer JOIN nation ON c_nationkey = n_nationkey) GROUP BY 1""",
)
def city_choices(spark, folder):
    nested = reshape.nested_lookup(_ports(spark, folder), "country", "city", ["customers", "balance"])
    return reshape.inner_choices(nested, "country").select("country", F.array_join("choices", "|").alias("choices"))
