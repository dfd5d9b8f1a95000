"""Lag, growth and row-shift queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradepanel.catalog.concepts import gdp, home_gdp, rates, table, trade, with_tables
from tradepanel.catalog.registry import query
from tradepanel.operators import windows
from tradepanel.operators.ordering import INDEX, shift_rows, with_row_index

_SERIES = "PARTITION BY partner, hs_code, product ORDER BY year"


@query(
    "lag_features",
    with_tables("trade", body=f"""
        SELECT year, partner, hs_code, product, imports, lag(imports, 1) OVER w AS imports_lag1,
               lag(imports, 2) OVER w AS imports_lag2, lag(imports, 3) OVER w AS imports_lag3
        FROM trade WINDOW w AS ({_SERIES})"""),
)
def lag_features(spark, folder):
    rows = trade(spark, folder).drop("exports", "trade_volume")
    return windows.add_lags(rows, ["partner", "hs_code", "product"], ["imports"])


@query(
    "lag_adjacent",
    with_tables("trade", body=f"""
        SELECT year, partner, hs_code, product, exports,
               CASE WHEN lag(year) OVER w = year - 1 THEN lag(exports) OVER w END AS exports_lag1
        FROM trade WHERE imports IS NOT NULL AND exports IS NOT NULL WINDOW w AS ({_SERIES})"""),
)
def lag_adjacent(spark, folder):
    """Lag that counts only if it is from the year before."""
    rows = trade(spark, folder).dropna().drop("imports", "trade_volume")
    return windows.add_lags(rows, ["partner", "hs_code", "product"], ["exports"], [1], adjacent=True)


@query(
    "lag_matrix",
    with_tables("gdp", "rates", body="""
        SELECT g.partner, g.year, gdp, rate, """ + ", ".join(
            f"lag({c}, {k}) OVER w AS {c}_lag{k}" for c in ("gdp", "rate") for k in (1, 2, 3)
        ) + """ FROM gdp g JOIN rates r ON r.partner = g.partner AND r.year = g.year
        WINDOW w AS (PARTITION BY g.partner ORDER BY g.year)"""),
)
def lag_matrix(spark, folder):
    rows = gdp(spark, folder).join(rates(spark, folder), ["partner", "year"])
    return windows.add_lags(rows, ["partner"], ["gdp", "rate"])


@query("gdp_lag", with_tables("gdp_lagged", body="SELECT partner, year, gdp, gdp_lag1 FROM gdp_lagged"))
def gdp_lag(spark, folder):
    return windows.entity_lag(gdp(spark, folder), "partner", "gdp", "gdp_lag1")


@query("home_lag", with_tables("home_gdp", body="SELECT year, home_gdp, home_gdp_lag1 FROM home_gdp"))
def home_lag(spark, folder):
    return home_gdp(gdp(spark, folder))


@query(
    "pct_change",
    with_tables("rates", body="""
        SELECT partner, year, rate, filled / lag(filled) OVER (PARTITION BY partner ORDER BY year) - 1 AS rate_change
        FROM (SELECT partner, year, r AS rate, last_value(r IGNORE NULLS) OVER (
                  PARTITION BY partner ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled
              FROM (SELECT partner, year, CASE WHEN year <> 1998 THEN rate END AS r FROM rates))"""),
)
def pct_change(spark, folder):
    """Growth of a series with a gap in 1998."""
    rows = rates(spark, folder).withColumn("rate", F.when(F.col("year") != 1998, F.col("rate")))
    return windows.growth(rows, ["partner"], "rate", "rate_change")


@query(
    "global_shift",
    """SELECT o_orderkey, o_custkey, lead(o_custkey) OVER w AS next_custkey, lag(o_totalprice, 2) OVER w AS price_two_back
       FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey)""",
)
def global_shift(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    indexed = with_row_index(rows, ["o_orderdate", "o_orderkey"])
    shifted = shift_rows(indexed, {"next_custkey": ("o_custkey", -1), "price_two_back": ("o_totalprice", 2)})
    return shifted.select("o_orderkey", "o_custkey", "next_custkey", "price_two_back")


@query(
    "row_index",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              row_number() OVER (ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS row_index
       FROM lineitem""",
)
def row_index(spark, folder):
    order = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = table(spark, folder, "lineitem").select(*order)
    return with_row_index(rows, order).select("l_orderkey", "l_linenumber", "l_partkey", INDEX)
