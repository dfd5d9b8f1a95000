"""Trade-panel analyses."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradepanel.catalog.concepts import (
    adjusted, define, flows, orders, pair_means, panel, table, trade, with_tables, year_span, _named,
)
from tradepanel.catalog.registry import query
from tradepanel.functions.scalars import exact_sum, log1p
from tradepanel.operators.reshape import widen
from tradepanel.plans import domain
from tradepanel.session import materialise


@query(
    "trade_balance",
    with_tables("trade", body="""
        SELECT year, partner, hs_code, product, imports, exports, imports + exports AS trade_volume FROM trade"""),
)
def trade_balance(spark, folder):
    return trade(spark, folder)


@query(
    "trade_balance_filled",
    with_tables("trade", body="""
        SELECT year, partner, hs_code, product, imports, exports,
               coalesce(imports, 0) + coalesce(exports, 0) AS trade_volume FROM trade"""),
)
def trade_balance_filled(spark, folder):
    return trade(spark, folder, mode="zero_fill")


@query(
    "pair_distance",
    with_tables("pairs", body="SELECT year, country1, country2, agree, ideal_x, ideal_y, distance FROM pairs"),
)
def pair_distance(spark, folder):
    rows = pair_means(spark, folder)
    return rows.select(
        "year", F.col("pair")[0].alias("country1"), F.col("pair")[1].alias("country2"),
        "agree", "ideal_x", "ideal_y", "distance",
    )


@query("agreement_adjust", with_tables("adjusted", body="SELECT * FROM adjusted"))
def agreement_adjust(spark, folder):
    return adjusted(spark, folder)


@query(
    "tariff_profile",
    with_tables("order_rows", body="""
        SELECT reporter, row_count, total_mfn, total_prf, total_pta, reporter_group, partner_group,
               round(m / row_count, 6) AS avg_mfn, round(p / row_count, 6) AS avg_prf
        FROM (SELECT reporter, count(*) AS row_count, sum(ln(1 + mfn)) AS m, sum(ln(1 + prf)) AS p,
                     round(sum(ln(1 + mfn)), 6) AS total_mfn, round(sum(ln(1 + prf)), 6) AS total_prf,
                     CAST(coalesce(max(CASE WHEN pta > 0 THEN 1 ELSE 0 END), 0) AS INT) AS total_pta,
                     arg_min(l_linestatus, row_order) FILTER (WHERE l_linestatus IS NOT NULL) AS reporter_group,
                     arg_min(rf, row_order) FILTER (WHERE rf IS NOT NULL) AS partner_group
              FROM (SELECT s_nationkey AS reporter, l_tax * 100 AS mfn,
                           CASE WHEN l_returnflag <> 'R' THEN l_discount * 100 END AS prf,
                           CASE WHEN l_quantity > 49 THEN l_quantity END AS pta, l_linestatus,
                           nullif(l_returnflag, 'R') AS rf,
                           l_orderkey * 1000000000 + l_partkey * 100000 + l_suppkey * 10 + l_linenumber AS row_order
                    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) GROUP BY 1)"""),
)
def tariff_profile(spark, folder):
    """Line taxes and discounts stand for tariffs; the preference margin is text that may be no number."""
    supplier = table(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").alias("reporter"))
    rows = (
        table(spark, folder, "lineitem")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            "reporter",
            (F.col("l_tax") * 100).alias("mfn"),
            F.when(F.col("l_returnflag") != "R", F.col("l_discount") * 100).alias("prf"),
            F.when(F.col("l_quantity") > 49, F.col("l_quantity").cast("string")).otherwise("none").alias("pta"),
            F.col("l_linestatus").alias("reporter_group"),
            F.nullif("l_returnflag", F.lit("R")).alias("partner_group"),
            (
                F.col("l_orderkey") * 1000000000 + F.col("l_partkey") * 100000 + F.col("l_suppkey") * 10
                + F.col("l_linenumber")
            ).alias("row_order"),
        )
    )
    out = domain.tariff_profile(rows)
    return out.withColumns({c: F.round(c, 6) for c in ("total_mfn", "total_prf", "avg_mfn", "avg_prf")})


define("score_rows", ["panel"], """
    SELECT *, ln(1 + rate) AS rate_log FROM panel
    WHERE gdp_lag1 IS NOT NULL AND home_gdp_lag1 IS NOT NULL AND adjusted_value IS NOT NULL AND rate IS NOT NULL""")
define("geo", ["score_rows"], """
    SELECT partner, year, CAST(sum(CAST(imports AS DECIMAL(18,4))) AS DOUBLE) AS imports,
           CAST(sum(CAST(exports AS DECIMAL(18,4))) AS DOUBLE) AS exports,
           median(distance / 1000) AS distance, median(gdp_lag1) AS gdp_lag1, median(rate_log) AS rate_log,
           median(adjusted_value) AS adjusted_value, median(CAST(fta_binary AS DOUBLE)) AS fta_binary
    FROM score_rows GROUP BY 1, 2""")
define("scores", ["geo"], """
    SELECT partner, year, round(500.0 + 4.0 * distance - 28.0 * log10(gdp_lag1) - 0.7 * rate_log
                                - 16.0 * adjusted_value - 16.0 * fta_binary, 6) AS geo_distance_score
    FROM geo""")


def geo(spark, folder):
    """Score inputs per partner and year; ideal points are balances, hence the unit of 1000."""
    rows = panel(spark, folder).dropna().withColumns(
        {"rate_log": log1p("rate"), "distance": F.col("distance") / 1000}
    )
    return domain.geo_aggregate(materialise(rows, "panel"))


def scores(spark, folder):
    out = domain.geo_score(geo(spark, folder))
    return out.withColumn("geo_distance_score", F.round("geo_distance_score", 6))


@query(
    "geo_aggregate",
    with_tables("geo", body="SELECT * REPLACE (round(rate_log, 8) AS rate_log) FROM geo"),
)
def geo_aggregate(spark, folder):
    return geo(spark, folder).withColumn("rate_log", F.round("rate_log", 8))


@query("geo_score", with_tables("scores", body="SELECT * FROM scores"))
def geo_score(spark, folder):
    return scores(spark, folder)


@query("geo_score_year", with_tables("scores", body="SELECT * FROM scores WHERE year = 1999"))
def geo_score_year(spark, folder):
    return domain.score_of(scores(spark, folder), year=1999)


@query(
    "geo_score_partner",
    with_tables("scores", body="SELECT * FROM scores WHERE partner = 'NATION_7' AND year = 2000"),
)
def geo_score_partner(spark, folder):
    return domain.score_of(scores(spark, folder), year=2000, entity="NATION_7")


@query(
    "indicator_summary",
    with_tables("lines", body="""
        SELECT year, n_name AS partner, flow AS indicator_type,
               CAST(sum(CAST(CAST(floor(v) AS BIGINT) AS DECIMAL(18,4))) AS DOUBLE) AS trade_value
        FROM (SELECT year, code, flow, product, CAST(sum(value) AS DOUBLE) AS v FROM (
                  SELECT year, buyer AS code, 'Export' AS flow, product, value FROM lines
                  UNION ALL SELECT year, seller, 'Import', product, value FROM lines) GROUP BY 1, 2, 3, 4)
        JOIN nation ON code = n_nationkey
        WHERE n_name <> 'NATION_24' AND product IN ('ECONOMY', 'SMALL') AND NOT (year = 1997 AND flow = 'Export')
        GROUP BY 1, 2, 3"""),
)
def indicator_summary(spark, folder):
    """A wide indicator table with marked cells: one flow of 1997 is unusable."""
    cells = (
        flows(spark, folder).groupBy("year", "code", "flow", "product").agg(exact_sum("value").alias("v"))
        .withColumn("cell", F.when((F.col("year") == 1997) & (F.col("flow") == "Export"), F.lit("...")).otherwise(
            F.floor("v").cast("bigint").cast("string")))
    )
    named = _named(cells, spark, folder).select(
        F.lit("all").alias("reporter"), "partner", F.lit("All Products").alias("product_category"),
        F.col("flow").alias("indicator_type"), F.col("product").alias("indicator"), "year", "cell",
    )
    wide = widen(
        named, ["reporter", "partner", "product_category", "indicator_type", "indicator"], "year", year_span(spark, folder), "cell"
    )
    return domain.indicator_summary(wide, ["ECONOMY", "SMALL"], "All Products", "NATION_24")


_MONTH_NAMES = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()


def month_tables(spark, folder):
    """Customer orders (imports) and non-urgent orders (exports) with one column per month."""
    months = [f"{y} {m}" for y in year_span(spark, folder) for m in _MONTH_NAMES]
    rows = orders(spark, folder)
    monthly = _named(
        rows.groupBy("buyer", F.date_format("o_orderdate", "yyyy MMM").alias("month_text")).agg(
            exact_sum("total").alias("imports"),
            exact_sum(F.when(F.col("o_orderpriority") != "1-URGENT", F.col("total"))).alias("exports"),
        ),
        spark, folder, "buyer", "country",
    ).withColumn("country", F.concat(F.lit("    "), "country"))
    monthly = materialise(monthly, "monthly")
    return (
        widen(monthly, ["country"], "month_text", months, "imports"),
        widen(monthly, ["country"], "month_text", months, "exports"),
    )


define("monthly", [], """
    SELECT n_name AS country, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
           sum(CAST(o_totalprice AS DECIMAL(18,4))) AS i,
           sum(CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_totalprice AS DECIMAL(18,4)) END) AS e
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3""")


@query(
    "yearly_totals",
    with_tables("monthly", body="""
        SELECT CASE country WHEN 'NATION_3' THEN 'Third Nation' ELSE country END AS country, year,
               CAST(sum(i) AS DOUBLE) AS imports, CAST(sum(e) AS DOUBLE) AS exports,
               CAST(sum(i + e) AS DOUBLE) AS trade_volume
        FROM monthly WHERE e IS NOT NULL AND year <= 2000 GROUP BY 1, 2"""),
)
def yearly_totals(spark, folder):
    imports, exports = month_tables(spark, folder)
    return domain.yearly_totals(imports, exports, None, 2000, {"NATION_3": "Third Nation"})
