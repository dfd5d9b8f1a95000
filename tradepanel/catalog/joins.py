"""Join, lookup and spine queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradepanel.catalog.concepts import (
    HOME, flows, gdp, nations, orders, pair_means, panel, rates, table, trade, with_tables,
)
from tradepanel.catalog.registry import query
from tradepanel.functions.scalars import clean_text, exact_sum
from tradepanel.operators import joins
from tradepanel.plans import domain
from tradepanel.session import materialise


@query(
    "inner_dim",
    """SELECT s_suppkey, n_name AS country, r_name AS region FROM supplier
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def inner_dim(spark, folder):
    """Facts against a country dimension that arrives with repeated rows."""
    nation = table(spark, folder, "nation")
    repeated = nation.unionByName(nation.where(F.col("n_regionkey") == 0))
    dim = joins.unique_dimension(repeated, "n_nationkey").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, folder, "supplier")
        .join(dim, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.col("n_name").alias("country"), F.col("r_name").alias("region"))
    )


@query("panel_build", with_tables("panel", body="SELECT * FROM panel"))
def panel_build(spark, folder):
    return panel(spark, folder)


@query(
    "full_outer_flows",
    with_tables("flow_rows", body="""
        SELECT coalesce(i.year, e.year) AS year, coalesce(i.code, e.code) AS code, i.imports, e.exports
        FROM (SELECT year, code, CAST(sum(value) AS DOUBLE) AS imports FROM flow_rows
              WHERE flow = 'Import' AND hs_code < 13 GROUP BY 1, 2) i
        FULL JOIN (SELECT year, code, CAST(sum(value) AS DOUBLE) AS exports FROM flow_rows
                   WHERE flow = 'Export' AND hs_code >= 13 GROUP BY 1, 2) e
        ON i.year = e.year AND i.code = e.code"""),
)
def full_outer_flows(spark, folder):
    """Two separately aggregated sides (low codes in, high codes out) on one key."""
    wanted = F.when(F.col("flow") == "Import", F.col("hs_code") < 13).otherwise(F.col("hs_code") >= 13)
    sums = flows(spark, folder).where(wanted).groupBy("year", "code", "flow").agg(exact_sum("value").alias("total"))
    sums = materialise(sums, "flow-sums")

    def side(flow, name):
        return sums.where(F.col("flow") == flow).select("year", "code", F.col("total").alias(name))

    return joins.full_outer(side("Import", "imports"), side("Export", "exports"), ["year", "code"])


@query(
    "normalise_to_ref",
    with_tables("gdp", body=f"""
        SELECT g.partner, g.year, g.gdp, g.gdp / r.gdp AS gdp_normalized
        FROM gdp g JOIN gdp r ON r.year = g.year AND r.partner = '{HOME}'"""),
)
def normalise_to_ref(spark, folder):
    return domain.normalise_to_ref(materialise(gdp(spark, folder), "gdp"), "partner", HOME, "gdp")


_CURRENCY = {f"NATION_{i}": f"CU{i}" for i in range(20)}
_CURRENCY_SQL = f"CASE WHEN CAST(replace(r.partner, 'NATION_', '') AS INT) < 20 THEN replace(r.partner, 'NATION_', 'CU') END"


@query(
    "cross_rate",
    with_tables("rates", body=f"""
        SELECT r.partner AS country, r.year, round_even(r.rate / h.rate, 2) AS er, {_CURRENCY_SQL} AS currency
        FROM rates r LEFT JOIN rates h ON h.year = r.year AND h.partner = '{HOME}' WHERE r.year >= 1996"""),
)
def cross_rate(spark, folder):
    local = materialise(rates(spark, folder).withColumnRenamed("partner", "country"), "rates")
    return domain.cross_rate(local, HOME, _CURRENCY, 1996)


@query(
    "lookup_null",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Construction' WHEN 'MACHINERY' THEN 'Engines' END AS sector
       FROM customer""",
)
def lookup_null(spark, folder):
    names = {"BUILDING": "Construction", "MACHINERY": "Engines"}
    return table(spark, folder, "customer").select("c_custkey", joins.lookup("c_mktsegment", names).alias("sector"))


@query(
    "recode_keep",
    """SELECT p_partkey, CASE t WHEN 'ECONOMY' THEN 'Basic Goods' WHEN 'SMALL' THEN 'Small Goods' ELSE t END AS product,
              replace(p_name, ' ', '_') AS label
       FROM (SELECT *, trim('  ' || p_type || ' ') AS t FROM part)""",
)
def recode_keep(spark, folder):
    names = {"ECONOMY": "Basic Goods", "SMALL": "Small Goods"}
    padded = table(spark, folder, "part").withColumn("p_type", F.concat(F.lit("  "), "p_type", F.lit(" ")))
    return padded.select(
        "p_partkey", joins.recode(clean_text("p_type"), names).alias("product"),
        clean_text("p_name", {" ": "_"}).alias("label"),
    )


@query(
    "year_join",
    with_tables("order_rows", "home_gdp", body="""
        SELECT o_orderkey, o.year, home_gdp FROM order_rows o LEFT JOIN home_gdp h ON h.year = o.year"""),
)
def year_join(spark, folder):
    from tradepanel.catalog.concepts import home_gdp

    yearly = home_gdp(gdp(spark, folder)).drop("home_gdp_lag1")
    return joins.by_year(orders(spark, folder).select("o_orderkey", "year"), yearly)


@query(
    "score_grid",
    with_tables("home_pairs", body=f"""
        SELECT n_name AS partner, CAST(y AS INT) AS year,
               coalesce(CAST(CAST(floor(distance) AS BIGINT) AS VARCHAR), 'No data') AS score
        FROM nation CROSS JOIN (SELECT unnest(range(1994, 2003)) AS y)
        LEFT JOIN home_pairs ON partner = n_name AND year = y"""),
)
def score_grid(spark, folder):
    """Every country and asked-for year; gaps are marked in text."""
    grid = joins.spine(nations(spark, folder).select(F.col("name").alias("partner")), list(range(1994, 2003)))
    scores = domain.home_pairs(pair_means(spark, folder), HOME, 1994, 2002).select(
        "partner", "year", F.floor("distance").cast("bigint").alias("score")
    )
    return joins.fill_spine(grid, scores, ["partner", "year"], "score")


@query(
    "forecast_combine",
    with_tables("trade", body="""
        SELECT i.partner, i.hs_code, i.imports, e.exports, i.imports + e.exports AS trade_volume
        FROM (SELECT partner, hs_code, sum(CAST(imports AS DECIMAL(18,4)))::DOUBLE AS imports FROM trade
              WHERE year = 2000 AND imports IS NOT NULL GROUP BY 1, 2) i
        JOIN (SELECT partner, hs_code, sum(CAST(exports AS DECIMAL(18,4)))::DOUBLE AS exports FROM trade
              WHERE year = 2000 AND exports IS NOT NULL GROUP BY 1, 2) e
        ON i.partner = e.partner AND i.hs_code = e.hs_code"""),
)
def forecast_combine(spark, folder):
    """Two forecasts made separately, joined on partner and code."""
    from tradepanel.operators.aggregates import group_sums

    rows = materialise(trade(spark, folder).where(F.col("year") == 2000), "trade")
    imports = group_sums(rows.where(F.col("imports").isNotNull()), ["partner", "hs_code"], ["imports"])
    exports = group_sums(rows.where(F.col("exports").isNotNull()), ["partner", "hs_code"], ["exports"])
    return domain.combine_forecasts(imports, exports, ["partner", "hs_code"])
