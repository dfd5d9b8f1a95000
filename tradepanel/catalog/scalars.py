"""Scalar function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradepanel.catalog.concepts import HOME, gdp, nations, rates, table, trade, with_tables
from tradepanel.catalog.joins import _CURRENCY
from tradepanel.catalog.registry import query
from tradepanel.functions import scalars
from tradepanel.operators.features import log_columns
from tradepanel.operators.joins import spine
from tradepanel.plans import dashboard, domain
from tradepanel.session import materialise


@query(
    "log_features",
    with_tables("trade", body="""
        SELECT year, partner, hs_code, product,
               CASE WHEN imports IS NOT NULL THEN round(ln(greatest(imports - 20000, 1.0)), 8) END AS log_imports,
               CASE WHEN exports IS NOT NULL THEN round(ln(greatest(exports, 1.0)), 8) END AS log_exports,
               round(ln(1 + exports), 8) AS log1p_exports, round(log10(exports), 8) AS log10_exports
        FROM trade"""),
)
def log_features(spark, folder):
    """Floored logs; imports are lowered so that the floor applies to some rows."""
    rows = trade(spark, folder).withColumn("imports", F.col("imports") - 20000)
    logged = log_columns(rows, ["imports", "exports"]).withColumns(
        {"log1p_exports": scalars.log1p("exports"), "log10_exports": scalars.log10("exports")}
    )
    names = ["log_imports", "log_exports", "log1p_exports", "log10_exports"]
    return logged.select("year", "partner", "hs_code", "product", *[F.round(n, 8).alias(n) for n in names])


@query(
    "clip_bounds",
    """SELECT o_orderkey, CASE WHEN v IS NOT NULL THEN greatest(v, 50000.0) END AS low,
              CASE WHEN v IS NOT NULL THEN least(greatest(v, 50000.0), 250000.0) END AS both
       FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS v FROM orders)""",
)
def clip_bounds(spark, folder):
    value = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return table(spark, folder, "orders").select(
        "o_orderkey", scalars.clip(value, 50000.0).alias("low"), scalars.clip(value, 50000.0, 250000.0).alias("both")
    )


@query(
    "hs_section",
    """SELECT p_partkey, CASE WHEN p_size = 1 THEN '00'
              ELSE lpad(replace(p_brand, 'Brand#', ''), 2, '0') END AS section
       FROM part""",
)
def hs_section(spark, folder):
    """Codes arrive as float text ('9.0'); one size stands for a missing code."""
    text = F.concat(F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")), F.lit(".0"))
    code = F.when(F.col("p_size") != 1, text)
    return table(spark, folder, "part").select("p_partkey", scalars.code_section(code).alias("section"))


@query(
    "month_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month FROM orders
       WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderkey, NULL, NULL FROM orders WHERE o_orderstatus = 'P'""",
)
def month_parts(spark, folder):
    """Padded month text back to year and month; unreadable text gives nulls."""
    text = F.concat(F.lit("  "), F.date_format("o_orderdate", "yyyy MMM"), F.lit(" "))
    rows = table(spark, folder, "orders").withColumn(
        "month_text", F.when(F.col("o_orderstatus") == "P", F.lit("n.a.")).otherwise(text)
    )
    month = scalars.month_of_text("month_text")
    return rows.select("o_orderkey", F.year(month).alias("year"), F.month(month).alias("month"))


@query(
    "pct_delta",
    with_tables("gdp", body="""
        SELECT partner, year, (gdp - prev) / nullif(prev, 0) * 100 AS gdp_pct FROM (
            SELECT partner, year, gdp, lag(gdp) OVER (PARTITION BY partner ORDER BY year) AS prev FROM gdp)"""),
)
def pct_delta(spark, folder):
    from tradepanel.operators.windows import entity_lag

    rows = entity_lag(gdp(spark, folder), "partner", "gdp", "prev")
    return rows.select("partner", "year", scalars.percent_change("gdp", "prev").alias("gdp_pct"))


_GRID = "(SELECT n_name AS country, CAST(y AS INT) AS year FROM nation CROSS JOIN (SELECT unnest(range(1994, 2003)) AS y))"


@query(
    "value_text",
    with_tables("rates", "gdp", body=f"""
        SELECT k.country, k.year,
               coalesce(format('{{:,.2f}}', round_even(r.rate / h.rate, 2)) || ' ' ||
                   CASE WHEN CAST(replace(k.country, 'NATION_', '') AS INT) < 20 THEN replace(k.country, 'NATION_', 'CU') END
                   || ' per CU0',
                   'Exchange rate data not available for ' || k.country || ' in ' || CAST(k.year AS VARCHAR)) AS rate_text,
               coalesce('{HOME} GDP in ' || CAST(k.year AS VARCHAR) || ': ' || format('{{:,.2f}}', hg.gdp / 1e9) || 'B USD<br>'
                   || k.country || ' GDP in ' || CAST(k.year AS VARCHAR) || ': ' || format('{{:,.2f}}', g.gdp / 1e9) || 'B USD',
                   'GDP data not available for ' || k.country || ' in ' || CAST(k.year AS VARCHAR)) AS gdp_text
        FROM {_GRID} k
        LEFT JOIN rates r ON r.partner = k.country AND r.year = k.year
        LEFT JOIN rates h ON h.partner = '{HOME}' AND h.year = k.year
        LEFT JOIN gdp g ON g.partner = k.country AND g.year = k.year
        LEFT JOIN gdp hg ON hg.partner = '{HOME}' AND hg.year = k.year"""),
)
def value_text(spark, folder):
    """Rate and output sentences for every country and asked-for year."""
    grid = spine(nations(spark, folder).select(F.col("name").alias("country")), list(range(1994, 2003)))
    local = materialise(rates(spark, folder).withColumnRenamed("partner", "country"), "rates")
    crossed = domain.cross_rate(local, HOME, _CURRENCY, 1990)
    outputs = materialise(gdp(spark, folder).withColumnRenamed("partner", "country"), "gdp")
    return dashboard.rate_sentences(grid, crossed, "CU0").join(
        dashboard.output_sentences(grid, outputs, HOME), ["country", "year"]
    )


@query(
    "null_totals",
    with_tables("trade", body="""
        SELECT year, partner, hs_code, product, imports + exports AS strict_total,
               coalesce(imports, 0) + coalesce(exports, 0) AS filled_total FROM trade"""),
)
def null_totals(spark, folder):
    """Totals with a missing side: null, or that side as 0."""
    return trade(spark, folder).select(
        "year", "partner", "hs_code", "product", scalars.add_strict("imports", "exports").alias("strict_total"),
        scalars.add_zero_fill("imports", "exports").alias("filled_total"),
    )
