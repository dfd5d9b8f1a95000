"""The table behind each dashboard chart."""

from __future__ import annotations

from tradepanel.catalog.concepts import LAST_HISTORY, trade, with_tables
from tradepanel.catalog.domain import month_tables, scores
from tradepanel.catalog.registry import query
from tradepanel.plans import dashboard, domain
from tradepanel.session import materialise


@query(
    "dash_bubble",
    with_tables("trade", "scores", body="""
        SELECT t.partner, t.year, t.hs_code, t.product, t.imports, t.exports, s.geo_distance_score
        FROM trade t LEFT JOIN scores s ON s.partner = t.partner AND s.year = t.year
        WHERE t.product = 'ECONOMY' AND t.year = 1999 AND t.partner <> 'NATION_3'"""),
)
def dash_bubble(spark, folder):
    rows = trade(spark, folder).drop("trade_volume")
    return dashboard.bubble(rows, scores(spark, folder), "ECONOMY", 1999, excluded="NATION_3")


@query(
    "dash_rank",
    with_tables("scores", body="""
        SELECT partner, year, geo_distance_score, min(geo_distance_score) OVER () - 10 AS axis_low,
               max(geo_distance_score) OVER () AS axis_high
        FROM scores WHERE year = 2000 AND geo_distance_score IS NOT NULL"""),
)
def dash_rank(spark, folder):
    return dashboard.rank(materialise(scores(spark, folder), "scores"), 2000)


@query(
    "dash_series",
    with_tables("trade", body=f"""
        SELECT year, partner, hs_code, product, imports, exports, segment
        FROM trade CROSS JOIN (SELECT unnest(['history', 'forecast']) AS segment)
        WHERE partner = 'NATION_5' AND product = 'SMALL'
          AND CASE segment WHEN 'history' THEN year <= {LAST_HISTORY} ELSE year >= {LAST_HISTORY} END"""),
)
def dash_series(spark, folder):
    return dashboard.series(trade(spark, folder).drop("trade_volume"), "NATION_5", "SMALL", LAST_HISTORY)


@query("dash_trend", with_tables("scores", body="SELECT * FROM scores WHERE partner = 'NATION_9'"))
def dash_trend(spark, folder):
    return dashboard.trend(scores(spark, folder), "NATION_9")


@query(
    "dash_yearly",
    with_tables("trade", body="""
        SELECT partner, year, CAST(sum(CAST(imports AS DECIMAL(18,4))) AS DOUBLE) AS imports,
               CAST(sum(CAST(exports AS DECIMAL(18,4))) AS DOUBLE) AS exports,
               CAST(year = 1998 AS INT) AS is_marked, CAST(year = 1997 AS INT) AS is_agreement_line,
               'agreement since 1997' AS note
        FROM trade WHERE partner = 'NATION_4' AND year BETWEEN 1996 AND 2000 GROUP BY 1, 2"""),
)
def dash_yearly(spark, folder):
    return dashboard.yearly(
        trade(spark, folder), "NATION_4", 1998, 1996, 2000,
        {"NATION_4": "agreement since 1997", "NATION_8": "agreement only in 1999"}, {"NATION_4": 1997, "NATION_8": 1999},
    )


@query(
    "dash_monthly",
    with_tables("monthly", body="""
        SELECT country AS partner, year, month, CAST(i AS DOUBLE) AS imports, CAST(e AS DOUBLE) AS exports
        FROM monthly WHERE country = 'NATION_6' AND year = 1999 AND e IS NOT NULL"""),
)
def dash_monthly(spark, folder):
    imports, exports = month_tables(spark, folder)
    months = domain.yearly_totals(imports, exports, None, 2001, by_month=True)
    return dashboard.monthly(
        months.withColumnRenamed("country", "partner").drop("trade_volume"), "NATION_6", 1999
    )
