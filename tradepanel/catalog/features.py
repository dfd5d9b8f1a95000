"""Feature-engineering queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradepanel.catalog.concepts import brand_code, define, panel, table, with_tables
from tradepanel.catalog.registry import query
from tradepanel.functions.scalars import code_section
from tradepanel.operators import categories, features
from tradepanel.plans import modelling
from tradepanel.session import materialise

_CODES = [3, 5, 7, 8, 11, 13, 17, 19, 22, 25]
_SECTION = "lpad(replace(p_brand, 'Brand#', ''), 2, '0')"


@query(
    "one_hot",
    "SELECT p_partkey, " + ", ".join(
        f"CAST({_SECTION} = '{i:02d}' AS INT) AS section_{i:02d}" for i in range(2, 26)
    ) + " FROM part",
)
def one_hot(spark, folder):
    rows = table(spark, folder, "part").select("p_partkey", code_section(brand_code()).alias("section"))
    return features.one_hot(rows, "section").drop("section")


@query(
    "fixed_dummies",
    "SELECT p_partkey, " + ", ".join(f"CAST({_SECTION} = '{i:02d}' AS INT) AS hs_{i}" for i in _CODES) + " FROM part",
)
def fixed_dummies(spark, folder):
    rows = table(spark, folder, "part").select("p_partkey", brand_code().alias("code"))
    return features.level_flags(rows, "code", _CODES, "hs").drop("code")


_NUMBERED = """
    levels AS (
        SELECT 0 AS nth, 'l_partkey' AS category, l_partkey AS k FROM lineitem WHERE l_partkey IS NOT NULL
        UNION SELECT 1, 'l_suppkey', l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL),
    numbered AS (
        SELECT category, k, CASE WHEN row_number() OVER (PARTITION BY nth ORDER BY k) > 1
                                 THEN row_number() OVER (ORDER BY nth, k) - 2 - nth END AS position
        FROM levels)"""


@query("level_positions", f"WITH {_NUMBERED} SELECT category, CAST(k AS VARCHAR) AS level, position FROM numbered")
def level_positions(spark, folder):
    """The place of every level of two keys among the indicators."""
    return categories.level_positions(table(spark, folder, "lineitem"), ["l_partkey", "l_suppkey"])


@query(
    "sparse_indicators",
    f"""WITH {_NUMBERED}
        SELECT l_orderkey, l_linenumber, p.position AS l_partkey_position, s.position AS l_suppkey_position
        FROM lineitem LEFT JOIN (FROM numbered WHERE category = 'l_partkey') p ON l_partkey = p.k
        LEFT JOIN (FROM numbered WHERE category = 'l_suppkey') s ON l_suppkey = s.k""",
)
def sparse_indicators(spark, folder):
    """Each line's places of its ones: a sparse row of as many indicators as there are parts and suppliers."""
    keys = ["l_partkey", "l_suppkey"]
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *keys)
    placed = categories.with_positions(lines, keys, categories.level_positions(lines, keys), ["l_orderkey", "l_linenumber"])
    return placed.drop(*keys)


@query(
    "sparse_products",
    """WITH x AS (SELECT CAST(l_partkey AS VARCHAR) AS p, CAST(l_suppkey AS VARCHAR) AS s, l_quantity AS q, l_discount AS d FROM lineitem),
            e AS (
        SELECT 'one' AS "left", NULL AS left_level, 'one' AS "right", NULL AS right_level, count(*) AS product FROM x
        UNION ALL SELECT 'one', NULL, 'l_quantity', NULL, sum(q) FROM x
        UNION ALL SELECT 'one', NULL, 'l_discount', NULL, sum(d) FROM x
        UNION ALL SELECT 'l_quantity', NULL, 'l_quantity', NULL, sum(q * q) FROM x
        UNION ALL SELECT 'l_quantity', NULL, 'l_discount', NULL, sum(q * d) FROM x
        UNION ALL SELECT 'l_discount', NULL, 'l_discount', NULL, sum(d * d) FROM x
        UNION ALL SELECT 'one', NULL, 'l_partkey', p, count(*) FROM x GROUP BY p
        UNION ALL SELECT 'l_quantity', NULL, 'l_partkey', p, sum(q) FROM x GROUP BY p
        UNION ALL SELECT 'l_discount', NULL, 'l_partkey', p, sum(d) FROM x GROUP BY p
        UNION ALL SELECT 'l_partkey', p, 'l_partkey', p, count(*) FROM x GROUP BY p
        UNION ALL SELECT 'one', NULL, 'l_suppkey', s, count(*) FROM x GROUP BY s
        UNION ALL SELECT 'l_quantity', NULL, 'l_suppkey', s, sum(q) FROM x GROUP BY s
        UNION ALL SELECT 'l_discount', NULL, 'l_suppkey', s, sum(d) FROM x GROUP BY s
        UNION ALL SELECT 'l_suppkey', s, 'l_suppkey', s, count(*) FROM x GROUP BY s
        UNION ALL SELECT 'l_partkey', p, 'l_suppkey', s, count(*) FROM x GROUP BY p, s)
       SELECT "left", left_level, "right", right_level, round(CAST(product AS DOUBLE), 3) AS product FROM e""",
)
def sparse_products(spark, folder):
    """Cross products over quantity, discount and the indicators of all parts and suppliers."""
    found = categories.sparse_products(table(spark, folder, "lineitem"), ["l_quantity", "l_discount"], ["l_partkey", "l_suppkey"])
    return found.withColumn("product", F.round("product", 3))


_WITHIN = """
    x AS (SELECT l_partkey AS k, CAST(l_quantity AS DOUBLE) AS q, CAST(l_discount AS DOUBLE) AS d, ln(l_extendedprice) AS y FROM lineitem),
    m AS (SELECT k, avg(q) AS mq, avg(d) AS md, avg(y) AS my, count(*) AS n FROM x GROUP BY k),
    t AS (SELECT sum((q - mq) * (q - mq)) AS qq, sum((q - mq) * (d - md)) AS qd, sum((d - md) * (d - md)) AS dd,
                 sum((q - mq) * (y - my)) AS qy, sum((d - md) * (y - my)) AS dy FROM x JOIN m USING (k)),
    b AS (SELECT (dd * qy - qd * dy) / (qq * dd - qd * qd) AS bq, (qq * dy - qd * qy) / (qq * dd - qd * qd) AS bd FROM t)"""


def _price_fit(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", F.ln("l_extendedprice").alias("log_price")
    )
    return lines, *categories.absorbed_fit(lines, ["l_quantity", "l_discount"], "l_partkey", "log_price")


@query(
    "absorbed_effects",
    f"""WITH {_WITHIN}
        SELECT k AS l_partkey, round(my - bq * mq - bd * md, 6) AS effect, round(bq, 8) AS quantity_slope, round(bd, 6) AS discount_slope, n AS rows
        FROM m, b""",
)
def absorbed_effects(spark, folder):
    """Slopes of price on quantity and discount, and the effect of every part, as of one indicator a part."""
    _, slopes, effects = _price_fit(spark, folder)
    return effects.select(
        "l_partkey", F.round("effect", 6).alias("effect"), F.round(F.lit(slopes["l_quantity"]), 8).alias("quantity_slope"),
        F.round(F.lit(slopes["l_discount"]), 6).alias("discount_slope"), "rows",
    )


@query(
    "absorbed_predict",
    f"""WITH {_WITHIN}
        SELECT l_orderkey, l_linenumber, round(my - bq * mq - bd * md + bq * l_quantity + bd * l_discount, 6) AS prediction
        FROM lineitem JOIN m ON l_partkey = k, b""",
)
def absorbed_predict(spark, folder):
    lines, slopes, effects = _price_fit(spark, folder)
    scored = categories.absorbed_predict(lines, slopes, effects, "l_partkey", ["l_orderkey", "l_linenumber"])
    return scored.select("l_orderkey", "l_linenumber", F.round("prediction", 6).alias("prediction"))


@query(
    "interactions",
    with_tables("panel", body="""
        SELECT year, partner, hs_code, product, gdp * adjusted_value AS gdp_x_agreement, gdp * distance AS gdp_x_distance
        FROM panel"""),
)
def interactions(spark, folder):
    pairs = {"gdp_x_agreement": ("gdp", "adjusted_value"), "gdp_x_distance": ("gdp", "distance")}
    return features.interact(panel(spark, folder), pairs).select(
        "year", "partner", "hs_code", "product", *pairs
    )


@query(
    "poly2",
    """SELECT l_orderkey, l_linenumber, q, d, q * q AS q_x_q, q * d AS q_x_d, d * d AS d_x_d
       FROM (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_discount AS d FROM lineitem)""",
)
def poly2(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("q"), F.col("l_discount").alias("d")
    )
    return features.degree_two(rows, ["q", "d"])


@query(
    "standard_scale",
    """SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS o_totalprice_scaled
       FROM orders CROSS JOIN (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders)""",
)
def standard_scale(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    scaled = features.standardise(rows, ["o_totalprice"])
    return scaled.select("o_orderkey", F.round("o_totalprice_scaled", 6).alias("o_totalprice_scaled"))


FEATURES = modelling.feature_columns()
LABEL = "log_imports"
KEY = modelling.KEY

define("model_rows", ["panel"], """
    SELECT year, partner, hs_code, product, imports, distance / 1000 AS distance, rate, adjusted_value,
           ln(greatest(imports, 1.0)) AS log_imports, ln(greatest(imports_lag1, 1.0)) AS log_imports_lag1,
           ln(greatest(imports_lag2, 1.0)) AS log_imports_lag2, ln(greatest(imports_lag3, 1.0)) AS log_imports_lag3,
           ln(greatest(gdp_lag1, 1.0)) AS log_gdp_lag1, ln(greatest(home_gdp_lag1, 1.0)) AS log_home_gdp_lag1
    FROM (SELECT *, lag(imports, 1) OVER w AS imports_lag1, lag(imports, 2) OVER w AS imports_lag2,
                 lag(imports, 3) OVER w AS imports_lag3
          FROM panel WINDOW w AS (PARTITION BY partner, hs_code, product ORDER BY year))
    WHERE imports_lag3 IS NOT NULL AND gdp_lag1 IS NOT NULL AND home_gdp_lag1 IS NOT NULL
      AND rate IS NOT NULL AND adjusted_value IS NOT NULL""")


def model_rows(spark, folder):
    """The panel with lags and logs, complete rows only."""
    rows = modelling.model_frame(panel(spark, folder))
    return rows.withColumn("distance", F.col("distance") / 1000).select(
        *KEY, "imports", "distance", "rate", "adjusted_value", "log_imports", "log_imports_lag1", "log_imports_lag2",
        "log_imports_lag3", "log_gdp_lag1", "log_home_gdp_lag1",
    )


def written_model_rows(spark, folder):
    """Model rows written once, as every fit, fold and score reads them again."""
    return materialise(model_rows(spark, folder), "model-rows")


_LOGS = ["log_imports", "log_imports_lag1", "log_imports_lag2", "log_imports_lag3", "log_gdp_lag1", "log_home_gdp_lag1"]


@query(
    "model_features",
    with_tables("model_rows", body="SELECT * REPLACE (" + ", ".join(f"round({c}, 8) AS {c}" for c in _LOGS)
                + ") FROM model_rows"),
)
def model_features(spark, folder):
    return model_rows(spark, folder).withColumns({c: F.round(c, 8) for c in _LOGS})


_FLAGS = ["02", "13", "25"]


@query(
    "export_features",
    with_tables(
        "panel", "rates",
        changes="""
            SELECT partner, year, rate / lag(rate) OVER (PARTITION BY partner ORDER BY year) - 1 AS rate_change
            FROM (SELECT DISTINCT partner, year, rate FROM panel)""",
        body="""
            SELECT year, partner, hs_code, product, exports, exports_lag1, rate_change, gdp * adjusted_value AS gdp_x_agreement,
                   gdp * distance AS gdp_x_distance, """ + ", ".join(
            f"CAST(lpad(CAST(hs_code AS VARCHAR), 2, '0') = '{f}' AS INT) AS section_{f}" for f in _FLAGS) + """
            FROM (SELECT *, lag(exports, 1) OVER w AS exports_lag1, lag(exports, 2) OVER w AS exports_lag2,
                         lag(exports, 3) OVER w AS exports_lag3
                  FROM panel JOIN changes USING (partner, year)
                  WINDOW w AS (PARTITION BY partner, hs_code, product ORDER BY year))
            WHERE exports_lag3 IS NOT NULL AND gdp_lag1 IS NOT NULL AND home_gdp_lag1 IS NOT NULL AND rate IS NOT NULL
              AND rate_change IS NOT NULL AND adjusted_value IS NOT NULL AND exports IS NOT NULL""",
    ),
)
def export_features(spark, folder):
    """Export model inputs on the raw scale, with growth, interactions and section flags."""
    rows = modelling.model_frame(panel(spark, folder), "exports", log=False, sections=_FLAGS)
    return rows.select(
        *KEY, "exports", "exports_lag1", "rate_change", "gdp_x_agreement", "gdp_x_distance",
        *[f"section_{f}" for f in _FLAGS],
    )
