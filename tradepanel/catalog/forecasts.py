"""Forecast queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradepanel.catalog.concepts import LAST_HISTORY, define, trade, with_tables
from tradepanel.catalog.features import FEATURES, LABEL, written_model_rows
from tradepanel.catalog.registry import query
from tradepanel.functions import fixed_values as fixed
from tradepanel.functions.fixed_values import ALL_PRODUCTS, ALL_PRODUCTS_CODE
from tradepanel.functions.scalars import exact_sum, log_floor
from tradepanel.operators import forecasting, models
from tradepanel.operators.joins import full_outer
from tradepanel.operators.windows import add_lags
from tradepanel.session import materialise

_SERIES = ["partner", "hs_code", "product"]
_LAGS = ["log_imports_lag1", "log_imports_lag2", "log_imports_lag3"]


# One feature, so that SQL can state the fit in closed form.
_X = ["log_imports_lag1"]
define("one_step_fit", ["model_rows"], f"""
    SELECT regr_slope(log_imports, log_imports_lag1) AS s, regr_intercept(log_imports, log_imports_lag1) AS i
    FROM model_rows WHERE year <= {LAST_HISTORY}""")
define("one_step", ["model_rows", "one_step_fit"], f"""
    SELECT partner, hs_code, product, {LAST_HISTORY + 1} AS target_year, imports AS latest_value,
           exp(i + s * ln(greatest(imports, 1.0))) AS raw_forecast
    FROM model_rows CROSS JOIN one_step_fit WHERE year = {LAST_HISTORY}""")


def _history(spark, folder):
    return written_model_rows(spark, folder).where(F.col("year") <= LAST_HISTORY)


def _one_step(spark, folder):
    rows = _history(spark, folder)
    model = models.fit(rows, _X, LABEL, "ols")
    return forecasting.forecast_one(rows, model, "imports", "log_imports_lag1", _SERIES, ["year"])


@query(
    "forecast_one",
    with_tables("one_step", body="SELECT * REPLACE (round(raw_forecast, 3) AS raw_forecast) FROM one_step"),
)
def forecast_one(spark, folder):
    return _one_step(spark, folder).withColumn("raw_forecast", F.round("raw_forecast", 3))


@query("forecast_all_features")
def forecast_all_features(spark, folder):
    """One-step forecast with every feature and boosted trees."""
    rows = _history(spark, folder)
    model = models.fit(rows, FEATURES, LABEL, "boost", scale=False, **fixed.BOOST_DEFAULT)
    return forecasting.forecast_one(rows, model, "imports", "log_imports_lag1", _SERIES, ["year"])


@query(
    "forecast_corrected",
    with_tables(
        "one_step",
        totals="SELECT partner, sum(latest_value) AS actual, sum(raw_forecast) AS predicted FROM one_step GROUP BY 1",
        line="""
            SELECT regr_slope(ln(actual) - ln(predicted), ln(predicted)) AS s,
                   regr_intercept(ln(actual) - ln(predicted), ln(predicted)) AS i FROM totals""",
        body="""
            SELECT partner, round(actual, 2) AS actual, round(exp(ln(predicted) + i + s * ln(predicted)), 2) AS corrected,
                   round((predicted - actual) / actual * 100, 5) AS change_raw_pct
            FROM totals CROSS JOIN line""",
    ),
)
def forecast_corrected(spark, folder):
    """One-step forecast, summed per partner and corrected in log space."""
    totals = _one_step(spark, folder).groupBy("partner").agg(
        exact_sum("latest_value").alias("actual"), F.sum("raw_forecast").alias("predicted")
    )
    out = forecasting.log_correction(totals, "actual", "predicted")
    return out.select(
        "partner", F.round("actual", 2).alias("actual"), F.round("corrected", 2).alias("corrected"),
        F.round("change_raw_pct", 5).alias("change_raw_pct"),
    )


define("model_roll", ["model_rows", "one_step_fit"], f"""
    SELECT partner, hs_code, product, f1, f2, exp(i + s * ln(f2)) AS f3 FROM (
        SELECT *, exp(i + s * ln(f1)) AS f2 FROM (
            SELECT partner, hs_code, product, i, s, exp(i + s * log_imports_lag1) AS f1
            FROM model_rows CROSS JOIN one_step_fit WHERE year = {LAST_HISTORY}))""")
_MODEL_ROLL = " UNION ALL ".join(
    f"SELECT partner, hs_code, product, {LAST_HISTORY + k} AS target_year, f{k} AS forecast FROM model_roll" for k in (1, 2, 3)
)


@query(
    "forecast_roll",
    with_tables("model_roll", body=f"""
        SELECT partner, target_year, product, hs_code, round(sum(forecast), 1) AS forecast FROM (
            SELECT * FROM ({_MODEL_ROLL})
            UNION ALL SELECT partner, {ALL_PRODUCTS_CODE}, '{ALL_PRODUCTS}', target_year, forecast FROM ({_MODEL_ROLL}))
        GROUP BY 1, 2, 3, 4"""),
)
def forecast_roll(spark, folder):
    """Three years ahead with the fitted model, plus a subtotal per partner and year."""
    rows = _history(spark, folder)
    model = models.fit(rows, _X, LABEL, "ols")
    ahead = forecasting.forecast_roll(
        rows, model, range(LAST_HISTORY + 1, LAST_HISTORY + 4), _LAGS, _SERIES, log_bounds=(0.0, 24.0),
        bounds=(1.0, 1e11),
    )
    totals = forecasting.forecast_totals(
        ahead, "partner", {"product": ALL_PRODUCTS, "hs_code": ALL_PRODUCTS_CODE}, "forecast"
    )
    return totals.withColumn("forecast", F.round("forecast", 1))


define("lagged_logs", ["trade"], f"""
    SELECT partner, hs_code, product, ln(greatest(exports, 1.0)) AS a, ln(greatest(e1, 1.0)) AS b, ln(greatest(e2, 1.0)) AS c
    FROM (SELECT *, lag(exports, 1) OVER w AS e1, lag(exports, 2) OVER w AS e2 FROM trade WHERE exports IS NOT NULL
          WINDOW w AS (PARTITION BY partner, hs_code, product ORDER BY year))
    WHERE year = {LAST_HISTORY} AND e2 IS NOT NULL""")

_STEP = "least(greatest(0.3 + 0.6 * {0} + 0.3 * {1} + 0.1 * {2}, 9.0), 11.5)"
define("roll_1", ["lagged_logs"], f"SELECT *, least(greatest(exp({_STEP.format('a', 'b', 'c')}), 10000.0), 90000.0) AS f1 FROM lagged_logs")
define("roll_2", ["roll_1"], f"SELECT *, least(greatest(exp({_STEP.format('ln(f1)', 'a', 'b')}), 10000.0), 90000.0) AS f2 FROM roll_1")
define("roll_3", ["roll_2"], f"SELECT *, least(greatest(exp({_STEP.format('ln(f2)', 'ln(f1)', 'a')}), 10000.0), 90000.0) AS f3 FROM roll_2")


def _rolled(spark, folder):
    """A fixed linear predictor on three log lags, rolled three years ahead within bounds."""
    rows = trade(spark, folder).where(F.col("exports").isNotNull()).select(*_SERIES, "year", "exports")
    lagged = add_lags(rows, _SERIES, ["exports"], [1, 2]).where(F.col("year") == LAST_HISTORY).dropna()
    latest = lagged.select(
        *_SERIES, "year", log_floor("exports").alias("l1"), log_floor("exports_lag1").alias("l2"),
        log_floor("exports_lag2").alias("l3"),
    )
    step = forecasting.linear_step(0.3, {"l1": 0.6, "l2": 0.3, "l3": 0.1})
    years = forecasting.check_years(LAST_HISTORY, [LAST_HISTORY + 1, LAST_HISTORY + 2, LAST_HISTORY + 3])
    return forecasting.roll(latest, years, step, ["l1", "l2", "l3"], _SERIES, (9.0, 11.5), (1e4, 9e4))


_ROLLED_SQL = " UNION ALL ".join(
    f"SELECT partner, hs_code, product, {LAST_HISTORY + k} AS target_year, f{k} AS forecast FROM roll_3" for k in (1, 2, 3)
)


@query(
    "roll_linear",
    with_tables("roll_3", body=f"SELECT * REPLACE (round(forecast, 4) AS forecast) FROM ({_ROLLED_SQL})"),
)
def roll_linear(spark, folder):
    return _rolled(spark, folder).withColumn("forecast", F.round("forecast", 4))


@query(
    "forecast_totals",
    with_tables("roll_3", body=f"""
        SELECT partner, target_year, product, hs_code, round(sum(forecast), 1) AS forecast FROM (
            SELECT partner, target_year, product, hs_code, forecast FROM ({_ROLLED_SQL})
            UNION ALL SELECT partner, target_year, '{ALL_PRODUCTS}', {ALL_PRODUCTS_CODE}, forecast FROM ({_ROLLED_SQL}))
        GROUP BY 1, 2, 3, 4"""),
)
def forecast_totals(spark, folder):
    totals = forecasting.forecast_totals(
        _rolled(spark, folder), "partner", {"product": ALL_PRODUCTS, "hs_code": ALL_PRODUCTS_CODE}, "forecast"
    )
    return totals.withColumn("forecast", F.round("forecast", 1))


define("both_totals", ["trade"], f"""
    SELECT coalesce(a.partner, p.partner) AS partner, a.actual, p.predicted
    FROM (SELECT partner, CAST(sum(CAST(imports AS DECIMAL(18,4))) AS DOUBLE) AS actual FROM trade
          WHERE year = {LAST_HISTORY} GROUP BY 1) a
    FULL JOIN (SELECT partner, CAST(sum(CAST(exports AS DECIMAL(18,4))) AS DOUBLE) AS predicted FROM trade
               WHERE year = {LAST_HISTORY} GROUP BY 1) p ON a.partner = p.partner""")


@query(
    "log_correction",
    with_tables("both_totals", body="""
        SELECT partner, actual, predicted, round(corrected, 3) AS corrected,
               round((predicted - actual) / actual * 100, 6) AS change_raw_pct,
               round((corrected - actual) / actual * 100, 6) AS change_corrected_pct
        FROM (SELECT partner, actual, predicted, exp(lp + icpt + slope * lp) AS corrected
              FROM (SELECT *, ln(greatest(predicted, 1.0)) AS lp FROM both_totals)
              CROSS JOIN (SELECT regr_slope(ln(actual) - ln(predicted), ln(predicted)) AS slope,
                                 regr_intercept(ln(actual) - ln(predicted), ln(predicted)) AS icpt FROM both_totals))"""),
)
def log_correction(spark, folder):
    """Exports of the last year stand for the prediction of its imports."""
    rows = materialise(trade(spark, folder).where(F.col("year") == LAST_HISTORY), "trade")
    actual = rows.groupBy("partner").agg(exact_sum("imports").alias("actual"))
    predicted = rows.groupBy("partner").agg(exact_sum("exports").alias("predicted"))
    out = forecasting.log_correction(full_outer(actual, predicted, ["partner"]), "actual", "predicted")
    return out.withColumns(
        {
            "corrected": F.round("corrected", 3),
            "change_raw_pct": F.round("change_raw_pct", 6),
            "change_corrected_pct": F.round("change_corrected_pct", 6),
        }
    )
