"""Forecasts from the latest year, rolled forward row by row.

A forecast row depends only on its own lags, so all target years are computed side by
side in one pass: each step adds columns to the row, and the steps become rows at the
end. Nothing is shuffled, looped over on the driver or recomputed between years.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradepanel.functions import fixed_values as fixed
from tradepanel.functions.scalars import clip, log_floor, percent_change
from tradepanel.operators import models
from tradepanel.operators.aggregates import first_by_key, latest_slice, with_subtotals
from tradepanel.session import materialise

TARGET_YEAR = "target_year"


def check_years(latest: int, years: Sequence[int]) -> list[int]:
    """Sorted target years; each must lie after the latest year of the data."""
    ordered = sorted(years)
    if not ordered or ordered[0] <= latest:
        raise ValueError(f"forecast years must start after {latest}, the latest year in the data")
    return ordered


def forecast_one(
    panel: DataFrame, model, value: str, lag_feature: str, key: Sequence[str], order: Sequence[str],
    out: str = "raw_forecast", year: str = "year",
) -> DataFrame:
    """Next-year value per key: the latest value becomes the lag, all else is held."""
    base = first_by_key(latest_slice(panel, year), key, order)
    ahead = base.withColumns(
        {"_actual": F.col(value), lag_feature: log_floor(value), year: F.col(year) + 1}
    )
    scored = models.predict(model, ahead, "_log")
    return scored.select(
        *key, F.col(year).alias(TARGET_YEAR), F.col("_actual").alias("latest_value"), F.exp("_log").alias(out)
    )


def roll(
    latest: DataFrame,
    years: Sequence[int],
    step: Callable[[DataFrame], DataFrame],
    lags: Sequence[str],
    keep: Sequence[str],
    log_bounds: tuple[float, float] | None = fixed.LOG_FORECAST_BOUNDS,
    bounds: tuple[float, float] | None = fixed.FORECAST_BOUNDS,
    year: str = "year",
) -> DataFrame:
    """Forecast several years; each prediction becomes the next year's first lag.

    ``step`` adds ``prediction`` (a log value) from the current columns. ``lags`` lists
    the log-lag columns, nearest first. Skipped years count as steps too only if listed,
    and the year feature takes each target year in turn; other features are held.
    """
    current = latest
    found = []
    for i, target in enumerate(years):
        current = step(current.withColumn(year, F.lit(target)))
        log_value = F.col(models.PREDICTION)
        if log_bounds:
            log_value = clip(log_value, *log_bounds)
        value = F.exp(log_value)
        if bounds:
            value = clip(value, *bounds)
        name = f"_forecast_{i}"
        found.append(F.struct(F.lit(target).alias(TARGET_YEAR), F.col(name).alias("forecast")))
        current = current.withColumn(name, value).drop(models.PREDICTION)
        shifted = {lag: F.col(before) for lag, before in zip(lags[1:], lags)}
        current = current.withColumns({**shifted, lags[0]: log_floor(name)})
    return current.select(*keep, F.explode(F.array(*found)).alias("_f")).select(*keep, "_f.*")


def model_step(model) -> Callable[[DataFrame], DataFrame]:
    return lambda df: models.predict(model, df)


def linear_step(intercept: float, weights: dict[str, float]) -> Callable[[DataFrame], DataFrame]:
    """A fixed linear predictor on the current columns."""

    def step(df: DataFrame) -> DataFrame:
        total = F.lit(float(intercept))
        for column, weight in weights.items():
            total = total + F.lit(float(weight)) * F.col(column)
        return df.withColumn(models.PREDICTION, total)

    return step


def forecast_roll(panel: DataFrame, model, years: Sequence[int], lags: Sequence[str], keep: Sequence[str],
                  year: str = "year", **limits) -> DataFrame:
    """Roll a fitted model forward from the latest year of the panel."""
    latest = panel.agg(F.max(year).alias("y")).first()["y"]
    targets = check_years(latest, years)
    return roll(panel.where(F.col(year) == latest), targets, model_step(model), lags, keep, year=year, **limits)


def forecast_totals(forecast: DataFrame, partner: str, labels: dict[str, object], value: str) -> DataFrame:
    """Forecast rows plus one all-products row per partner and target year."""
    return with_subtotals(forecast, [partner, TARGET_YEAR], labels, [value], digits=9)


def log_correction(totals: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Correct predictions by a line fitted to their log residuals.

    residual = ln(actual) - ln(predicted) is regressed on ln(predicted); the fitted
    residual is added back in log space. Both percentage changes are against ``actual``.
    """
    # one row per key, read for the fit and again for its use
    logs = materialise(totals, "totals").withColumns({"_log_a": log_floor(actual), "_log_p": log_floor(predicted)}).withColumn(
        "_gap", F.col("_log_a") - F.col("_log_p")
    )
    line = logs.agg(
        F.struct(
            F.regr_slope("_gap", "_log_p").alias("slope"), F.regr_intercept("_gap", "_log_p").alias("intercept")
        ).alias("line")
    ).scalar()
    fitted: Column = line.getField("intercept") + line.getField("slope") * F.col("_log_p")
    return (
        logs.withColumn("corrected", F.exp(F.col("_log_p") + fitted))
        .withColumns(
            {
                "change_raw_pct": percent_change(predicted, actual),
                "change_corrected_pct": percent_change("corrected", actual),
            }
        )
        .drop("_log_a", "_log_p", "_gap")
    )
