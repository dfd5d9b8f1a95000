"""From panel to evaluated, chosen and stored model."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepanel.functions.scalars import code_section
from tradepanel.operators import features, models, validation
from tradepanel.operators.windows import add_lags, growth
from tradepanel.session import materialise

SERIES = ["partner", "hs_code", "product"]
KEY = ["year", *SERIES]


def feature_columns(
    value: str = "imports", log: bool = True, lags: Sequence[int] = (1,), interactions: bool = False,
    rate_change: bool = False,
) -> list[str]:
    """Names of the model inputs, on log or raw scale."""
    mark = "log_" if log else ""
    names = ["year"] if log else []
    names += [f"{mark}{value}_lag{k}" for k in lags]
    names += ["distance", f"{mark}gdp_lag1", f"{mark}home_gdp_lag1", "rate", "adjusted_value"]
    if rate_change:
        names.append("rate_change")
    if interactions:
        names += ["gdp_x_agreement", "gdp_x_distance"]
    return names


def model_frame(
    panel: DataFrame, value: str = "imports", log: bool = True, sections: Sequence[str] = (),
    lags: Sequence[int] = (1, 2, 3),
) -> DataFrame:
    """Complete panel rows with lags, growth, interactions, section flags and logs.

    The target is ``log_<value>`` or the raw value. Rate growth is taken on one row per
    partner and year, before it meets the product rows. The panel is read twice, so it is
    written first.
    """
    panel = materialise(panel, "panel")
    yearly = panel.groupBy("partner", "year").agg(F.max("rate").alias("rate"))
    changes = growth(yearly, ["partner"], "rate", "rate_change").drop("rate")
    rows = add_lags(panel, SERIES, [value], lags).join(changes, ["partner", "year"])
    rows = features.interact(
        rows, {"gdp_x_agreement": ("gdp", "adjusted_value"), "gdp_x_distance": ("gdp", "distance")}
    ).dropna()
    if sections:
        rows = features.level_flags(
            rows.withColumn("section", code_section("hs_code")), "section", sections, "section"
        ).drop("section")
    if log:
        rows = features.log_columns(
            rows, [value, *[f"{value}_lag{k}" for k in lags], "gdp_lag1", "home_gdp_lag1"]
        )
    return rows


def compare_models(
    folded: DataFrame, inputs: Sequence[str], label: str, candidates: dict[str, tuple[str, dict]],
    folds: Sequence[int] = (1, 2, 3, 4, 5),
) -> DataFrame:
    """Mean fold metrics per candidate model, scored in one aggregation over all predictions.

    The fits of all candidates and folds run side by side, boosted trees first, as their many small jobs take longest.
    """
    ordered = sorted(candidates.items(), key=lambda c: c[1][0] != "boost")
    tries = [(name, kind, params, k) for name, (kind, params) in ordered for k in folds]

    def one(at: tuple) -> DataFrame:
        name, kind, params, k = at
        scored, _ = validation.fold_predictions(folded, inputs, label, kind, [k], **params)
        return scored.select(F.lit(name).alias("model"), validation.FOLD, label, models.PREDICTION)

    parts = validation._side_by_side(one, tries, validation.SMALL_FITS)
    scored = reduce(DataFrame.unionByName, parts)
    per_fold = validation.fold_metrics(
        scored, label, models.PREDICTION, len(inputs) + 1, ["model", validation.FOLD]
    )
    return validation.average_metrics(per_fold, ["model"])


def train(
    panel: DataFrame, value: str, candidates: dict[str, tuple[str, dict]], inputs: Sequence[str] | None = None
) -> tuple[PipelineModel, DataFrame]:
    """Compare candidates on expanding time folds and fit the best by R2 on all rows.

    Returns the fitted pipeline and the comparison table.
    """
    inputs = list(inputs or feature_columns(value))
    label = f"log_{value}"
    rows = materialise(model_frame(panel, value).select(*KEY, *[c for c in inputs if c not in KEY], label), "model")
    folded = materialise(validation.expanding_folds(rows, KEY), "folded")
    summary = materialise(compare_models(folded, inputs, label, candidates), "summary")
    best = summary.orderBy(F.col("r2").desc(), "model").first()["model"]
    kind, params = candidates[best]
    return models.fit(rows, inputs, label, kind, **params), summary
