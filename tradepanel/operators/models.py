"""Regression models as saved Spark pipelines.

Every model is a ``PipelineModel`` of a fitted scaling step, a vector assembler and an
estimator, so the same object can be evaluated, stored, loaded and rolled forward.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepanel.operators.features import moments

PREDICTION = "prediction"
_FEATURES = "_features"


def scaling_step(df: DataFrame, columns: Sequence[str]) -> SQLTransformer:
    """Scaling by population deviation with the fitted constants written into the step."""
    parts = [
        f"(CAST({c} AS DOUBLE) - CAST('{mean!r}' AS DOUBLE)) / CAST('{dev!r}' AS DOUBLE) AS {c}_z"
        for c, (mean, dev) in moments(df, columns).items()
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def _ridge_reg(df: DataFrame, label: str, alpha: float) -> float:
    """Penalty on Spark's scale that equals ``alpha`` on the sum-of-squares scale."""
    row = df.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    return alpha * row["s"] / row["n"]


def estimator(kind: str, df: DataFrame, label: str, **params):
    """Untrained estimator for ``ols``, ``ridge``, ``lasso``, ``forest`` or ``boost``."""
    common = {"featuresCol": _FEATURES, "labelCol": label, "predictionCol": PREDICTION}
    if kind == "ols":
        return LinearRegression(solver="normal", regParam=0.0, **common)
    if kind == "ridge":
        reg = _ridge_reg(df, label, params.get("alpha", 1.0))
        return LinearRegression(
            solver="normal", elasticNetParam=0.0, standardization=False, regParam=reg, **common
        )
    if kind == "lasso":
        return LinearRegression(
            elasticNetParam=1.0, standardization=False, regParam=params.get("alpha", 1.0),
            maxIter=1000, tol=1e-9, **common
        )
    if kind == "forest":
        return RandomForestRegressor(
            numTrees=params.get("trees", 100), maxDepth=params.get("depth", 5),
            minInstancesPerNode=max(1, params.get("min_rows", 2) // 2),
            maxBins=params.get("bins", 32), featureSubsetStrategy="all", seed=42, cacheNodeIds=params.get("node_ids", False), **common
        )
    if kind == "boost":
        return GBTRegressor(
            maxIter=params.get("trees", 100), maxDepth=params.get("depth", 3),
            stepSize=params.get("rate", 0.1), subsamplingRate=params.get("subsample", 1.0),
            featureSubsetStrategy=str(params.get("columns", "all")), maxBins=params.get("bins", 32), seed=42, **common
        )
    raise ValueError(f"unknown model kind {kind!r}")


def fit(
    df: DataFrame, features: Sequence[str], label: str, kind: str = "ols", scale: bool = True,
    categories: Sequence[str] = (), **params
) -> PipelineModel:
    """Fit one model; ``categories`` are indexed, all other features scaled."""
    stages: list = []
    inputs = list(features)
    if scale:
        step = scaling_step(df, inputs)
        stages.append(step)
        inputs = [f"{c}_z" for c in inputs]
    for c in categories:
        indexer = StringIndexer(
            inputCol=c, outputCol=f"{c}_i", stringOrderType="alphabetAsc", handleInvalid="keep"
        ).fit(df)
        stages.append(indexer)
        inputs.append(f"{c}_i")
        # A tree needs a bin for each level, the one for unknown levels included.
        params["bins"] = max(params.get("bins", 32), len(indexer.labels) + 1)
    stages.append(VectorAssembler(inputCols=inputs, outputCol=_FEATURES, handleInvalid="keep"))
    prepared = df
    for stage in stages[:-1]:
        prepared = stage.transform(prepared)
    # Only complete rows train; prediction keeps the others, without a value.
    prepared = stages[-1].transform(prepared.dropna(subset=inputs))
    prepared = prepared.select(_FEATURES, F.col(label).cast("double").alias(label))
    stages.append(estimator(kind, prepared, label, **params).fit(prepared))
    return PipelineModel(stages=stages)


def predict(model: PipelineModel, df: DataFrame, out: str = PREDICTION) -> DataFrame:
    """Add the prediction and nothing else; a row with a missing feature stays, with a null prediction."""
    scored = model.transform(df)
    complete = F.lit(True)
    for c in [c for s in getattr(model, "stages", []) if isinstance(s, VectorAssembler) for c in s.getInputCols()]:
        complete = complete & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return scored.select(*df.columns, F.when(complete, F.col(PREDICTION)).alias(out))


def feature_names(model: PipelineModel) -> list[str]:
    """Ordered inputs of the assembler, without the marks of the steps before it."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    return [c.removesuffix("_z").removesuffix("_i") for c in assembler.getInputCols()]


def coefficients(model: PipelineModel) -> dict[str, float]:
    """Coefficients of a linear model on its (scaled) inputs, with the intercept."""
    last = model.stages[-1]
    table = dict(zip(feature_names(model), map(float, last.coefficients)))
    table["(intercept)"] = float(last.intercept)
    return table


def importances(model: PipelineModel) -> dict[str, float]:
    """Tree importances, else absolute coefficients."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        return dict(zip(feature_names(model), map(float, last.featureImportances.toArray())))
    return {f: abs(c) for f, c in coefficients(model).items() if f != "(intercept)"}


def ranked_features(spark: SparkSession, model: PipelineModel, count: int = 15) -> DataFrame:
    """Features by falling importance, as a small frame."""
    rows = [(f, v) for f, v in importances(model).items()]
    return (
        spark.createDataFrame(rows, "feature string, importance double")
        .orderBy(F.col("importance").desc(), "feature")
        .limit(count)
    )


def coefficient_frame(spark: SparkSession, table: dict[str, float]) -> DataFrame:
    return spark.createDataFrame(list(table.items()), "feature string, coefficient double")


def gram_terms(features: Sequence[str], label: str) -> dict[str, tuple[str | None, str | None]]:
    """Names of the cross-product sums that determine every linear fit."""
    columns = [None, *features, label]
    return {
        f"{a or 'one'}__{b or 'one'}": (a, b) for i, a in enumerate(columns) for b in columns[i:]
    }


def gram(df: DataFrame, features: Sequence[str], label: str, by: Sequence[str] = ()) -> DataFrame:
    """Sums of all pairwise products of (1, features, label), per group, in one pass."""

    def product(a: str | None, b: str | None):
        left = F.col(a).cast("double") if a else F.lit(1.0)
        right = F.col(b).cast("double") if b else F.lit(1.0)
        return left * right

    return df.groupBy(*by).agg(
        *[F.sum(product(a, b)).alias(n) for n, (a, b) in gram_terms(features, label).items()]
    )


def information_criteria(sse, rows, params: int):
    """AIC and BIC under a unit-variance likelihood, constants left out."""
    return F.lit(2.0 * params) + sse, F.lit(float(params)) * F.ln(rows) + sse
