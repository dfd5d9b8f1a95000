"""Rows with missing features, many categories, and sums over odd numbers."""

import math

import pytest
from pyspark.sql import functions as F

from tradepanel.functions.scalars import exact_sum
from tradepanel.operators import joins, models


def test_prediction_keeps_rows_with_missing_features(spark):
    df = spark.range(60).select("id", F.when(F.col("id") % 6 != 0, F.col("id").cast("double")).alias("x"), (F.col("id") * 2.0 + 1).alias("y"))
    model = models.fit(df, ["x"], "y", "ols")
    rows = models.predict(model, df).collect()
    assert len(rows) == 60
    assert all((r["prediction"] is None) == (r["x"] is None) for r in rows)
    assert all(r["prediction"] == pytest.approx(r["y"]) for r in rows if r["x"] is not None)


def test_trees_take_a_hundred_levels(spark):
    df = spark.range(400).select((F.col("id") % 2).cast("double").alias("x"), F.concat(F.lit("c"), F.col("id") % 100).alias("c"), F.col("id").cast("double").alias("y"))
    model = models.fit(df, ["x"], "y", "forest", categories=["c"], trees=2)
    assert models.predict(model, df).where("prediction is not null").count() == 400


def test_sums_pass_odd_numbers_through(spark):
    total = lambda *values: spark.createDataFrame([(float(v),) for v in values], "v double").agg(exact_sum("v")).first()[0]
    assert math.isnan(total(1.5, float("nan")))
    assert total(1.5, float("inf")) == float("inf")
    assert total(1e21, 1.0) == pytest.approx(1e21)
    assert total(*[0.1] * 10) == 1.0


def test_year_join_forces_no_broadcast(spark):
    left, right = spark.createDataFrame([(2001, 1)], "year int, a int"), spark.createDataFrame([(2001, 5)], "year int, b int")
    assert joins.by_year(left, right).collect()[0]["b"] == 5
