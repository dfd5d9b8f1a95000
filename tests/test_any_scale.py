"""Sums of terms of any scale."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tradepanel.functions.scalars import exact_sum
from tradepanel.operators import aggregates


def total(spark, values, parts=3):
    rows = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
    return rows.agg(exact_sum("v", None).alias("s")).first()["s"]


def test_small_terms_are_kept(spark):
    assert total(spark, [0.00003] * 1000) == math.fsum([0.00003] * 1000) == pytest.approx(0.03, abs=1e-17)
    assert total(spark, [1e-6, 1e9, -1e9, 1e-6]) == 2e-6


def test_same_bits_in_any_order(spark):
    rng = random.Random(5)
    values = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-6, 13) for _ in range(3000)]
    sums = set()
    for parts in (1, 3, 7):
        rng.shuffle(values)
        sums.add(total(spark, values, parts))
    assert len(sums) == 1 and sums.pop() == pytest.approx(math.fsum(values), rel=1e-15)


def test_odd_terms(spark):
    assert total(spark, [1e300, 1.0]) == 1e300
    assert total(spark, [1e300, -1e300, 2.5, None]) == 2.5
    assert math.isnan(total(spark, [1.0, float("nan")])) and total(spark, [1.0, float("inf")]) == float("inf")
    assert total(spark, [None, None]) is None and total(spark, []) is None
    assert total(spark, [5e-324, 1e-300]) == 1e-300


def test_group_sums_of_any_scale(spark):
    df = spark.createDataFrame([("a", 3e-5)] * 1000 + [("b", 0.1)] * 10 + [(None, 1.0)], "k string, v double")
    got = {r["k"]: r["v"] for r in aggregates.group_sums(df, ["k"], ["v"], digits=None).collect()}
    assert got == {"a": math.fsum([3e-5] * 1000), "b": math.fsum([0.1] * 10)}
    assert aggregates.with_subtotals(df.dropna(), [], {"k": "all"}, ["v"], digits=None).where("k = 'all'").first()["v"] == math.fsum([3e-5] * 1000 + [0.1] * 10)
    share = aggregates.share_of_total(df.dropna(), F.col("k") == "a", "v", digits=None).first()
    assert share["chosen_total"] == math.fsum([3e-5] * 1000)
