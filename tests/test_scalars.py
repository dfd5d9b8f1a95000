import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradepanel.functions import scalars as s
from tradepanel.functions.pairs import canonical_pair, counterparty, pair_text, parse_pair


def one(spark, column, **values):
    types = {float: "double", int: "bigint", str: "string", type(None): "double"}
    schema = ", ".join(f"{k} {types[type(v)]}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("x, want", [(math.e, 1.0), (0.0, 0.0), (-5.0, 0.0), (None, None)])
def test_log_floor(spark, x, want):
    got = one(spark, s.log_floor("x"), x=x)
    assert got is None if want is None else got == pytest.approx(want)


@pytest.mark.parametrize("x, want", [(0.5, 1.0), (5.0, 3.0), (2.0, 2.0), (None, None)])
def test_clip(spark, x, want):
    assert one(spark, s.clip("x", 1.0, 3.0), x=x) == want


@pytest.mark.parametrize("x, digits, want", [(0.125, 2, 0.12), (2.5, 0, 2.0), (3.5, 0, 4.0), (-0.125, 2, -0.12)])
def test_round_even(spark, x, digits, want):
    assert one(spark, s.round_even("x", digits), x=x) == want


@pytest.mark.parametrize(
    "x, want", [("9", "09"), ("90", "90"), ("9.0", "09"), (None, "00"), ("8471", "84"), ("n.a.", "00")]
)
def test_code_section(spark, x, want):
    df = spark.createDataFrame([(x,)], "x string")
    assert df.select(s.code_section("x").alias("r")).first()["r"] == want


def test_ratio_and_percent_of_zero_are_null(spark):
    assert one(spark, s.ratio("a", "b"), a=1.0, b=0.0) is None
    assert one(spark, s.percent_change("a", "b"), a=1.0, b=0.0) is None
    assert one(spark, s.percent_change("a", "b"), a=3.0, b=2.0) == 50.0


def test_totals_with_a_missing_side(spark):
    assert one(spark, s.add_strict("a", "b"), a=1.0, b=None) is None
    assert one(spark, s.add_zero_fill("a", "b"), a=1.0, b=None) == 1.0


def test_differs_counts_null_as_different(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "x string")
    assert {r["x"] for r in df.where(s.differs("x", "a")).collect()} == {None, "b"}


@pytest.mark.parametrize("text, want", [(" 2013 Jan ", (2013, 1)), ("2024 Dec", (2024, 12)), ("n.a.", (None, None))])
def test_month_of_text(spark, text, want):
    df = spark.createDataFrame([(text,)], "x string")
    row = df.select(F.year(s.month_of_text("x")).alias("y"), F.month(s.month_of_text("x")).alias("m")).first()
    assert (row["y"], row["m"]) == want


def test_exact_sum_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e9 + 0.01, -1e9, 12345.6789] * 50
    schema = "x double"
    forward = spark.createDataFrame([(v,) for v in values], schema).repartition(7)
    backward = spark.createDataFrame([(v,) for v in reversed(values)], schema).repartition(3)
    a, b = (df.agg(s.exact_sum("x").alias("r")).first()["r"] for df in (forward, backward))
    assert a == b == float(sum(Decimal(str(v)) for v in values))


def test_exact_sum_beyond_one_long(spark):
    """The total in units of 10**-4 would not fit a 64-bit number."""
    df = spark.range(100).select(F.lit(9e14).alias("x"))
    assert df.agg(s.exact_sum("x").alias("r")).first()["r"] == 9e16


def test_exact_sum_of_nulls(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    row = df.agg(s.exact_sum("x").alias("a"), s.zero_sum("x").alias("b"), s.mean_of("x").alias("c")).first()
    assert tuple(row) == (None, 0.0, None)


def test_sentences(spark):
    df = spark.createDataFrame([("Japan", 2020, 81.5, "JPY"), ("Mars", 2020, None, None)], "c string, y int, r double, u string")
    got = [r[0] for r in df.select(s.rate_text("r", "u", "c", "y", "SGD")).collect()]
    assert got == ["81.50 JPY per SGD", "Exchange rate data not available for Mars in 2020"]
    assert one(spark, s.billions_text("x"), x=12.34e9) == "12.34B"
    assert one(spark, s.billions_text("x"), x=21e12) == "21,000.00B"


def test_pairs(spark):
    df = spark.createDataFrame(
        [("Japan", "China"), ("China", "Japan"), ("Home", "Korea"), ("Korea", "Home")], "a string, b string"
    )
    rows = df.select(canonical_pair("a", "b").alias("p"), counterparty("a", "b", "Home").alias("o")).collect()
    assert rows[0]["p"] == rows[1]["p"] == ["China", "Japan"]
    assert rows[2]["o"] == rows[3]["o"] == "Korea"


def test_pair_text_round_trip_and_apostrophe(spark):
    texts = ["('China', 'Japan')", "(\"Cote d'Ivoire\", 'Japan')"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_pair("t").alias("p"))
    assert [r["p"] for r in df.collect()] == [["China", "Japan"], ["Cote d'Ivoire", "Japan"]]
    back = df.limit(1).select(pair_text("p").alias("t")).first()["t"]
    assert back == texts[0]
