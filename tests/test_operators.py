import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradepanel.operators import aggregates, filters, joins, ordering, project, reshape, skew, windows


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


# --- global order --------------------------------------------------------------------------


def test_row_index_is_dense_and_ordered(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5003).alias("k")).repartition(11)
    got = rows(ordering.with_row_index(df, ["k"]), "row_index", "k")
    assert [i for i, _ in got] == list(range(5000))
    assert [k for _, k in got] == sorted(k for _, k in got)


@pytest.mark.parametrize("block", [3, 4, 10, 1000])
def test_shift_rows_across_block_cuts(spark, block):
    n = 53
    indexed = spark.range(n).select(F.col("id").alias("row_index"), (F.col("id") * 10).alias("v")).repartition(5)
    got = ordering.shift_rows(indexed, {"b1": ("v", 1), "b3": ("v", 3), "a2": ("v", -2)}, block=block)

    def at(i):
        return i * 10 if 0 <= i < n else None

    want = [(i, i * 10, at(i - 1), at(i - 3), at(i + 2)) for i in range(n)]
    found = sorted((tuple(r) for r in got.select("row_index", "v", "b1", "b3", "a2").collect()), key=lambda r: r[0])
    assert found == want


def test_shift_longer_than_block_is_refused(spark):
    indexed = spark.range(5).select(F.col("id").alias("row_index"))
    with pytest.raises(ValueError):
        ordering.shift_rows(indexed, {"x": ("row_index", 4)}, block=3)


def test_drop_leading_rows(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "k int").repartition(4)
    assert rows(ordering.drop_leading_rows(df, 3, ["k"])) == [(i,) for i in range(3, 10)]


def test_group_median_with_a_hot_group_ties_and_nulls(spark):
    data = [("hot", float(i % 40), float(i)) for i in range(3000)]
    data += [("tied", 5.0, 1.0)] * 1000 + [("even", 1.0, None), ("even", 4.0, None)]
    data += [("empty", None, None), (None, 1.0, 1.0)]
    df = spark.createDataFrame(data, "g string, a double, b double").repartition(9)
    got = {r["g"]: (r["a"], r["b"]) for r in ordering.group_median(df, ["g"], ["a", "b"]).collect()}
    hot = [x for x in data if x[0] == "hot"]
    assert got == {
        "hot": (statistics.median(x[1] for x in hot), statistics.median(x[2] for x in hot)),
        "tied": (5.0, 1.0),
        "even": (2.5, None),
    }


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-5, 5)), min_size=1, max_size=60))
def test_group_median_equals_statistics(spark, data):
    df = spark.createDataFrame([(g, float(v)) for g, v in data], "g int, v double")
    got = {r["g"]: r["v"] for r in ordering.group_median(df, ["g"], ["v"]).collect()}
    want = {g: statistics.median(v for h, v in data if h == g) for g in {g for g, _ in data}}
    assert got == want


# --- skew ----------------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_gives_the_plain_join(spark, how):
    facts = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("k")
    )
    dim = spark.range(400).select(F.col("id").alias("d"), (F.col("id") * 2).alias("v"))
    salted = skew.join_dimension(facts, dim, "k", "d", ["id"], how, large=0, salts=8)
    assert rows(salted.select("id", "k", F.coalesce("v", F.lit(-1)).alias("v"))) == rows(
        facts.join(dim, F.col("k") == F.col("d"), how).select("id", "k", F.coalesce("v", F.lit(-1)).alias("v"))
    )


def test_hot_key_is_spread_over_the_salts(spark):
    facts = spark.range(4000).select(F.col("id"), F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"))
    assert 1 in skew.frequent_keys(facts, "k", 0.1)
    dim = spark.range(4000).select(F.col("id").alias("d"))
    plan = skew.join_dimension(facts, dim, "k", "d", ["id"], large=0, salts=16)
    assert "_salt" in plan._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count() == 4000


def test_null_fact_keys_survive_a_salted_left_join(spark):
    facts = spark.createDataFrame([(1, None), (2, 5), (3, 5), (4, 5)], "id int, k int")
    dim = spark.createDataFrame([(5, "x")], "d int, v string")
    got = skew.join_dimension(facts, dim, "k", "d", ["id"], "left", large=0, salts=4)
    assert sorted((r["id"], r["v"]) for r in got.collect()) == [(1, None), (2, "x"), (3, "x"), (4, "x")]


# --- projections and filters ------------------------------------------------------------------


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["﻿a ", " b", "c"])
    assert project.trim_names(df).columns == ["a", "b", "c"]
    assert project.drop_positions(project.trim_names(df), [0, 2]).columns == ["b"]
    assert project.number_names(df, 1, 1960).columns == ["﻿a ", "1960", "1961"]
    assert project.drop_present(df, "zzz").columns == df.columns


def test_first_of_each_name(spark):
    a = spark.createDataFrame([(1, "l")], "k int, v string")
    b = spark.createDataFrame([(1, "r")], "k int, v string")
    joined = a.join(b, a["k"] == b["k"])
    out = project.first_of_each_name(joined)
    assert out.columns == ["k", "v"] and rows(out) == [(1, "l")]


def test_reject_marked_looks_at_every_column(spark):
    df = spark.createDataFrame([("a", "b"), ("x...", "b"), ("a", "..."), (None, "b")], "p string, q string")
    assert sorted(rows(filters.reject_marked(df, "...").fillna("null"))) == [("a", "b"), ("null", "b")]


def test_anti_keeps_null_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    members = spark.createDataFrame([(1,), (1,)], "k int")
    assert {r["k"] for r in filters.drop_members(df, members, ["k"]).collect()} == {2, None}
    assert rows(filters.keep_members(df, members, ["k"])) == [(1,)]


def test_numeric_key_rows(spark):
    df = spark.createDataFrame([("1961", 1.0), ("Unnamed: 68", None)], "year string, v double")
    assert rows(filters.numeric_key_rows(df, "year")) == [(1961, 1.0)]


def test_quality_profile_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (1, "a")], "n int, s string")
    got = {r["column_name"]: (r["row_count"], r["null_count"], r["distinct_count"]) for r in filters.quality_profile(df).collect()}
    assert got == {"n": (4, 0, 2), "s": (4, 1, 1)}
    assert filters.duplicate_count(df).first()[0] == 2


# --- reshape ------------------------------------------------------------------------------------


def test_melt_years_ignores_other_columns(spark):
    wide = spark.createDataFrame([("A", "x", 1.0, None)], "name string, note string, a double, b double").toDF(
        "name", "note", " 1960", "1961 "
    )
    got = reshape.melt_years(wide, ["name"], "v")
    assert [tuple(r) for r in got.orderBy("year").collect()] == [("A", 1960, 1.0), ("A", 1961, None)]


def test_symmetrise_twice_gives_the_same_set(spark):
    df = spark.createDataFrame([("a", "b", 1), ("c", "a", 2)], "x string, y string, v int")
    once = reshape.symmetrise(df, "x", "y")
    assert rows(once) == [("a", "b", 1), ("a", "c", 2), ("b", "a", 1), ("c", "a", 2)]
    assert rows(reshape.symmetrise(once, "x", "y").distinct()) == rows(once)


@pytest.mark.parametrize("parts", [1, 7])
def test_nested_lookup_splits_all_keys_alike_and_loses_nothing(spark, parts):
    data = [("big", f"c{i}", float(i)) for i in range(97)] + [("small", "c1", 1.0), ("small", "c1", 0.5)]
    df = spark.createDataFrame(data, "country string, city string, lat double")
    nested = reshape.nested_lookup(df, "country", "city", ["lat"], parts)
    assert nested.where("country = 'big'").count() == parts
    assert nested.where("country = 'small'").count() == 1
    want = sorted(data[:97] + [("small", "c1", 0.5)])
    assert rows(reshape.lookup_rows(nested, "country", "city")) == want


# --- joins -------------------------------------------------------------------------------------


def test_unique_dimension_stops_fan_out(spark):
    dim = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, "c")], "code int, name string")
    assert rows(joins.unique_dimension(dim, "code")) == [(1, "a"), (2, "c")]


def test_against_reference_with_missing_and_zero_years(spark):
    data = [("R", 2000, 2.0), ("R", 2001, 0.0), ("A", 2000, 4.0), ("A", 2001, 4.0), ("A", 2002, 4.0)]
    df = spark.createDataFrame(data, "e string, year int, v double")
    got = joins.against_reference(df, "e", "R", "year", "v", "n").where("e = 'A'")
    assert sorted((r["year"], r["n"]) for r in got.collect()) == [(2000, 2.0), (2001, None), (2002, None)]


def test_lookup_and_recode(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "x string")
    got = df.select("x", joins.lookup("x", {"a": "A"}).alias("l"), joins.recode("x", {"a": "A"}).alias("r")).collect()
    assert [tuple(r) for r in got] == [("a", "A", "A"), ("z", None, "z"), (None, None, None)]


def test_spine_marks_gaps(spark):
    names = spark.createDataFrame([("a",), ("b",)], "p string")
    values = spark.createDataFrame([("a", 2000, 1.5)], "p string, year int, s double")
    got = joins.fill_spine(joins.spine(names, [2000, 2001]), values, ["p", "year"], "s")
    assert rows(got, "p", "year", "s") == [
        ("a", 2000, "1.5"), ("a", 2001, "No data"), ("b", 2000, "No data"), ("b", 2001, "No data")
    ]


# --- aggregates ---------------------------------------------------------------------------------


def test_subtotals_equal_the_detail(spark):
    rng = np.random.default_rng(1)
    data = [(2000 + int(i % 3), f"p{i % 4}", f"c{i % 5}", float(round(rng.uniform(0, 100), 2))) for i in range(200)]
    df = spark.createDataFrame(data, "year int, partner string, product string, v double")
    out = aggregates.with_subtotals(df, ["year", "partner"], {"product": "All"}, ["v"]).collect()
    for key in {(r["year"], r["partner"]) for r in out}:
        of_key = [r for r in out if (r["year"], r["partner"]) == key]
        total = [r["v"] for r in of_key if r["product"] == "All"]
        assert len(total) == 1
        assert total[0] == pytest.approx(sum(r["v"] for r in of_key if r["product"] != "All"))


def test_subtotal_label_differs_from_a_null_product(spark):
    df = spark.createDataFrame([(1, None, 2.0), (1, "x", 3.0)], "year int, product string, v double")
    out = aggregates.with_subtotals(df, ["year"], {"product": "All"}, ["v"])
    assert {(r["product"], r["v"]) for r in out.collect()} == {(None, 2.0), ("x", 3.0), ("All", 5.0)}


def test_group_sums_drop_null_keys(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 5.0), ("a", None)], "k string, v double")
    assert rows(aggregates.group_sums(df, ["k"], ["v"])) == [("a", 1.0)]


def test_shares_of_all_parts_add_up(spark):
    df = spark.createDataFrame([(i % 5, float(i)) for i in range(50)], "g int, v double")
    parts = [aggregates.share_of_total(df, F.col("g") == g, "v").first()["share_pct"] for g in range(5)]
    assert sum(parts) == pytest.approx(100.0)


def test_first_by_key_prunes_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id"))
    out = aggregates.first_by_key(df, ["k"], [F.col("id").desc()])
    assert rows(out) == [(0, 998), (1, 999)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_exchange


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0), ("d", None)], "k string, v double")
    assert [r["k"] for r in aggregates.top_k(df, "v", 2, ["k"]).collect()] == ["c", "a"]


def test_latest_slice_and_last_years(spark):
    df = spark.createDataFrame([(2000, 1), (2002, 2), (2002, 3), (None, 4)], "year int, v int")
    assert rows(aggregates.latest_slice(df)) == [(2002, 2), (2002, 3)]
    assert [r["year"] for r in aggregates.last_years(df.dropna(), 5).collect()] == [2002, 2000]


def test_autocorrelation(spark):
    rng = np.random.default_rng(3)
    y = rng.normal(size=300).cumsum()
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(y)], "i int, y double").repartition(6)
    row = aggregates.autocorrelation(df, "y", ["i"], [1, 2]).first()
    assert row["lag_1"] == pytest.approx(np.corrcoef(y[1:], y[:-1])[0, 1])
    assert row["lag_2"] == pytest.approx(np.corrcoef(y[2:], y[:-2])[0, 1])


def test_describe(spark):
    values = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0]
    row = aggregates.describe(spark.createDataFrame([(v,) for v in values], "v double"), "v").first()
    assert (row["n"], row["min"], row["max"], row["median"]) == (6, 1.0, 9.0, 3.5)
    assert row["variance"] == pytest.approx(statistics.variance(values))


# --- windows -------------------------------------------------------------------------------------


def test_lag_by_row_and_by_year(spark):
    df = spark.createDataFrame([("a", 2000, 1.0), ("a", 2001, 2.0), ("a", 2003, 3.0)], "p string, year int, v double")
    by_row = windows.add_lags(df, ["p"], ["v"], [1, 2])
    by_year = windows.add_lags(df, ["p"], ["v"], [1], adjacent=True)
    order = lambda d: [tuple(r) for r in d.orderBy("year").collect()]
    assert [r[3:] for r in order(by_row)] == [(None, None), (1.0, None), (2.0, 1.0)]
    assert [r[3] for r in order(by_year)] == [None, 1.0, None]


def test_growth_fills_interior_gaps_first(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 2, 10.0), ("a", 3, None), ("a", 4, 15.0), ("a", 5, 0.0), ("a", 6, 1.0)],
        "p string, year int, v double",
    )
    got = [r["g"] for r in windows.growth(df, ["p"], "v", "g").orderBy("year").collect()]
    assert got == [None, None, 0.0, 0.5, -1.0, None]


def test_one_row_per_year(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 2.0)], "p string, year int, v double")
    assert rows(windows.one_row_per_year(df, ["p"], ["v"])) == [("a", 1, 3.0)]


def test_group_median_is_dealt_by_rows(spark, monkeypatch):
    """Sorted values pack well, so that a task dealt by bytes held far too many rows."""
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 5003).alias("v"), F.lit(1.5).alias("w"))
    monkeypatch.setattr(ordering, "PIECE_ROWS", 100)
    median = ordering.group_median(df, ["g"], ["v", "w"])
    assert "REPARTITION_BY_NUM" in median._jdf.queryExecution().toString()
    got = {r["g"]: (r["v"], r["w"]) for r in median.collect()}
    values = {g: [i * 7919 % 5003 for i in range(g, 5000, 3)] for g in range(3)}
    assert got == {g: (statistics.median(v), 1.5) for g, v in values.items()}
