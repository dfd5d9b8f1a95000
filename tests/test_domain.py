import math
import statistics

import pytest

from tradepanel.functions.fixed_values import COUNTRY_SPELLINGS, CURRENCY_OF_COUNTRY, PRODUCT_OF_CODE
from tradepanel.plans import dashboard, domain


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


def test_trade_balance_modes(spark):
    data = [
        (2020, "A", "Import", 5.0), (2020, "A", "Export", 2.0), (2020, "A", "Import", 1.5),
        (2020, "B", "Import", 3.0), (2021, "B", "Export", 4.0), (2021, None, "Export", 9.0),
    ]
    flows = spark.createDataFrame(data, "year int, partner string, flow string, value double")
    strict = domain.trade_balance(flows, ["year", "partner"])
    filled = domain.trade_balance(flows, ["year", "partner"], mode="zero_fill")
    pick = lambda df: {(r["year"], r["partner"]): (r["imports"], r["exports"], r["trade_volume"]) for r in df.collect()}
    assert pick(strict) == {
        (2020, "A"): (6.5, 2.0, 8.5), (2020, "B"): (3.0, None, None), (2021, "B"): (None, 4.0, None)
    }
    assert pick(filled)[(2020, "B")] == (3.0, None, 3.0)
    assert pick(filled)[(2021, "B")] == (None, 4.0, 4.0)


def test_pair_distance_imputes_drops_and_joins_both_orders(spark):
    names = spark.createDataFrame([(1, "China"), (2, "Japan"), (3, "Chad")], "code int, name string")
    votes = spark.createDataFrame(
        [
            (1, 2, 2000, 0.5, 1.0, -0.5, 1.4), (2, 1, 2000, 0.7, 0.25, 1.0, None),
            (1, 2, 2001, 0.9, None, 1.0, None), (1, 3, 2000, 0.9, 1.0, 1.0, 0.0), (1, 9, 2000, 0.9, 1.0, 1.0, 0.0),
        ],
        "code1 int, code2 int, year int, agree double, ideal_x double, ideal_y double, distance double",
    )
    got = domain.pair_distance(votes, names, ["China", "Japan"]).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["year"], r["pair"]) == (2000, ["China", "Japan"])
    assert (r["agree"], r["distance"]) == (pytest.approx(0.6), pytest.approx((1.4 + 0.75) / 2))


def test_home_pairs(spark):
    pairs = spark.createDataFrame(
        [(2000, ["A", "Home"]), (2000, ["Home", "Z"]), (2000, ["A", "Z"]), (1980, ["A", "Home"])], "year int, pair array<string>"
    )
    assert rows(domain.home_pairs(pairs, "Home", 1989, 2023), "partner") == [("A",), ("Z",)]


def test_agreement_adjust(spark):
    agreements = spark.createDataFrame(
        [
            (2016, "AAA", "BBB", 1.0, 50.0, 40.0), (2017, "AAA", "BBB", 1.0, 50.0, 40.0),
            (2016, None, "BBB", 1.0, 50.0, 40.0), (2016, "", "CCC", 0.0, None, None), (2017, "CCC", "AAA", 0.0, 50.0, 40.0),
        ],
        "year int, country string, partner_country string, fta_weight double, tariff_pct double, export_weight double",
    )
    weights = spark.createDataFrame([("AAA", 0.5), ("HOM", 0.25)], "country string, tariff_weight double")
    got = {
        (r["year"], r["country"], r["partner_country"]): (r["adjusted_value"], r["fta_binary"])
        for r in domain.agreement_adjust(agreements, weights, "HOM").collect()
    }
    burden = 0.5 * 0.4
    assert len(got) == 10
    assert got[(2016, "AAA", "BBB")] == (pytest.approx(1 - burden * 0.5), 1) == got[(2016, "BBB", "AAA")]
    assert got[(2017, "AAA", "BBB")] == (pytest.approx(1 - burden), 1)
    assert got[(2016, "HOM", "BBB")] == (pytest.approx(1 - burden * 0.25), 1)
    assert got[(2016, "HOM", "CCC")] == (0.0, 0)
    assert got[(2017, "CCC", "AAA")] == (0.0, 0)  # floored at 0


def test_tariff_profile(spark):
    data = [
        ("X", "9", "3", "0", None, "g2", 2), ("X", "bad", "0", "no", "g1", "g1", 3), ("X", "0", None, "2", "g0", None, 1),
        ("Y", None, "1", None, "g", "g", 1), (None, "1", "1", "1", "g", "g", 1),
    ]
    tariffs = spark.createDataFrame(
        data, "reporter string, mfn string, prf string, pta string, reporter_group string, partner_group string, row_order int"
    )
    got = {r["reporter"]: r for r in domain.tariff_profile(tariffs).collect()}
    assert set(got) == {"X", "Y"}
    x = got["X"]
    assert (x["row_count"], x["total_pta"], x["reporter_group"], x["partner_group"]) == (3, 1, "g0", "g2")
    assert x["total_mfn"] == pytest.approx(math.log(10))
    assert x["avg_mfn"] == pytest.approx(math.log(10) / 3)  # unreadable cells stay in the divisor
    assert x["avg_prf"] == pytest.approx(math.log(4) / 3)
    assert (got["Y"]["total_mfn"], got["Y"]["total_pta"]) == (0.0, 0)


def test_geo_score_formula(spark):
    values = (1.25, 2.0e13, math.log1p(6.9), 0.8, 1.0)
    row = spark.createDataFrame(
        [("A", 2020, *values)],
        "partner string, year int, distance double, gdp_lag1 double, rate_log double, adjusted_value double, fta_binary double",
    )
    want = 500 + 4 * values[0] - 28 * math.log10(values[1]) - 0.7 * values[2] - 16 * values[3] - 16 * values[4]
    assert domain.geo_score(row).first()["geo_distance_score"] == pytest.approx(want, abs=1e-9)


def test_geo_aggregate_takes_sums_and_medians(spark):
    data = [("A", 2020, float(i), 2.0 * i, float(i * i), 7.0, 1.0, 0.5, 1) for i in range(1, 7)]
    df = spark.createDataFrame(
        data, "partner string, year int, imports double, exports double, distance double, gdp_lag1 double, "
              "rate_log double, adjusted_value double, fta_binary int"
    )
    row = domain.geo_aggregate(df).first()
    assert (row["imports"], row["exports"]) == (21.0, 42.0)
    assert row["distance"] == statistics.median(i * i for i in range(1, 7))


def test_normalise_to_ref(spark):
    df = spark.createDataFrame([("USA", 1, 4.0), ("CHN", 1, 1.0), ("CHN", 2, 1.0), ("XXX", 1, 1.0)], "code string, year int, gdp double")
    got = domain.normalise_to_ref(df, "code", "USA", "gdp", ["CHN"])
    assert rows(got, "code", "year", "gdp_normalized") == [("CHN", 1, 0.25), ("USA", 1, 1.0)]


def test_cross_rate(spark):
    data = [("Singapore", 2020, 1.6), ("Japan", 2020, 100.0), ("Korea, Rep.", 2020, 1000.0), ("Mars", 2020, 0.2), ("Japan", 1999, 1.0)]
    df = spark.createDataFrame(data, "country string, year int, rate double")
    got = domain.cross_rate(df, "Singapore", CURRENCY_OF_COUNTRY, 2003, COUNTRY_SPELLINGS)
    assert {(r["country"], r["er"], r["currency"]) for r in got.collect()} == {
        ("Singapore", 1.0, "SGD"), ("Japan", 62.5, "JPY"), ("South Korea", 625.0, "KRW"), ("Mars", 0.12, None)
    }


def test_indicator_summary(spark):
    schema = "reporter string, partner string, product_category string, indicator_type string, indicator string, `2000` string, `2001` string, Notes string"
    data = [
        ("S", "China", "All Products", "Import", "Import(US$ Mil)", "10", "...", None),
        ("S", "China", "All Products", "Import", "Imports (in US$ Mil)", "5", "2", None),
        ("S", "World", "All Products", "Import", "Import(US$ Mil)", "99", "99", None),
        ("S", "China", "Animal", "Import", "Import(US$ Mil)", "99", "99", None),
        ("S", "China", "All Products", "Import", "Tariff", "99", "99", None),
        ("S", "Ja...n", "All Products", "Import", "Import(US$ Mil)", "1", "1", None),
    ]
    got = domain.indicator_summary(
        spark.createDataFrame(data, schema), ["Import(US$ Mil)", "Imports (in US$ Mil)"], "All Products", "World"
    )
    assert rows(got, "year", "partner", "trade_value") == [(2000, "China", 15.0), (2001, "China", 2.0)]


def test_yearly_totals_from_padded_month_tables(spark):
    schema = "country string, `2013 Jan` double, `2013 Feb` double, `2025 Jan` double"
    imports = spark.createDataFrame([("    China", 1.0, 2.0, 9.0), ("    Korea, Rep Of", 5.0, None, 9.0)], schema)
    exports = spark.createDataFrame([("    China", 10.0, 20.0, 9.0), ("    Korea, Rep Of", 1.0, 1.0, 9.0)], schema)
    got = domain.yearly_totals(imports, exports, None, 2024, COUNTRY_SPELLINGS)
    assert rows(got, "country", "year", "imports", "exports", "trade_volume") == [
        ("China", 2013, 3.0, 30.0, 33.0), ("South Korea", 2013, 5.0, 1.0, 6.0)
    ]


def test_history_and_forecast(spark):
    history = spark.createDataFrame([(2023, "A", "Plastics", 39, 1.0, 2.0, 3.0)], "year int, partner string, product string, hs_code int, imports double, exports double, trade_volume double")
    forecast = spark.createDataFrame([("A", 39, 2024, 4.0, 5.0), ("A", 99, 2024, 6.0, 7.0)], "partner string, hs_code int, year int, imports double, exports double")
    imports, exports = forecast.drop("exports"), forecast.drop("imports")
    both = domain.combine_forecasts(imports, exports, ["partner", "hs_code", "year"])
    out = domain.history_and_forecast(history, both, PRODUCT_OF_CODE)
    assert rows(out, "year", "product", "trade_volume") == [
        (2023, "Plastics", 3.0), (2024, "All Products", 13.0), (2024, "Plastics", 9.0)
    ]


TRADE = "partner string, year int, product string, imports double, exports double"


def test_bubble_empty_slice_keeps_its_columns(spark):
    trade = spark.createDataFrame([("A", 2020, "P", 1.0, 2.0), ("K", 2020, "P", 1.0, 2.0), (None, 2020, "P", 1.0, 1.0)], TRADE)
    scores = spark.createDataFrame([("A", 2020, 99.0)], "partner string, year int, geo_distance_score double")
    full = dashboard.bubble(trade, scores, "P", 2020, excluded="K")
    assert [r["partner"] for r in full.collect()] == ["A", None]
    empty = dashboard.bubble(trade, scores, "P", 1900)
    assert empty.count() == 0 and empty.schema == full.schema


def test_series_has_the_boundary_year_twice(spark):
    trade = spark.createDataFrame([("A", y, "P", 1.0, 1.0) for y in (2022, 2023, 2024)], TRADE)
    got = dashboard.series(trade, "A", "P", 2023)
    assert rows(got, "segment", "year") == [("forecast", 2023), ("forecast", 2024), ("history", 2022), ("history", 2023)]


def test_rank_axis(spark):
    scores = spark.createDataFrame([("A", 1, 50.0), ("B", 1, 70.0), ("C", 1, None), ("D", 2, 0.0)], "partner string, year int, geo_distance_score double")
    got = dashboard.rank(scores, 1).collect()
    assert [(r["partner"], r["axis_low"], r["axis_high"]) for r in got] == [("B", 40.0, 70.0), ("A", 40.0, 70.0)]


def test_trend_and_yearly(spark):
    scores = spark.createDataFrame([("A", 3, 1.0), ("A", 1, 2.0), ("B", 1, 3.0)], "partner string, year int, geo_distance_score double")
    assert [r["year"] for r in dashboard.trend(scores, "A").collect()] == [1, 3]
    trade = spark.createDataFrame([("A", y, p, 1.0, 2.0) for y in (2015, 2016) for p in "PQ"], TRADE)
    got = dashboard.yearly(trade, "A", 2015, 2009, 2024, {"A": "since 2016"}, {"A": 2016}).collect()
    assert [(r["year"], r["imports"], r["is_marked"], r["is_agreement_line"], r["note"]) for r in got] == [
        (2015, 2.0, 1, 0, "since 2016"), (2016, 2.0, 0, 1, "since 2016")
    ]
    plain = dashboard.yearly(trade, "A", 2015, 2009, 2024).first()
    assert (plain["note"], plain["is_agreement_line"]) == ("agreement in all years", 0)


def test_panel_build_keeps_its_key(spark):
    pairs = spark.createDataFrame([(2000, ["A", "H"], 0.5, 1.0), (2000, ["B", "H"], 0.5, 1.0)], "year int, pair array<string>, agree double, distance double")
    trade = spark.createDataFrame([(2000, "A", 1, "P", 1.0, 2.0), (2000, "A", 2, "Q", 1.0, None)], "year int, partner string, hs_code int, product string, imports double, exports double")
    gdp = spark.createDataFrame([("A", 2000, 5.0)], "partner string, year int, gdp double")
    rates = spark.createDataFrame([("A", 2000, 2.0)], "partner string, year int, rate double")
    agreements = spark.createDataFrame([(2000, "A", "H", 1.0, 1), (2000, "H", "A", 1.0, 1)], "year int, country string, partner_country string, adjusted_value double, fta_binary int")
    home = spark.createDataFrame([(2000, 9.0)], "year int, home_gdp double")
    got = domain.panel_build(pairs, trade, gdp, rates, agreements, home, "H", 1990, 2010).collect()
    assert [(r["partner"], r["product"], r["gdp"], r["adjusted_value"], r["home_gdp"]) for r in got] == [("A", "P", 5.0, 1.0, 9.0)]


def test_partner_coverage(spark):
    df = spark.createDataFrame([("A", 2014, 30.0), ("B", 2014, 70.0), ("Asia", 2014, 500.0), ("A", 2000, 500.0)], "country string, year int, trade_volume double")
    assert domain.partner_coverage(df, ["A"], ["Asia"], 2013).first()["share_pct"] == pytest.approx(30.0)
