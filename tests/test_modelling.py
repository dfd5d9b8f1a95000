import math
import threading

import pytest

from tradepanel.functions.fixed_values import PRODUCT_OF_CODE, PRODUCT_SHORT_NAMES
from tradepanel.operators import models
from tradepanel.plans import modelling


@pytest.fixture(scope="module")
def panel(spark):
    rows = []
    for p in range(4):
        for h in (9, 27):
            for y in range(2000, 2015):
                level = 1000.0 * (p + 1) * (h + 3) * 1.07 ** (y - 2000) * (1 + 0.05 * math.sin(3 * y + p + h))
                rows.append((
                    y, f"P{p}", h, f"product {h}", level, 2 * level, 0.5, 1.0 + 0.1 * p + 0.01 * math.cos(y),
                    1e9 * (p + 1) * 1.03 ** (y - 2000), 1e9 * (p + 1) * 1.03 ** (y - 2001), 2.0 + 0.1 * math.sin(y * (p + 1)),
                    0.1 * ((y + p) % 5), (y + p) % 2, 5e9 * 1.02 ** (y - 2000), 5e9 * 1.02 ** (y - 2001),
                ))
    schema = (
        "year int, partner string, hs_code int, product string, imports double, exports double, agree double, "
        "distance double, gdp double, gdp_lag1 double, rate double, adjusted_value double, fta_binary int, "
        "home_gdp double, home_gdp_lag1 double"
    )
    return spark.createDataFrame(rows, schema)


def test_feature_names():
    assert modelling.feature_columns() == [
        "year", "log_imports_lag1", "distance", "log_gdp_lag1", "log_home_gdp_lag1", "rate", "adjusted_value"
    ]
    raw = modelling.feature_columns("exports", log=False, lags=(1, 2, 3), interactions=True, rate_change=True)
    assert raw == [
        "exports_lag1", "exports_lag2", "exports_lag3", "distance", "gdp_lag1", "home_gdp_lag1", "rate",
        "adjusted_value", "rate_change", "gdp_x_agreement", "gdp_x_distance",
    ]


def test_model_frame(panel):
    frame = modelling.model_frame(panel, "exports", sections=["09"])
    assert frame.count() == 4 * 2 * 12  # three years go to the lags
    assert frame.select(modelling.KEY).distinct().count() == frame.count()
    now = {(r["year"], r["partner"], r["hs_code"]): r for r in frame.collect()}
    source = {(r["year"], r["partner"], r["hs_code"]): r for r in panel.collect()}
    row, before = now[(2010, "P2", 9)], source[(2009, "P2", 9)]
    assert row["exports_lag1"] == before["exports"]
    assert row["exports_lag3"] == source[(2007, "P2", 9)]["exports"]
    assert row["log_exports_lag1"] == pytest.approx(math.log(before["exports"]))
    assert row["rate_change"] == pytest.approx(row["rate"] / before["rate"] - 1)
    assert row["gdp_x_agreement"] == row["gdp"] * row["adjusted_value"]
    assert (row["section_09"], now[(2010, "P2", 27)]["section_09"]) == (1, 0)


def test_train_picks_the_best_and_predicts(panel):
    model, summary = modelling.train(
        panel, "imports", {"ols": ("ols", {}), "stump": ("forest", {"trees": 1, "depth": 1})}
    )
    scores = {r["model"]: r["r2"] for r in summary.collect()}
    assert scores["ols"] > 0.9 > scores["stump"]
    assert models.feature_names(model) == modelling.feature_columns()
    assert set(models.coefficients(model)) == {*modelling.feature_columns(), "(intercept)"}


def test_short_product_names_are_known_products():
    assert set(PRODUCT_SHORT_NAMES.values()) | {"All Products"} == set(PRODUCT_OF_CODE.values())


def test_candidates_and_folds_are_fitted_side_by_side(spark, monkeypatch):
    rows = [(i, i % 6, float(i % 7), 2.0 * (i % 7) + i % 3) for i in range(60)]
    folded = spark.createDataFrame(rows, "i int, fold int, a double, y double")
    together, plain = threading.Barrier(10), models.fit

    def fit(*args, **params):
        together.wait(60)  # raises if the ten fits are not all there
        return plain(*args, **params)

    monkeypatch.setattr(models, "fit", fit)
    means = modelling.compare_models(folded, ["a"], "y", {"ols": ("ols", {}), "ridge": ("ridge", {"alpha": 1.0})})
    assert {r["model"]: r["r2"] > 0.9 for r in means.collect()} == {"ols": True, "ridge": True}
