import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradepanel.catalog import forecasts as forecast_queries
from tradepanel.catalog import models as model_queries
from tradepanel.functions import fixed_values as fixed
from tradepanel.operators import features, forecasting, models, validation


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(7)
    n = 400
    a, b = rng.normal(3, 2, n), rng.normal(-1, 5, n)
    y = 2.0 * a - 0.5 * b + 4 + rng.normal(0, 0.5, n)
    df = spark.createDataFrame([(i, float(p), float(q), float(r)) for i, (p, q, r) in enumerate(zip(a, b, y))], "i int, a double, b double, y double").repartition(5)
    return df, a, b, y


def scaled(*columns):
    return np.column_stack([(c - c.mean()) / c.std() for c in columns])


def ridge(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    beta = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return beta, y.mean() - x.mean(0) @ beta


def lasso(x, y, alpha):
    xc, yc, n = x - x.mean(0), y - y.mean(), len(y)
    beta = np.zeros(x.shape[1])
    for _ in range(2000):
        for j in range(len(beta)):
            rest = xc[:, j] @ (yc - xc @ beta + xc[:, j] * beta[j]) / n
            beta[j] = np.sign(rest) * max(abs(rest) - alpha, 0) / (xc[:, j] @ xc[:, j] / n)
    return beta, y.mean() - x.mean(0) @ beta


@pytest.mark.parametrize("kind, alpha", [("ols", 0.0), ("ridge", 1.0), ("ridge", 100.0), ("lasso", 0.1), ("lasso", 1.0)])
def test_linear_fits_equal_their_definitions(sample, kind, alpha):
    df, a, b, y = sample
    want, intercept = (lasso if kind == "lasso" else ridge)(scaled(a, b), y, alpha)
    got = models.coefficients(models.fit(df, ["a", "b"], "y", kind, alpha=alpha))
    tolerance = 1e-4 if kind == "lasso" else 1e-6
    assert [got["a"], got["b"], got["(intercept)"]] == pytest.approx([*want, intercept], abs=tolerance)


def test_standardise_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    got = sorted((r["x_scaled"], r["c_scaled"]) for r in features.standardise(df, ["x", "c"]).collect())
    assert got == [(-1.0, 0.0), (1.0, 0.0)]


def test_one_hot_drops_the_first_level(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "s string")
    out = features.one_hot(df, "s")
    assert out.columns == ["s", "s_b", "s_c"]
    assert {r["s"]: (r["s_b"], r["s_c"]) for r in out.collect()} == {"a": (0, 0), "b": (1, 0), "c": (0, 1), None: (0, 0)}
    with pytest.raises(ValueError):
        features.one_hot(spark.range(20), "id", most=5)


def test_degree_two_names_and_values(spark):
    row = features.degree_two(spark.createDataFrame([(2.0, 3.0)], "p double, q double"), ["p", "q"]).first()
    assert (row["p_x_p"], row["p_x_q"], row["q_x_q"]) == (4.0, 6.0, 9.0)


def expanding(n, splits):
    """Test blocks of an expanding time split, written out."""
    size = n // (splits + 1)
    start = n - splits * size
    return [range(start + k * size, start + (k + 1) * size) for k in range(splits)]


@pytest.mark.parametrize("n, splits", [(60, 5), (61, 5), (65, 5), (6, 5), (23, 3)])
def test_expanding_folds(spark, n, splits):
    df = spark.range(n).withColumnRenamed("id", "t").repartition(4)
    got = {r["t"]: r["fold"] for r in validation.expanding_folds(df, ["t"], splits).collect()}
    for k, block in enumerate(expanding(n, splits), start=1):
        assert [t for t in got if got[t] == k and t not in block] == []
        assert all(got[t] == k for t in block)
    assert sum(f == 0 for f in got.values()) == n - splits * (n // (splits + 1))


def test_fewer_rows_than_folds(spark):
    got = [r["fold"] for r in validation.expanding_folds(spark.range(4), ["id"], 5).collect()]
    assert got == [0, 0, 0, 0]


@pytest.mark.parametrize("n, folds", [(50, 5), (52, 5), (7, 5), (3, 5)])
def test_block_folds(spark, n, folds):
    got = [r["fold"] for r in validation.block_folds(spark.range(n).repartition(3), ["id"], folds).orderBy("id").collect()]
    want = [k + 1 for k, part in enumerate(np.array_split(np.arange(n), folds)) for _ in part]
    assert got == want


def test_fold_metrics(spark):
    data = [(1, 1.0, 1.5), (1, 2.0, 1.0), (1, 4.0, 4.0), (2, 3.0, 3.0), (2, 5.0, 4.0)]
    df = spark.createDataFrame(data, "fold int, y double, p double")
    got = {r["fold"]: r for r in validation.fold_metrics(df, "y", "p", 3).collect()}
    y, p = np.array([1.0, 2.0, 4.0]), np.array([1.5, 1.0, 4.0])
    sse = ((y - p) ** 2).sum()
    r = got[1]
    assert r["r2"] == pytest.approx(1 - sse / ((y - y.mean()) ** 2).sum())
    assert (r["mae"], r["mse"], r["rmse"]) == pytest.approx((0.5, sse / 3, math.sqrt(sse / 3)))
    assert (r["aic"], r["bic"]) == pytest.approx((6 + sse, 3 * math.log(3) + sse))
    mean = validation.average_metrics(validation.fold_metrics(df, "y", "p", 3)).first()
    assert mean["mae"] == pytest.approx((0.5 + 0.5) / 2)


def test_year_splits_need_earlier_rows(spark):
    df = spark.createDataFrame([(y,) for y in [2000, 2000, 2001, 2003]], "year int")
    got = [tuple(r) for r in validation.year_splits(df, 5).collect()]
    assert got == [(2003, 1, 3), (2001, 1, 2)]
    assert [r["year"] for r in validation.year_splits(df, 1).collect()] == [2003]


def test_holdout_is_stable_and_near_its_share(spark):
    df = spark.range(20000)
    first = validation.holdout(df, ["id"]).where("in_train")
    again = validation.holdout(df.repartition(7), ["id"]).where("in_train")
    assert first.exceptAll(again).count() == 0
    assert 0.78 < first.count() / 20000 < 0.82


def r2(y, p):
    return 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()


@pytest.mark.parametrize("penalty, alphas", [("ridge", [0.01, 10.0, 500.0]), ("lasso", [0.01, 0.5, 2.0])])
def test_one_pass_search_equals_separate_fits(spark, sample, penalty, alphas):
    df, a, b, y = sample
    x = np.column_stack([a, b])
    solve = ridge if penalty == "ridge" else lasso
    want = {}
    for alpha in alphas:
        scores = []
        for block in expanding(len(y), 5):
            tr, te = slice(0, block.start), slice(block.start, block.stop)
            mean, dev = x[tr].mean(0), x[tr].std(0)
            beta, intercept = solve((x[tr] - mean) / dev, y[tr], alpha)
            scores.append(r2(y[te], (x[te] - mean) / dev @ beta + intercept))
        want[alpha] = np.mean(scores)
    got = validation.linear_search(validation.expanding_folds(df, ["i"]), ["a", "b"], "y", alphas, penalty).collect()
    assert {r["alpha"]: r["r2"] for r in got} == pytest.approx(want, abs=1e-6)
    assert got[0]["r2"] == max(r["r2"] for r in got)


def test_search_over_trees_and_best_model(spark, sample):
    df, *_ = sample
    folded = validation.expanding_folds(df, ["i"], 2).cache()
    out = validation.search(folded, ["a", "b"], "y", "forest", validation.grid(trees=[2], depth=[1, 4]), [1, 2]).collect()
    assert [r["params"] for r in out] == ["trees=2, depth=4", "trees=2, depth=1"]
    table = spark.createDataFrame([("x", 0.4), ("y", 0.9)], "model string, r2 double")
    assert table.select(validation.best_model(table).alias("b")).first()["b"] == "y"
    folded.unpersist()


def test_fold_predictions_train_on_earlier_rows_only(spark, sample):
    df, a, b, y = sample
    scored, fitted = validation.fold_predictions(validation.expanding_folds(df, ["i"], 3), ["a", "b"], "y", "ols", [1, 2, 3])
    got = {r["i"]: r["prediction"] for r in scored.collect()}
    x = np.column_stack([np.ones(len(y)), a, b])
    for block in expanding(len(y), 3):
        beta = np.linalg.lstsq(x[: block.start], y[: block.start], rcond=None)[0]
        assert [got[i] for i in block] == pytest.approx(list(x[list(block)] @ beta), abs=1e-6)
    average = validation.average_coefficients(fitted)
    assert set(average) == {"a", "b", "(intercept)"}


def test_year_forward(spark, sample):
    df, *_ = sample
    dated = df.withColumn("year", (2000 + F.col("i") / 100).cast("int"))
    got = validation.year_forward(dated, ["a", "b"], "y", "ols", last=2).orderBy("year").collect()
    assert [r["year"] for r in got] == [2002, 2003] and all(r["r2"] > 0.9 for r in got)


@pytest.mark.parametrize("kind, params", [("forest", {"trees": 10, "depth": 6}), ("boost", {"trees": 20, "depth": 3})])
def test_trees_learn_and_rank(spark, sample, kind, params):
    df, a, b, y = sample
    model = models.fit(df, ["a", "b"], "y", kind, scale=False, **params)
    p = np.array([r["prediction"] for r in models.predict(model, df).orderBy("i").collect()])
    assert r2(y, p) > 0.85
    ranked = [r["feature"] for r in models.ranked_features(spark, model).collect()]
    assert ranked == ["a", "b"]  # the spread of 2 a exceeds that of b / 2


def test_category_feature(spark):
    df = spark.createDataFrame([(c, float(i % 3), 10.0 * "xyz".index(c)) for i in range(30) for c in "xyz"], "c string, v double, y double")
    model = models.fit(df, ["v"], "y", "boost", scale=False, categories=["c"], trees=5, depth=2, rate=1.0)
    assert models.feature_names(model) == ["v", "c"]
    got = {(r["y"], round(r["prediction"], 3)) for r in models.predict(model, df).collect()}
    assert got == {(0.0, 0.0), (10.0, 10.0), (20.0, 20.0)}


# --- forecasts ---------------------------------------------------------------------------------


def test_forecast_years_must_be_later():
    assert forecasting.check_years(2023, [2026, 2024]) == [2024, 2026]
    for bad in ([2023], [2022, 2025], []):
        with pytest.raises(ValueError):
            forecasting.check_years(2023, bad)


def test_roll_equals_a_loop(spark):
    start = [("p", 20.0, 19.5, 19.0), ("q", 17.0, 16.0, 15.0), ("r", 30.0, 29.0, 28.0)]
    df = spark.createDataFrame([(k, 2023, *l) for k, *l in start], "k string, year int, l1 double, l2 double, l3 double")
    step = forecasting.linear_step(0.5, {"l1": 0.7, "l2": 0.2, "l3": 0.1})
    got = {(r["k"], r["target_year"]): r["forecast"] for r in forecasting.roll(df, [2024, 2025, 2026], step, ["l1", "l2", "l3"], ["k"]).collect()}
    for k, l1, l2, l3 in start:
        for year in (2024, 2025, 2026):
            log = min(max(0.5 + 0.7 * l1 + 0.2 * l2 + 0.1 * l3, 18), 24)
            value = min(max(math.exp(log), 1e6), 1e11)
            assert got[(k, year)] == pytest.approx(value)
            l1, l2, l3 = math.log(max(value, 1)), l1, l2
    assert min(got.values()) == pytest.approx(math.exp(18))


def test_roll_advances_the_year_feature(spark):
    df = spark.createDataFrame([("p", 2023, 0.0)], "k string, year int, l1 double")
    step = forecasting.linear_step(0.0, {"year": 0.001})
    got = forecasting.roll(df, [2024, 2026], step, ["l1"], ["k"], None, None).orderBy("target_year").collect()
    assert [r["forecast"] for r in got] == pytest.approx([math.exp(2.024), math.exp(2.026)])


def test_roll_reads_its_input_once(spark):
    df = spark.range(10).selectExpr("id as k", "2023 as year", "cast(20 as double) l1")
    step = forecasting.linear_step(0.0, {"l1": 1.0})
    plan = forecasting.roll(df, [2024, 2025, 2026], step, ["l1"], ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "Exchange" not in plan


def test_forecast_one_and_totals(spark):
    data = [("A", "p", 2022, 50.0, math.log(40)), ("A", "p", 2023, 100.0, math.log(50)), ("A", "p", 2023, 200.0, math.log(50)), ("A", "q", 2023, 30.0, math.log(20))]
    panel = spark.createDataFrame(data, "partner string, hs string, year int, imports double, lag1 double")

    class Same:
        """A stand-in model that predicts the lag feature."""

        def transform(self, df):
            return df.withColumn("prediction", F.col("lag1"))

    got = forecasting.forecast_one(panel, Same(), "imports", "lag1", ["partner", "hs"], ["imports"])
    assert sorted((r["hs"], r["target_year"], r["latest_value"], round(r["raw_forecast"], 9)) for r in got.collect()) == [
        ("p", 2024, 100.0, 100.0), ("q", 2024, 30.0, 30.0)
    ]
    totals = forecasting.forecast_totals(got, "partner", {"hs": "All"}, "raw_forecast")
    assert {(r["hs"], round(r["raw_forecast"], 4)) for r in totals.collect()} == {("p", 100.0), ("q", 30.0), ("All", 130.0)}


def test_log_correction(spark):
    rng = np.random.default_rng(2)
    predicted = np.exp(rng.normal(20, 1, 12))
    actual = predicted**1.1 * np.exp(rng.normal(0, 0.1, 12))
    df = spark.createDataFrame([(i, float(x), float(z)) for i, (x, z) in enumerate(zip(actual, predicted))], "i int, a double, p double")
    df = df.unionByName(spark.createDataFrame([(99, None, 5.0), (98, 5.0, None)], "i int, a double, p double"))
    got = {r["i"]: r for r in forecasting.log_correction(df, "a", "p").collect()}
    lp, gap = np.log(predicted), np.log(actual) - np.log(predicted)
    slope, intercept = np.polyfit(lp, gap, 1)
    want = np.exp(lp + intercept + slope * lp)
    assert [got[i]["corrected"] for i in range(12)] == pytest.approx(list(want), rel=1e-6)
    assert got[3]["change_raw_pct"] == pytest.approx((predicted[3] - actual[3]) / actual[3] * 100)
    assert got[99]["corrected"] is not None and got[99]["change_raw_pct"] is None
    assert got[98]["corrected"] is None


def test_registered_fits_have_their_full_size(spark, monkeypatch):
    searched, compared, fitted = {}, {}, []

    class Stop(Exception):
        pass

    def search(folded, inputs, label, kind, candidates, folds):
        searched[kind] = (candidates, list(folds))
        return spark.createDataFrame([(0, "p", 0.5)], "candidate int, params string, r2 double")

    def compare(folded, inputs, label, kinds):
        compared.update(kinds)
        raise Stop

    def fit(rows, inputs, label, kind, **params):
        fitted.append((kind, params))
        raise Stop

    monkeypatch.setattr(model_queries, "_panel_folds", lambda *a: None)
    monkeypatch.setattr(model_queries, "written_model_rows", lambda *a: None)
    monkeypatch.setattr(forecast_queries, "_history", lambda *a: None)
    monkeypatch.setattr(validation, "search", search)
    monkeypatch.setattr(model_queries.modelling, "compare_models", compare)
    monkeypatch.setattr(models, "fit", fit)
    assert {r.model for r in model_queries.grid_search(spark, "").collect()} == {"forest", "boost"}
    for run in (model_queries.model_compare, model_queries.rf_fit, model_queries.gbt_fit, forecast_queries.forecast_all_features):
        with pytest.raises(Stop):
            run(spark, "")
    assert searched == {
        "forest": (validation.grid(**fixed.FOREST_GRID), [1, 2, 3, 4, 5]), "boost": (validation.grid(**fixed.BOOST_GRID), [1, 2, 3, 4, 5])
    }
    assert [len(searched[k][0]) for k in ("forest", "boost")] == [27, 72]
    assert compared["forest"][1]["trees"] == 100 and compared["boost"] == ("boost", fixed.BOOST_DEFAULT)
    assert [(kind, params["trees"]) for kind, params in fitted] == [("forest", 100), ("boost", 200), ("boost", 200)]
