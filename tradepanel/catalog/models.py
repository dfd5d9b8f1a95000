"""Estimator and validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradepanel.catalog.concepts import HOME, define, orders, table, with_tables, year_span
from tradepanel.catalog.domain import geo
from tradepanel.catalog.features import FEATURES, KEY, LABEL, written_model_rows
from tradepanel.catalog.registry import query
from tradepanel.functions import fixed_values as fixed
from tradepanel.functions.scalars import log_floor
from tradepanel.operators import boosting, joins, models, validation
from tradepanel.plans import modelling
from tradepanel.session import fresh_path, materialise
from tradepanel.sources.stores import load_model, save_model

# --- linear fits on all order lines, with their closed forms in SQL ----------------------

_RIDGE_ALPHA = 5000.0
_LASSO_ALPHA = 0.1


def _line_rows(spark, folder):
    """Three columns of the fact table: scanning them again is cheaper than writing them."""
    return table(spark, folder, "lineitem").select(
        "l_quantity", "l_discount", log_floor("l_extendedprice").alias("log_price")
    )


def _two_feature_sql(penalty: str, digits: int) -> str:
    """Coefficients on scaled features of a fit with two features."""
    return f"""
        WITH s AS (SELECT corr(l_quantity, l_discount) AS r, avg(y) AS m,
                          covar_pop(l_quantity, y) / stddev_pop(l_quantity) AS a,
                          covar_pop(l_discount, y) / stddev_pop(l_discount) AS b,
                          1 + {penalty} AS d
                   FROM (SELECT *, ln(greatest(l_extendedprice, 1.0)) AS y FROM lineitem))
        SELECT 'l_quantity' AS feature, round((d * a - r * b) / (d * d - r * r), {digits}) AS coefficient FROM s
        UNION ALL SELECT 'l_discount', round((d * b - r * a) / (d * d - r * r), {digits}) FROM s
        UNION ALL SELECT '(intercept)', round(m, {digits}) FROM s"""


def _coefficients(spark, model, digits: int):
    return models.coefficient_frame(spark, models.coefficients(model)).withColumn(
        "coefficient", F.round("coefficient", digits)
    )


@query("ols_fit", _two_feature_sql("0", 6))
def ols_fit(spark, folder):
    model = models.fit(_line_rows(spark, folder), ["l_quantity", "l_discount"], "log_price", "ols")
    return _coefficients(spark, model, 6)


@query("ridge_fit", _two_feature_sql(f"{_RIDGE_ALPHA} / count(*)", 6))
def ridge_fit(spark, folder):
    model = models.fit(
        _line_rows(spark, folder), ["l_quantity", "l_discount"], "log_price", "ridge", alpha=_RIDGE_ALPHA
    )
    return _coefficients(spark, model, 6)


@query(
    "lasso_fit",
    f"""WITH s AS (SELECT covar_pop(l_quantity, y) / stddev_pop(l_quantity) AS a, avg(y) AS m
                   FROM (SELECT *, ln(greatest(l_extendedprice, 1.0)) AS y FROM lineitem))
        SELECT 'l_quantity' AS feature, round(sign(a) * greatest(abs(a) - {_LASSO_ALPHA}, 0), 4) AS coefficient FROM s
        UNION ALL SELECT '(intercept)', round(m, 4) FROM s""",
)
def lasso_fit(spark, folder):
    model = models.fit(_line_rows(spark, folder), ["l_quantity"], "log_price", "lasso", alpha=_LASSO_ALPHA)
    return _coefficients(spark, model, 4)


@query(
    "ols_simple",
    """SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
              round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
              round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem GROUP BY 1""",
)
def ols_simple(spark, folder):
    y, x = "l_extendedprice", "l_quantity"
    return table(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.regr_slope(y, x), 4).alias("slope"), F.round(F.regr_intercept(y, x), 4).alias("intercept"),
        F.round(F.regr_r2(y, x), 6).alias("r2"),
    )


_GRAM = {"one": "CAST(1 AS DOUBLE)", "q": "l_quantity", "d": "l_discount", "t": "l_tax", "y": "ln(greatest(l_extendedprice, 1.0))"}


@query(
    "ols_gram",
    "SELECT l_returnflag, " + ", ".join(
        f"round(sum(({_GRAM[a]}) * ({_GRAM[b]})), 5) AS {a}__{b}"
        for i, a in enumerate(_GRAM) for b in list(_GRAM)[i:]
    ) + " FROM lineitem GROUP BY 1",
)
def ols_gram(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_returnflag", F.col("l_quantity").alias("q"), F.col("l_discount").alias("d"), F.col("l_tax").alias("t"),
        log_floor("l_extendedprice").alias("y"),
    )
    sums = models.gram(rows, ["q", "d", "t"], "y", ["l_returnflag"])
    return sums.withColumns({c: F.round(c, 5) for c in sums.columns if c != "l_returnflag"})


# --- models on the panel -------------------------------------------------------------------


@query("rf_fit")
def rf_fit(spark, folder):
    model = models.fit(written_model_rows(spark, folder), FEATURES, LABEL, "forest", scale=False, trees=100, depth=5)
    return models.ranked_features(spark, model)


@query("gbt_fit")
def gbt_fit(spark, folder):
    """Boosted trees with the product as an indexed category."""
    model = models.fit(
        written_model_rows(spark, folder), FEATURES, LABEL, "boost", scale=False, categories=["product"],
        **fixed.BOOST_DEFAULT,
    )
    return models.ranked_features(spark, model)


@query(
    "feature_rank",
    f"SELECT feature, abs(coefficient) AS importance FROM ({_two_feature_sql('0', 6)}) WHERE feature <> '(intercept)'",
)
def feature_rank(spark, folder):
    model = models.fit(_line_rows(spark, folder), ["l_quantity", "l_discount"], "log_price", "ols")
    return models.ranked_features(spark, model, 15).withColumn("importance", F.round("importance", 6))


# One feature, so that SQL can state the fit in closed form.
_X = ["log_imports_lag1"]


@query(
    "model_roundtrip",
    with_tables("model_rows", body="""
        SELECT year, partner, hs_code, product, round(i + s * log_imports_lag1, 6) AS prediction
        FROM model_rows CROSS JOIN (SELECT regr_slope(log_imports, log_imports_lag1) AS s,
                                           regr_intercept(log_imports, log_imports_lag1) AS i FROM model_rows)"""),
)
def model_roundtrip(spark, folder):
    """Fit, store, load under the feature contract, and score the panel."""
    rows = written_model_rows(spark, folder)
    path = fresh_path(spark, "model")
    save_model(models.fit(rows, _X, LABEL, "ols"), path)
    scored = models.predict(load_model(path, _X), rows)
    return scored.select(*KEY, F.round(models.PREDICTION, 6).alias(models.PREDICTION))


# --- folds and metrics -----------------------------------------------------------------------


def _order_scores(spark, folder):
    """Orders with a log label and a fixed linear predictor."""
    return orders(spark, folder).select(
        "o_orderdate", "o_orderkey", log_floor(F.col("total").cast("double")).alias("label"),
        (F.lit(11.0) + F.lit(0.1) * log_floor(F.col("buyer_balance").cast("double"))).alias("prediction"),
    )


_SCORED = """
    SELECT o_orderkey, ln(greatest(CAST(total AS DOUBLE), 1.0)) AS label,
           11.0 + 0.1 * ln(greatest(CAST(buyer_balance AS DOUBLE), 1.0)) AS prediction,
           row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i, count(*) OVER () AS n
    FROM order_rows"""
_FOLDED = f"""
    SELECT *, CAST(CASE WHEN i < n - 5 * (n // 6) THEN 0 ELSE (i - (n - 5 * (n // 6))) // (n // 6) + 1 END AS INT) AS fold
    FROM ({_SCORED})"""
_SUMS = f"""
    SELECT fold, count(*) AS n, sum((label - prediction) * (label - prediction)) AS sse,
           sum(abs(label - prediction)) AS sae, var_pop(label) AS v
    FROM ({_FOLDED}) WHERE fold > 0 GROUP BY 1"""


def _folded(spark, folder):
    return validation.expanding_folds(_order_scores(spark, folder), ["o_orderdate", "o_orderkey"])


@query("time_folds", with_tables("order_rows", body=f"SELECT o_orderkey, fold FROM ({_FOLDED})"))
def time_folds(spark, folder):
    return _folded(spark, folder).select("o_orderkey", "fold")


@query(
    "block_folds",
    """SELECT o_orderkey, CAST(CASE WHEN i < (n % 7) * (n // 7 + 1) THEN i // (n // 7 + 1)
                               ELSE n % 7 + (i - (n % 7) * (n // 7 + 1)) // (n // 7) END + 1 AS INT) AS fold
       FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i, count(*) OVER () AS n
             FROM orders)""",
)
def block_folds(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return validation.block_folds(rows, ["o_orderdate", "o_orderkey"], 7).select("o_orderkey", "fold")


@query(
    "cv_metrics",
    with_tables("order_rows", body=f"""
        SELECT fold, n, round(1 - sse / (v * n), 6) AS r2, round(sae / n, 6) AS mae, round(sse / n, 6) AS mse,
               round(sqrt(sse / n), 6) AS rmse FROM ({_SUMS})"""),
)
def cv_metrics(spark, folder):
    tested = _folded(spark, folder).where("fold > 0")
    metrics = validation.fold_metrics(tested, "label", "prediction", 2)
    return metrics.select("fold", "n", *[F.round(c, 6).alias(c) for c in ("r2", "mae", "mse", "rmse")])


@query(
    "aic_bic",
    with_tables("order_rows", body=f"""
        SELECT round(avg(2 * 2.0 + sse), 4) AS aic, round(avg(2.0 * ln(n) + sse), 4) AS bic,
               round(avg(1 - sse / (v * n)), 6) AS r2 FROM ({_SUMS})"""),
)
def aic_bic(spark, folder):
    tested = _folded(spark, folder).where("fold > 0")
    mean = validation.average_metrics(validation.fold_metrics(tested, "label", "prediction", 2))
    return mean.select(F.round("aic", 4).alias("aic"), F.round("bic", 4).alias("bic"), F.round("r2", 6).alias("r2"))


@query(
    "residuals",
    with_tables("order_rows", body=f"""
        SELECT o_orderkey, round(label, 8) AS label, round(prediction, 8) AS prediction,
               round(label - prediction, 8) AS residual FROM ({_SCORED})"""),
)
def residuals(spark, folder):
    rows = validation.residuals(_order_scores(spark, folder), "label", "prediction")
    return rows.select("o_orderkey", *[F.round(c, 8).alias(c) for c in ("label", "prediction", "residual")])


@query(
    "year_splits",
    with_tables("order_rows", body="""
        SELECT year, test_rows, train_rows FROM (
            SELECT year, count(*) AS test_rows,
                   CAST(sum(count(*)) OVER (ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS train_rows
            FROM order_rows GROUP BY 1 ORDER BY year DESC LIMIT 5) WHERE train_rows IS NOT NULL"""),
)
def year_splits(spark, folder):
    return validation.year_splits(orders(spark, folder).select("year"))


@query("holdout")
def holdout(spark, folder):
    return validation.holdout(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"])


def _panel_folds(spark, folder):
    """Model rows with their time fold and the hash of their key, written once for all fits."""
    folded = validation.expanding_folds(written_model_rows(spark, folder), KEY)
    return materialise(folded.withColumn(boosting.ROW_KEY, F.xxhash64(*KEY)), "folded")


_PANEL_FOLDS = """
    SELECT *, CAST(CASE WHEN i < n - 5 * (n // 6) THEN 0 ELSE (i - (n - 5 * (n // 6))) // (n // 6) + 1 END AS INT) AS fold
    FROM (SELECT log_imports AS y, log_imports_lag1 AS x, year,
                 row_number() OVER (ORDER BY year, partner, hs_code, product) - 1 AS i, count(*) OVER () AS n
          FROM model_rows)"""
define("panel_folds", ["model_rows"], _PANEL_FOLDS)
define("fold_fits", ["panel_folds"], """
    SELECT k, count(*) AS n, avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my, covar_pop(x, y) / stddev_pop(x) AS c
    FROM panel_folds CROSS JOIN (SELECT unnest(range(1, 6)) AS k) WHERE fold < k GROUP BY 1""")


@query(
    "coef_avg",
    with_tables("fold_fits", body="""
        SELECT 'log_imports_lag1' AS feature, round(avg(c), 6) AS coefficient FROM fold_fits
        UNION ALL SELECT '(intercept)', round(avg(my), 6) FROM fold_fits"""),
)
def coef_avg(spark, folder):
    """Coefficients on the scaled feature, averaged over the expanding folds."""
    _, fitted = validation.fold_predictions(_panel_folds(spark, folder), _X, LABEL, "ols", range(1, 6))
    return models.coefficient_frame(spark, validation.average_coefficients(fitted)).withColumn(
        "coefficient", F.round("coefficient", 6)
    )


@query(
    "year_forward",
    with_tables(
        "model_rows",
        fits="""
            SELECT t.year, regr_slope(r.log_imports, r.log_imports_lag1) AS s,
                   regr_intercept(r.log_imports, r.log_imports_lag1) AS i
            FROM (SELECT DISTINCT year FROM model_rows ORDER BY 1 DESC LIMIT 5) t
            JOIN model_rows r ON r.year < t.year GROUP BY 1""",
        body="""
            SELECT r.year, count(*) AS n,
                   round(1 - sum((log_imports - i - s * log_imports_lag1) ** 2) / (var_pop(log_imports) * count(*)), 6) AS r2,
                   round(sqrt(avg((log_imports - i - s * log_imports_lag1) ** 2)), 6) AS rmse
            FROM model_rows r JOIN fits f ON f.year = r.year GROUP BY 1""",
    ),
)
def year_forward(spark, folder):
    """Scores of the last years, each with the model fitted on the years before it."""
    out = validation.year_forward(written_model_rows(spark, folder), _X, LABEL, "ols")
    return out.select("year", "n", F.round("r2", 6).alias("r2"), F.round("rmse", 6).alias("rmse"))


def _search_sql(alphas, beta: str) -> str:
    """Mean R2 over the folds per penalty, for a coefficient on the scaled feature."""
    listed = ", ".join(f"CAST({a} AS DOUBLE)" for a in alphas)
    return with_tables("fold_fits", body=f"""
        SELECT alpha, round(avg(r2), 6) AS r2 FROM (
            SELECT alpha, k, 1 - sum((y - my - b * (x - mx) / sx) ** 2) / (var_pop(y) * count(*)) AS r2
            FROM (SELECT f.*, alpha, {beta} AS b FROM fold_fits f CROSS JOIN (SELECT unnest([{listed}]) AS alpha)) f
            JOIN panel_folds ON fold = k GROUP BY 1, 2) GROUP BY 1""")


@query("ridge_search", _search_sql(fixed.RIDGE_ALPHAS, "c / (1 + alpha / n)"))
def ridge_search(spark, folder):
    out = validation.linear_search(_panel_folds(spark, folder), _X, LABEL, fixed.RIDGE_ALPHAS)
    return out.withColumn("r2", F.round("r2", 6))


@query("lasso_search", _search_sql(fixed.LASSO_ALPHAS, "sign(c) * greatest(abs(c) - alpha, 0)"))
def lasso_search(spark, folder):
    out = validation.linear_search(_panel_folds(spark, folder), _X, LABEL, fixed.LASSO_ALPHAS, "lasso")
    return out.withColumn("r2", F.round("r2", 6))


@query("search_all_features")
def search_all_features(spark, folder):
    """All features and penalties, still one pass over the rows."""
    return validation.linear_search(_panel_folds(spark, folder), FEATURES, LABEL, fixed.RIDGE_ALPHAS)


@query("grid_search")
def grid_search(spark, folder):
    """Forest and boosted-tree search over the full grids on all expanding folds, best first.

    Forests are scored at every size and depth of one fit, boosted trees after every stage of one model; models of the boosted grid
    grow side by side. Both searches run at the same time, as neither has tasks for all cores.
    """
    folded = _panel_folds(spark, folder)
    grids = (("forest", fixed.FOREST_GRID), ("boost", fixed.BOOST_GRID))
    searches = [(folded, FEATURES, LABEL, kind, validation.grid(**axes), range(1, 6)) for kind, axes in grids]
    found, boosted = validation._side_by_side(lambda one: validation.search(*one), searches)
    both = found.withColumn("model", F.lit("forest")).unionByName(boosted.withColumn("model", F.lit("boost")))
    return both.orderBy(F.col("r2").desc(), "model", "candidate")


_SPLIT = {"large": "l_quantity > 30", "returned": "l_returnflag = 'R'", "rebated": "l_discount > 0.05"}
_SPLIT_L1, _SPLIT_L2, _SPLIT_RATE = 1.0, 2.0, 0.05


@query(
    "boost_split",
    "WITH y AS (SELECT *, ln(greatest(l_extendedprice, 1.0)) AS y FROM lineitem), b AS (SELECT *, y - avg(y) OVER () AS g FROM y), s AS ("
    + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, sum(CASE WHEN {x} THEN 0 ELSE g END) AS gl, count(*) FILTER (WHERE NOT ({x})) AS nl, "
        f"sum(CASE WHEN {x} THEN g ELSE 0 END) AS gr, count(*) FILTER (WHERE {x}) AS nr FROM b"
        for f, x in _SPLIT.items()
    )
    + f"""), v AS (SELECT feature, {_SPLIT_RATE} * sign(gl) * greatest(abs(gl) - {_SPLIT_L1}, 0) / (nl + {_SPLIT_L2}) AS low,
                   {_SPLIT_RATE} * sign(gr) * greatest(abs(gr) - {_SPLIT_L1}, 0) / (nr + {_SPLIT_L2}) AS high,
                   greatest(abs(gl) - {_SPLIT_L1}, 0) ** 2 / (nl + {_SPLIT_L2}) + greatest(abs(gr) - {_SPLIT_L1}, 0) ** 2 / (nr + {_SPLIT_L2}) AS gain FROM s)
        SELECT feature, round(low, 6) AS low, round(high, 6) AS high, round(gain, 4) AS gain FROM v ORDER BY v.gain DESC LIMIT 1""",
)
def boost_split(spark, folder):
    """The one split of a regularised stump on features that are 0 or 1, with its shrunken leaf values."""
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", log_floor("l_extendedprice").alias("y"), *[F.expr(x).cast("double").alias(f) for f, x in _SPLIT.items()]
    )
    setting = boosting.Setting(trees=1, depth=1, rate=_SPLIT_RATE, l1=_SPLIT_L1, l2=_SPLIT_L2)
    model = boosting.fit(rows, list(_SPLIT), "y", setting, F.xxhash64("l_orderkey", "l_linenumber"))
    (feature, gain), tree = next(iter(model.gains.items())), model.trees[0]
    row = (feature, float(tree.value[1]), float(tree.value[2]), gain)
    out = spark.createDataFrame([row], "feature string, low double, high double, gain double")
    return out.select("feature", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), F.round("gain", 4).alias("gain"))


@query("regularised_boost")
def regularised_boost(spark, folder):
    """Gain by feature of boosted trees with L1 and L2 penalties and with rows and features drawn for each tree, at full size."""
    rows = written_model_rows(spark, folder)
    setting = boosting.Setting(l1=1.0, l2=2.0, columns=0.8, **fixed.BOOST_DEFAULT)
    model = boosting.fit(rows, FEATURES, LABEL, setting, F.xxhash64(*KEY))
    found = [(f, model.gains.get(f, 0.0)) for f in FEATURES]
    return spark.createDataFrame(found, "feature string, gain double").orderBy(F.col("gain").desc(), "feature")


@query("model_compare")
def model_compare(spark, folder):
    """Mean fold metrics per kind of model, and the best one by R2."""
    kinds = {
        "ols": ("ols", {}), "ridge": ("ridge", {"alpha": 1.0}), "lasso": ("lasso", {"alpha": 0.1}),
        "forest": ("forest", {"trees": 100, "depth": 5}), "boost": ("boost", fixed.BOOST_DEFAULT),
    }
    means = materialise(modelling.compare_models(_panel_folds(spark, folder), FEATURES, LABEL, kinds), "means")
    return means.withColumn("best", F.col("model") == validation.best_model(means))


@query("learned_score")
def learned_score(spark, folder):
    """Ridge of imports on the scaled score inputs; the fit is the score, gaps are marked."""
    rows = materialise(geo(spark, folder), "geo")
    model = models.fit(
        rows, ["distance", "gdp_lag1", "rate_log", "adjusted_value", "fta_binary"], "imports", "ridge", alpha=1.0
    )
    scores = models.predict(model, rows, "score").select("partner", "year", F.round("score", 2).alias("score"))
    grid = joins.spine(
        table(spark, folder, "nation").select(F.col("n_name").alias("partner")).where(F.col("partner") != HOME),
        year_span(spark, folder),
    )
    return joins.fill_spine(grid, scores, ["partner", "year"], "score")
