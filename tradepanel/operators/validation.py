"""Time-ordered folds, fold metrics and hyper-parameter search."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradepanel.operators import boosting, forests, models
from tradepanel.operators.features import moments
from tradepanel.operators.ordering import INDEX, with_row_index

FOLD = "fold"
PARALLEL_FITS = 4
SMALL_FITS = 12  # fits at the same time whose models take little of the driver's memory


def _side_by_side(work: Callable, items: Iterable, threads: int = PARALLEL_FITS) -> list:
    """Results of independent Spark jobs started from a few threads, in order."""
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(work, items))


def expanding_folds(df: DataFrame, order: Sequence[str], splits: int = 5) -> DataFrame:
    """Number the test fold of every row under a global time order.

    With size = n div (splits + 1), fold k (1 .. splits) tests the k-th of the last
    ``splits`` blocks and trains on all rows before it, that is on every fold < k.
    """
    indexed = with_row_index(df, order)
    total = indexed.agg(F.count(F.lit(1)).alias("n")).scalar()
    size = F.floor(total / F.lit(splits + 1))
    lead = total - size * F.lit(splits)
    return indexed.withColumn(
        FOLD,
        F.when(F.col(INDEX) < lead, F.lit(0))
        .otherwise(F.floor(F.try_divide(F.col(INDEX) - lead, size)) + 1)
        .cast("int"),
    )


def block_folds(df: DataFrame, order: Sequence[str], folds: int = 5) -> DataFrame:
    """Contiguous folds of near-equal size; the first n mod folds get one row more."""
    indexed = with_row_index(df, order)
    total = indexed.agg(F.count(F.lit(1)).alias("n")).scalar()
    small = F.floor(total / F.lit(folds))
    extra = F.pmod(total, F.lit(folds))
    head = extra * (small + 1)
    in_head = F.floor(F.col(INDEX) / (small + 1))
    in_tail = extra + F.floor(F.try_divide(F.col(INDEX) - head, small))
    return indexed.withColumn(
        FOLD, (F.when(F.col(INDEX) < head, in_head).otherwise(in_tail) + 1).cast("int")
    )


def year_splits(df: DataFrame, last: int = 5, year: str = "year") -> DataFrame:
    """Train and test row counts of each of the last years; years without either are left out."""
    counts = df.groupBy(year).agg(F.count(F.lit(1)).alias("test_rows"))
    # one row per calendar year, so a single ordered window is enough
    before = Window.orderBy(year).rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.withColumn("train_rows", F.sum("test_rows").over(before))
        .orderBy(F.col(year).desc())
        .limit(last)
        .where(F.col("train_rows").isNotNull())
    )


def holdout(df: DataFrame, keys: Sequence[str], train_share: float = 0.8, out: str = "in_train") -> DataFrame:
    """Reproducible random split by a hash of the row key."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(10_000))
    return df.withColumn(out, bucket < int(train_share * 10_000))


def fold_metrics(
    df: DataFrame, label: str, prediction: str, params: int, by: Sequence[str] = (FOLD,)
) -> DataFrame:
    """R2, MAE, MSE, RMSE, AIC and BIC per fold, from one aggregation."""
    error = F.col(label) - F.col(prediction)
    sums = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(error * error).alias("sse"),
        F.sum(F.abs(error)).alias("sae"),
        F.var_pop(label).alias("label_var"),
    )
    aic, bic = models.information_criteria(F.col("sse"), F.col("n"), params)
    return sums.select(
        *by,
        "n",
        (1 - F.try_divide(F.col("sse"), F.col("label_var") * F.col("n"))).alias("r2"),
        (F.col("sae") / F.col("n")).alias("mae"),
        (F.col("sse") / F.col("n")).alias("mse"),
        F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
        aic.alias("aic"),
        bic.alias("bic"),
    )


METRICS = ["r2", "mae", "mse", "rmse", "aic", "bic"]


def average_metrics(per_fold: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return per_fold.groupBy(*by).agg(*[F.avg(m).alias(m) for m in METRICS])


def residuals(df: DataFrame, label: str, prediction: str, out: str = "residual") -> DataFrame:
    return df.withColumn(out, F.col(label) - F.col(prediction))


def fold_predictions(
    folded: DataFrame, features: Sequence[str], label: str, kind: str, folds: Iterable[int], **params
) -> tuple[DataFrame, list]:
    """Fit on every fold before k and predict fold k, for each k."""
    folds = list(folds)
    fitted = _side_by_side(
        lambda k: models.fit(folded.where(F.col(FOLD) < k), features, label, kind, **params), folds
    )
    parts = [models.predict(m, folded.where(F.col(FOLD) == k)).dropna(subset=[models.PREDICTION]) for k, m in zip(folds, fitted)]
    return reduce(DataFrame.unionByName, parts), fitted


def year_forward(
    df: DataFrame, features: Sequence[str], label: str, kind: str, last: int = 5, year: str = "year", **params
) -> DataFrame:
    """R2 of each of the last years, with the model fitted on all years before it."""
    years = [r[year] for r in year_splits(df, last, year).select(year).orderBy(year).collect()]
    fitted = _side_by_side(
        lambda y: models.fit(df.where(F.col(year) < y), features, label, kind, **params), years
    )
    parts = [models.predict(m, df.where(F.col(year) == y)).dropna(subset=[models.PREDICTION]) for y, m in zip(years, fitted)]
    scored = reduce(DataFrame.unionByName, parts)
    return fold_metrics(scored, label, models.PREDICTION, len(features) + 1, [year])


def average_coefficients(fitted: Sequence) -> dict[str, float]:
    tables = [models.coefficients(m) for m in fitted]
    return {f: float(np.mean([t[f] for t in tables])) for f in tables[0]}


def grid(**axes: Sequence) -> list[dict]:
    """All combinations of the listed parameter values."""
    return [dict(zip(axes, values)) for values in product(*axes.values())]


def search(
    folded: DataFrame, features: Sequence[str], label: str, kind: str, candidates: Sequence[dict],
    folds: Sequence[int], forward: bool = True,
) -> DataFrame:
    """Mean fold R2 of every parameter set, best first.

    ``forward`` trains on earlier folds only; otherwise on all other folds. Forward searches
    over trees are staged. Each fit of the others is a Spark job over the whole training part;
    all scores are taken in one aggregation.
    """
    if forward and kind == "forest":
        return forests.search(folded, features, label, candidates, folds)
    if forward and kind == "boost":
        return boosting.search(folded, features, label, candidates, folds)
    tries = [(i, params, k) for i, params in enumerate(candidates) for k in folds]

    def score(one: tuple) -> DataFrame:
        i, params, k = one
        train = F.col(FOLD) < k if forward else F.col(FOLD) != k
        model = models.fit(folded.where(train), features, label, kind, **params)
        part = models.predict(model, folded.where(F.col(FOLD) == k).select(FOLD, label, *features))
        part = part.dropna(subset=[models.PREDICTION])
        return part.select(
            F.lit(i).alias("candidate"), F.lit(_label_of(params)).alias("params"), FOLD, label, models.PREDICTION
        )

    scored = reduce(DataFrame.unionByName, _side_by_side(score, tries))
    per_fold = fold_metrics(scored, label, models.PREDICTION, len(features) + 1, ["candidate", "params", FOLD])
    return per_fold.groupBy("candidate", "params").agg(F.avg("r2").alias("r2")).orderBy(
        F.col("r2").desc(), "candidate"
    )


def _label_of(params: dict) -> str:
    return ", ".join(f"{k}={v}" for k, v in params.items())


def linear_search(
    folded: DataFrame, features: Sequence[str], label: str, alphas: Sequence[float], penalty: str = "ridge",
    folds: Sequence[int] = (1, 2, 3, 4, 5), forward: bool = True,
) -> DataFrame:
    """Mean fold R2 of ridge or lasso for all penalties from a single pass.

    The cross products of each fold are summed by Spark; training sets are sums of
    folds, so no fit or score reads the rows again. Only one row per fold, with
    (features + 2)^2 / 2 numbers, reaches the driver.
    """
    folded = folded.dropna(subset=[*features, label])  # complete rows only, as in a fit
    scale = moments(folded, [*features, label])
    # centring and scaling by the overall moments only keeps the sums well conditioned
    scaled = folded.select(
        FOLD,
        *[((F.col(c) - F.lit(scale[c][0])) / F.lit(scale[c][1])).alias(c) for c in features],
        (F.col(label) - F.lit(scale[label][0])).alias(label),
    )
    names, target = list(features), label
    rows = {r[FOLD]: r for r in models.gram(scaled, names, target, [FOLD]).collect()}
    terms = models.gram_terms(names, target)
    order = [None, *names, target]
    place = {c: i for i, c in enumerate(order)}

    def matrix(row) -> np.ndarray:
        out = np.zeros((len(order), len(order)))
        for name, (a, b) in terms.items():
            out[place[a], place[b]] = out[place[b], place[a]] = row[name]
        return out

    sums = {k: matrix(r) for k, r in rows.items()}
    scores = []
    for alpha in alphas:
        r2 = []
        for k in folds:
            train = sum(m for f, m in sums.items() if (f < k if forward else f != k))
            beta = _solve(train, alpha, penalty)
            r2.append(_r2(sums[k], beta))
        scores.append((float(alpha), float(np.mean(r2))))
    return (
        folded.sparkSession.createDataFrame(scores, "alpha double, r2 double")
        .orderBy(F.col("r2").desc(), "alpha")
    )


def _solve(gram: np.ndarray, alpha: float, penalty: str) -> np.ndarray:
    """Intercept and coefficients from cross products, features scaled on the training part."""
    n = gram[0, 0]
    mean = gram[0, 1:] / n
    centred = gram[1:, 1:] / n - np.outer(mean, mean)
    dev = np.sqrt(np.maximum(np.diag(centred)[:-1], 1e-300))
    dev[dev < 1e-12] = 1.0
    xx = centred[:-1, :-1] / np.outer(dev, dev)
    xy = centred[:-1, -1] / dev
    if penalty == "ridge":
        beta = np.linalg.solve(xx + np.eye(len(dev)) * alpha / n, xy)
    else:
        beta = np.zeros(len(dev))
        for _ in range(1000):
            last = beta.copy()
            for j in range(len(dev)):
                if xx[j, j] < 1e-12:
                    continue
                rest = xy[j] - xx[j] @ beta + xx[j, j] * beta[j]
                beta[j] = np.sign(rest) * max(abs(rest) - alpha, 0.0) / xx[j, j]
            if np.max(np.abs(beta - last)) < 1e-12:
                break
        else:
            raise ArithmeticError(f"lasso with alpha {alpha} did not settle in 1000 sweeps")
    beta = beta / dev
    return np.concatenate([[mean[-1] - mean[:-1] @ beta], beta])


def _r2(gram: np.ndarray, beta: np.ndarray) -> float:
    n, y = gram[0, 0], gram[0, -1]
    sst = gram[-1, -1] - y * y / n
    sse = gram[-1, -1] - 2 * beta @ gram[:-1, -1] + beta @ gram[:-1, :-1] @ beta
    return 1.0 - sse / sst


def best_model(summary: DataFrame, name: str = "model", score: str = "r2") -> Column:
    """Name of the best-scoring row, as a scalar subquery column."""
    return summary.agg(F.max_by(name, score).alias("best")).scalar()
