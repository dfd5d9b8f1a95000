"""Histogram boosting and staged searches against plain re-computation."""

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradepanel.catalog import models as model_queries
from tradepanel.operators import boosting, forests, models, validation

SCHEMA = "id long, a double, b double, c double, y double, fold int"


def made(n=1200, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 1)
    y = 2 * x[:, 0] - x[:, 1] ** 2 + 0.1 * rng.normal(size=n)
    return x, y, np.arange(n) * 6 // n


@pytest.fixture(scope="module")
def rows(spark):
    x, y, fold = made()
    return spark.createDataFrame([(i, *map(float, v), float(t), int(k)) for i, (v, t, k) in enumerate(zip(x, y, fold))], SCHEMA).repartition(4)


def plain_boost(x, y, edges, s, trees):
    """Boosting without subsampling, by brute force over the same cuts."""
    bins = np.stack([np.searchsorted(e, v, "left") for v, e in zip(x.T, edges)], 1)
    score = np.full(len(y), y.mean())

    def leaf(g, n):
        return np.sign(g) * max(abs(g) - s.l1, 0) / (n + s.l2)

    def strength(g, n):
        return max(abs(g) - s.l1, 0) ** 2 / (n + s.l2)

    def grow(take, depth, residual, out):
        g, n = residual[take].sum(), take.sum()
        best = (1e-12 * max(1.0, abs(g)), None, None)
        if depth:
            for f in range(bins.shape[1]):
                for cut in range(bins[:, f].max()):
                    left = take & (bins[:, f] <= cut)
                    right = take & ~left
                    if min(left.sum(), right.sum()) >= s.least_rows:
                        gain = strength(residual[left].sum(), left.sum()) + strength(residual[right].sum(), right.sum()) - strength(g, n)
                        if gain > best[0] + 1e-9:
                            best = (gain, f, cut)
        if best[1] is None:
            out[take] = leaf(g, n)
            return
        left = take & (bins[:, best[1]] <= best[2])
        grow(left, depth - 1, residual, out)
        grow(take & ~left, depth - 1, residual, out)

    for _ in range(trees):
        out = np.zeros(len(y))
        grow(np.ones(len(y), bool), s.depth, y - score, out)
        score = score + s.rate * out
    return score


def test_same_as_brute_force(rows):
    s = boosting.Setting(trees=5, depth=3, rate=0.3, l1=1.5, l2=2.0, least_rows=3)
    model = boosting.fit(rows, ["a", "b", "c"], "y", s, F.col("id"))
    x, y, _ = made()
    want = plain_boost(x, y, model.edges, s, 5)
    got = {r["id"]: r["prediction"] for r in boosting.predict(model, rows).collect()}
    assert np.allclose([got[i] for i in range(len(y))], want, atol=1e-9)


def test_same_model_however_rows_are_dealt(rows):
    s = boosting.Setting(trees=4, depth=2, subsample=0.7, columns=0.7, l2=1.0)
    one, four = (boosting.fit(df, ["a", "b", "c"], "y", s, F.col("id")) for df in (rows.coalesce(1), rows.repartition(5)))
    for a, b in zip(one.trees, four.trees):
        assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and np.allclose(a.value, b.value)


def test_odd_rows(spark):
    data = [(1, 1.0, None, 1.0, 2.0, 0), (2, None, 1.0, 1.0, 3.0, 0), (3, 1.0, 1.0, 1.0, None, 0), (4, 1.0, 1.0, 1.0, 4.0, 0), (4, 1.0, 1.0, 1.0, 4.0, 0)]
    df = spark.createDataFrame(data, SCHEMA)
    model = boosting.fit(df, ["a", "b", "c"], "y", boosting.Setting(trees=2), F.col("id"))
    got = sorted((r["id"], r["prediction"]) for r in boosting.predict(model, df).collect() if r["id"] > 2)
    assert got == [(3, 4.0), (4, 4.0), (4, 4.0)]  # nothing to split by
    assert {r["prediction"] for r in boosting.predict(model, df).where("id < 3").collect()} == {None}
    assert boosting.fit(df.limit(0), ["a"], "y", boosting.Setting(trees=1), F.col("id")).base == 0.0


def test_search_scores_stages(rows):
    grid = validation.grid(trees=[2, 5], rate=[0.1, 0.4], depth=[1, 2])
    got = {r["params"]: r["r2"] for r in boosting.search(rows, ["a", "b", "c"], "y", grid, [2, 5], F.col("id")).collect()}
    assert len(got) == 8
    x, y, fold = made()
    scores = []
    for k in (2, 5):
        ensemble = boosting.Ensemble(boosting.Table(rows, ["a", "b", "c"], "y", F.col("id"), F.col("fold")), [boosting.Setting(trees=2, rate=0.4, depth=2, train_below=k, test=k)])
        ensemble.grow(), ensemble.grow()
        n, sse, sae, sy, syy = ensemble.test_sums()[0]
        part = y[fold == k]
        assert n == len(part) and np.isclose(sy, part.sum())
        scores.append(boosting.r2((n, sse, sae, sy, syy)))
    assert np.isclose(got["trees=2, rate=0.4, depth=2"], np.mean(scores))


def test_forest_top_is_the_shallow_forest(rows):
    train, test = rows.where("fold < 4"), rows.where("fold = 4")
    deep = models.fit(train, ["a", "b", "c"], "y", "forest", scale=False, trees=6, depth=6, min_rows=4)
    sums = forests.staged_sums(deep, test, "y", [2, 6], [1, 6])
    for depth in (2, 6):
        shallow = models.fit(train, ["a", "b", "c"], "y", "forest", scale=False, trees=6, depth=depth, min_rows=4)
        want = models.predict(shallow, test).agg(F.count("*"), F.sum((F.col("y") - F.col("prediction")) ** 2)).first()
        assert sums[depth, 6][0] == want[0] and np.isclose(sums[depth, 6][1], want[1])
    first = deep.stages[-1].trees[0]
    want = first.transform(deep.stages[0].transform(test)).agg(F.sum((F.col("y") - F.col("prediction")) ** 2)).first()[0]
    assert np.isclose(sums[6, 1][1], want)


def test_forest_search(rows):
    grid = validation.grid(trees=[2, 4], depth=[1, 3], min_rows=[2, 6])
    got = forests.search(rows, ["a", "b", "c"], "y", grid, [3, 5]).collect()
    assert len(got) == 8 and [r["r2"] for r in got] == sorted((r["r2"] for r in got), reverse=True) and got[0]["r2"] > 0.3


def test_forests_and_boosted_trees_are_searched_at_the_same_time(spark, monkeypatch):
    together = threading.Barrier(2)

    def search(*args):
        together.wait(60)  # raises if the other search is not there
        return spark.createDataFrame([(0, "p", 0.5)], "candidate int, params string, r2 double")

    monkeypatch.setattr(model_queries, "_panel_folds", lambda *a: None)
    monkeypatch.setattr(forests, "search", search)
    monkeypatch.setattr(boosting, "search", search)
    assert [r["model"] for r in model_queries.grid_search(spark, "").collect()] == ["boost", "forest"]


def test_rows_walk_down_trees_that_stop_early():
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 32, (500, 3)).astype(np.uint8)
    for stop in range(16):
        tree = boosting.Tree.empty(4)
        tree.feature[:15], tree.cut[:15] = rng.integers(0, 3, 15), rng.integers(0, 31, 15)
        tree.feature[stop] = -1
        for depth in range(5):
            want = []
            for row in bins:
                node = 0
                for _ in range(depth):
                    if tree.feature[node] >= 0:
                        node = 2 * node + 1 + (row[tree.feature[node]] > tree.cut[node])
                want.append(node)
            assert boosting._walk(tree, bins, depth).tolist() == want


def odd_rows(spark):
    """Rows with missing features and labels, and keys that come twice, in several partitions."""
    x, y, fold = made(900, 8)
    data = [[i // 2, *map(float, v), float(t), int(k)] for i, (v, t, k) in enumerate(zip(x, y, fold))]
    for column, every in ((1, 50), (4, 70)):
        for r in data[::every]:
            r[column] = None
    return spark.createDataFrame([tuple(r) for r in data], SCHEMA).repartition(3)


def test_models_grown_whole_in_tasks_are_those_grown_by_jobs(spark, monkeypatch):
    rows = odd_rows(spark)
    grid = validation.grid(trees=[2, 5], rate=[0.3], depth=[1, 4], subsample=[0.7, 1.0], l2=[1.0])
    found = []
    for most in (boosting.WHOLE_BYTES, 0):
        monkeypatch.setattr(boosting, "WHOLE_BYTES", most)
        got = boosting.search(rows, ["a", "b", "c"], "y", grid, [1, 3, 5], F.col("id")).collect()
        found.append({r["candidate"]: (r["params"], r["r2"]) for r in got})
    whole, shared = found
    assert len(whole) == 8 and {k: v[0] for k, v in whole.items()} == {k: v[0] for k, v in shared.items()}
    assert [whole[k][1] for k in range(8)] == pytest.approx([shared[k][1] for k in range(8)], rel=1e-9)


def test_search_over_few_rows_takes_few_jobs(spark, rows):
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    got = boosting.search(rows, ["a", "b", "c"], "y", validation.grid(trees=[10, 20], depth=[3]), [2, 5], F.col("id")).collect()
    assert len(got) == 2 and len(set(tracker.getJobIdsForGroup(None)) - before) < 20


def test_search_of_no_rows(rows):
    got = boosting.search(rows.limit(0), ["a", "b", "c"], "y", validation.grid(trees=[1, 2], depth=[2]), [2, 5], F.col("id")).collect()
    assert len(got) == 2 and all(np.isnan(r["r2"]) for r in got)


def test_forest_search_over_few_rows_finds_the_same_trees(rows, monkeypatch):
    grid, asked, fit = validation.grid(trees=[3], depth=[2, 5], min_rows=[4]), [], models.fit

    def recorded(*args, **params):
        asked.append("node_ids" in params)
        return fit(*args, **params)

    monkeypatch.setattr(models, "fit", recorded)
    found = []
    for most in (forests.FEW_ROWS, 0):
        monkeypatch.setattr(forests, "FEW_ROWS", most)
        found.append({r["candidate"]: r["r2"] for r in forests.search(rows, ["a", "b", "c"], "y", grid, [3, 5]).collect()})
    assert asked == [True, True, False, False] and found[0] == pytest.approx(found[1], rel=1e-12)
