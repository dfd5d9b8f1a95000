import numpy as np
import pytest
from pyspark.sql import functions as F

from tradepanel.operators import categories


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    made = [(i, "abcd"[i % 4], int(i % 3), float(rng.normal()), float(rng.normal())) for i in range(60)]
    made += [(60, None, 1, 1.0, 2.0), (61, "a", None, 1.0, 2.0)]
    return spark.createDataFrame(made, "id int, letter string, digit int, x double, y double")


def dense(data):
    """Constant, x and y, then a column a level, as plain NumPy."""
    data = data.dropna()
    columns = {("one", None): np.ones(len(data)), ("x", None): data.x.to_numpy(), ("y", None): data.y.to_numpy()}
    for c in ("letter", "digit"):
        for v in sorted(data[c].unique()):
            columns[c, str(int(v)) if c == "digit" else v] = (data[c] == v).to_numpy(float)
    return columns


def test_sparse_products_as_dense_ones(rows):
    want = dense(rows.toPandas())
    got = categories.sparse_products(rows, ["x", "y"], ["letter", "digit"]).collect()
    order = list(want)
    seen = {}
    for r in got:
        pair = (r["left"], r.left_level), (r["right"], r.right_level)
        assert pair not in seen and order.index(pair[0]) <= order.index(pair[1])
        seen[pair] = r["product"]
    for i, a in enumerate(order):
        for b in order[i:]:
            assert seen.get((a, b), 0.0) == pytest.approx(float(want[a] @ want[b]), abs=1e-12), (a, b)


def test_positions_leave_out_the_base(rows):
    got = {(r.category, r.level): r.position for r in categories.level_positions(rows, ["letter", "digit"]).collect()}
    assert got == {
        ("letter", "a"): None, ("letter", "b"): 0, ("letter", "c"): 1, ("letter", "d"): 2, ("digit", "0"): None, ("digit", "1"): 3, ("digit", "2"): 4,
    }
    placed = categories.with_positions(rows, ["letter", "digit"], categories.level_positions(rows, ["letter", "digit"]), ["id"], large=0)
    assert placed.count() == 62
    for r in placed.collect():
        assert r.letter_position == got.get(("letter", r.letter)) and r.digit_position == got.get(("digit", str(r.digit)))


def test_numbers_stand_in_their_own_order(spark):
    df = spark.createDataFrame([(v,) for v in (10, 9, 100, 2, -1, 9)], "v int")
    got = {r.level: r.position for r in categories.level_positions(df, ["v"]).collect()}
    assert got == {"-1": None, "2": 0, "9": 1, "10": 2, "100": 3}


def test_absorbed_fit_as_one_column_a_level(rows):
    data = rows.toPandas().dropna()
    levels = sorted(data.letter.unique())
    design = np.column_stack([data.x, *[(data.letter == v).astype(float) for v in levels]])
    want = np.linalg.lstsq(design, data.y, rcond=None)[0]
    slopes, effects = categories.absorbed_fit(rows.dropna(), ["x"], "letter", "y")
    assert slopes["x"] == pytest.approx(want[0])
    assert {r.letter: r.effect for r in effects.collect()} == pytest.approx(dict(zip(levels, want[1:])))
    scored = categories.absorbed_predict(rows, slopes, effects, "letter", ["id"], large=0).toPandas().set_index("id").prediction
    assert np.allclose(scored[data.id], design @ want) and np.isnan(scored[60]) and len(scored) == 62


def test_many_levels_fit(spark):
    df = spark.range(300_000).select(
        F.col("id"), (F.col("id") % 100_000).alias("level"), (F.xxhash64("id") % 1000).cast("double").alias("x"), F.lit(1.0).alias("flat")
    ).withColumn("y", 2 * F.col("x") + F.col("level"))
    slopes, effects = categories.absorbed_fit(df, ["x", "flat"], "level", "y")
    assert slopes["x"] == pytest.approx(2, abs=1e-9) and slopes["flat"] == 0
    assert effects.count() == 100_000 and effects.where(F.abs(F.col("effect") - F.col("level")) > 1e-6).count() == 0
    assert categories.sparse_products(df, ["x"], ["level"]).where("left = 'level' and product = 3").count() == 100_000


def test_incomplete_and_empty_rows(spark, rows):
    odd = rows.union(spark.createDataFrame([(70, "a", 1, float("nan"), 1.0), (71, "b", 1, 1.0, None)], rows.schema))
    assert categories.absorbed_fit(odd, ["x"], "letter", "y")[0] == pytest.approx(categories.absorbed_fit(rows, ["x"], "letter", "y")[0])
    slopes, effects = categories.absorbed_fit(rows.limit(0), ["x"], "letter", "y")
    assert slopes == {"x": 0.0} and effects.count() == 0
    assert categories.level_positions(rows.limit(0), ["letter"]).count() == 0
    assert [r["product"] for r in categories.sparse_products(rows.limit(0), [], ["letter"]).collect()] in ([], [None])


def test_pairs_of_levels_carry_a_count_and_no_sums(rows):
    plan = categories.sparse_products(rows, ["x", "y"], ["letter", "digit"])._jdf.queryExecution().optimizedPlan().toString()
    sums = [line.count("sum(") for line in plan.splitlines() if "Aggregate [" in line]
    assert len(sums) == 3 and sums[2] == 0 and sums[1] < sums[0]
