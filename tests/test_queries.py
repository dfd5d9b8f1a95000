"""Every registered query against its SQL counterpart, and row checks for the others."""

import functools

import duckdb
import pytest

import __spark_entry__
from check_queries import TABLES, compare, plain
from tradepanel.catalog import concepts, oracles, runners
from tradepanel.operators import skew

RUNNERS = runners()
ORACLES = oracles()


@pytest.fixture(scope="module")
def db(folder):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(RUNNERS)


def test_entry_gives_rows(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["year", "hs_code", "product", "imports", "exports", "trade_volume", "partner"]
    assert df.limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, folder, db, name):
    if name == "one_hot":
        pytest.skip("the SQL form lists every level; the smallest tables lack some")
    df = RUNNERS[name](spark, folder)
    result = db.sql(ORACLES[name])
    order = sorted(result.columns)
    assert sorted(df.columns) == order
    left = [tuple(plain(r[c]) for c in order) for r in df.collect()]
    right = [tuple(plain(r[result.columns.index(c)]) for c in order) for r in result.fetchall()]
    assert compare(order, left, right) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert unwanted not in plan


@pytest.mark.parametrize("name", ["trade_balance", "pair_distance", "agreement_adjust"])
def test_salted_joins_give_the_same_result(spark, folder, db, name, monkeypatch):
    """Every dimension taken as large, so that all frequent keys are salted."""
    salted = functools.partial(skew.join_dimension, large=0, salts=4)
    monkeypatch.setattr(concepts, "join_dimension", salted)
    df = RUNNERS[name](spark, folder)
    assert "_salt" in df._jdf.queryExecution().optimizedPlan().toString()
    result = db.sql(ORACLES[name])
    order = sorted(result.columns)
    left = [tuple(plain(r[c]) for c in order) for r in df.collect()]
    right = [tuple(plain(r[result.columns.index(c)]) for c in order) for r in result.fetchall()]
    assert compare(order, left, right) is None


@pytest.mark.parametrize("name", sorted(set(RUNNERS) - set(ORACLES)))
def test_runs_without_sql(spark, folder, name):
    if name in ("grid_search", "model_compare", "search_all_features", "regularised_boost"):
        pytest.skip("needs more panel rows than the smallest tables give; tested on made rows")
    df = RUNNERS[name](spark, folder)
    assert len(df.columns) == len(set(df.columns))
    assert df.count() >= 0
