"""Years come from the tables: an order of a later year shows up everywhere."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from check_queries import TABLES, compare, plain
from tradepanel.catalog import oracles, runners
from tradepanel.operators import skew


@pytest.fixture(scope="module")
def later(folder, tmp_path_factory):
    """The smallest tables with every tenth order moved to 2003, so that 2002 is a gap."""
    out = tmp_path_factory.mktemp("later")
    for name in TABLES:
        rows = pq.read_table(f"{folder}/{name}.parquet")
        if name == "orders":
            frame = rows.to_pandas()
            at = frame.index % 10 == 0
            frame.loc[at, "o_orderdate"] = frame.loc[at, "o_orderdate"].map(lambda d: d.replace(year=2003, day=min(d.day, 28)))
            rows = pa.Table.from_pandas(frame, schema=rows.schema, preserve_index=False)
        pq.write_table(rows, out / f"{name}.parquet")
    return str(out)


@pytest.mark.parametrize("name", ["unpivot_years", "scan_preamble_csv", "indicator_summary", "panel_build"])
def test_later_years_are_kept(spark, later, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{later}/{t}.parquet'")
    result = db.sql(oracles()[name])
    order = sorted(result.columns)
    df = runners()[name](spark, later)
    left = [tuple(plain(r[c]) for c in order) for r in df.collect()]
    right = [tuple(plain(r[result.columns.index(c)]) for c in order) for r in result.fetchall()]
    assert compare(order, left, right) is None
    assert 2003 in {r[order.index("year")] for r in left}


def test_learned_scores_of_later_years_are_kept(spark, later):
    rows = runners()["learned_score"](spark, later).collect()
    years = {r.year for r in rows}
    assert years == set(range(min(years), 2004)) and len(rows) == 24 * len(years)
    assert any(r.score != "No data" for r in rows if r.year == 2003)


@pytest.mark.parametrize("text, size", [("10485760b", 10 << 20), ("10MB", 10 << 20), ("-1", -1), ("2g", 2 << 30)])
def test_broadcast_limit_is_the_sessions(spark, text, size):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        assert skew.broadcast_limit(spark) == size
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
