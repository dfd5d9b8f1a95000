"""Run queries against their SQL counterparts on one data folder.

    python check_queries.py [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from tradepanel.catalog import oracles, runners

TABLES = "region nation customer supplier part orders lineitem events".split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def compare(columns, left, right) -> str | None:
    """First difference between two lists of rows, or None."""
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    rough = lambda row: tuple(
        (v is None, f"{v:.6g}" if isinstance(v, float) else str(v)) for v in row
    )
    exact = 0
    for a, b in zip(sorted(left, key=rough), sorted(right, key=rough)):
        for c, x, y in zip(columns, a, b):
            if x == y:
                continue
            if isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9):
                exact += 1
                continue
            return f"{c}: {x!r} != {y!r} in {a} / {b}"
    return f"close, but {exact} values differ in the last digits" if exact else None


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    sql, bad = oracles(), 0
    for name, run in runners().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            rows = [tuple(r) for r in df.collect()]
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"{name:24s} ERROR {str(error)[:600]}", flush=True)
            continue
        took = time.time() - start
        note = "rows only"
        if name in sql:
            result = db.sql(sql[name])
            order = sorted(result.columns)
            if sorted(df.columns) != order:
                note = f"columns {sorted(df.columns)} != {order}"
            else:
                spark_rows = [tuple(plain(r[df.columns.index(c)]) for c in order) for r in rows]
                duck_rows = [tuple(plain(r[result.columns.index(c)]) for c in order) for r in result.fetchall()]
                types = {c: (dict(df.dtypes)[c], str(result.types[result.columns.index(c)])) for c in order}
                pairs = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
                odd = {c: t for c, t in types.items() if pairs.get(t[0], t[0]).lower() != t[1].lower()}
                note = compare(order, spark_rows, duck_rows) or (f"types {odd}" if odd else "ok")
            bad += note != "ok"
        print(f"{name:24s} {took:6.2f}s {len(rows):7d} rows  {note}", flush=True)
    print("problems:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
