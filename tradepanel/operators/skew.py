"""Joins whose cost does not hang on one hot key.

A fact row is joined to at most one dimension row. If the dimension is small, Spark
broadcasts it and key frequencies do not matter. Otherwise rows of frequent keys would
meet in one task, so those keys get a salt: fact rows are spread over the salts by a
hash, and only the dimension rows of frequent keys are repeated, once per salt.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FREQUENT_SHARE = 0.001
SALTS = 64


def broadcast_limit(spark: SparkSession) -> int:
    """Largest side, in bytes, that Spark broadcasts by itself; negative if it broadcasts none."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)i?b?", spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def planned_bytes(df: DataFrame) -> int:
    """Size of a frame as Spark's planner sees it; for a table scan that of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def frequent_keys(df: DataFrame, key: str, share: float = FREQUENT_SHARE) -> list:
    """Keys that may hold more than ``share`` of the rows: a superset, at most 1 / share long.

    One pass with bounded memory per task; a key listed in vain costs only its salts.
    """
    found = df.select(key).dropna().freqItems([key], share).first()[0]
    return list(found or [])


def join_dimension(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    spread_by: Sequence[str],
    how: str = "inner",
    fact_scan: DataFrame | None = None,
    dim_scan: DataFrame | None = None,
    large: int | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join facts to a dimension with unique keys, safe for hot fact keys.

    ``spread_by`` are fact columns that differ between rows of one key. The scans are the
    bare tables behind both sides: key frequencies and the dimension's size are taken
    from them, so that nothing derived is computed twice. ``large`` is the size above which a
    dimension is not broadcast, by default the session's own setting.
    """
    if how not in ("inner", "left"):
        raise ValueError("a dimension is joined inner or left")
    match = F.col(fact_key) == F.col(dim_key)
    if large is None:
        large = broadcast_limit(facts.sparkSession)
    if planned_bytes(dim_scan if dim_scan is not None else dim) <= large:
        return facts.join(dim, match, how)
    hot = frequent_keys(fact_scan if fact_scan is not None else facts, fact_key)
    if not hot:
        return facts.join(dim, match, how)
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    salted_facts = facts.withColumn("_salt", F.when(F.col(fact_key).isin(hot), salt).otherwise(F.lit(0)))
    repeats = F.when(F.col(dim_key).isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_dim = dim.withColumn("_dim_salt", F.explode(repeats))
    return salted_facts.join(salted_dim, match & (F.col("_salt") == F.col("_dim_salt")), how).drop("_salt", "_dim_salt")
