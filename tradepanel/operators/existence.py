"""Semi and anti joins whose cost does not hang on one hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepanel.operators.skew import SALTS, broadcast_limit, frequent_keys, planned_bytes


def filter_by_members(
    facts: DataFrame, members: DataFrame, fact_key: str, member_key: str, spread_by: Sequence[str], keep: bool = True,
    fact_scan: DataFrame | None = None, large: int | None = None, salts: int = SALTS,
) -> DataFrame:
    """Fact rows whose key is (``keep``) or is not among the members; a null key is among none.

    Repeated members count once. Small member sets are left to Spark's broadcast. For larger ones the rows of
    frequent keys are spread over salts by a hash of ``spread_by``, and only the members that are
    frequent keys are repeated, so a key with a third of the rows is shared by ``salts`` tasks. ``fact_scan`` is the
    bare table behind the facts, for the pass that finds frequent keys.
    """
    how = "left_semi" if keep else "left_anti"
    keys = members.select(F.col(member_key).alias("_member")).dropna().distinct()
    limit = broadcast_limit(facts.sparkSession) if large is None else large
    hot = [] if planned_bytes(members.select(member_key)) <= limit else frequent_keys(facts if fact_scan is None else fact_scan, fact_key)
    if not hot:
        return facts.join(keys, F.col(fact_key) == F.col("_member"), how)
    # Null keys go with an anti join in full; the salt spreads them as well.
    spread = F.col(fact_key).isin(hot) | F.col(fact_key).isNull()
    salt = F.when(spread, F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    repeats = F.when(F.col("_member").isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted = keys.withColumn("_member_salt", F.explode(repeats))
    match = (F.col(fact_key) == F.col("_member")) & (F.col("_salt") == F.col("_member_salt"))
    return facts.withColumn("_salt", salt).join(salted, match, how).drop("_salt")
