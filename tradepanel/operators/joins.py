"""Lookups, reference-entity joins and spines.

No join here forces a broadcast: Spark compares each side with
``spark.sql.autoBroadcastJoinThreshold`` when it plans and, with adaptive execution,
again on the real shuffle sizes, and falls back to a sort-merge join beyond it. The one
exception is a table with one row per calendar year, which no data volume can enlarge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradepanel.functions.scalars import col


def lookup(c, mapping: dict) -> Column:
    """Value from a short literal table; no entry gives null."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.try_element_at(table, col(c))


def recode(c, mapping: dict) -> Column:
    """Value from a short literal table; no entry keeps the value."""
    return F.coalesce(lookup(c, mapping), col(c))


def unique_dimension(dim: DataFrame, key: str) -> DataFrame:
    """One row per key, keeping the smallest, so that a join cannot fan out."""
    others = [c for c in dim.columns if c != key]
    return dim.groupBy(key).agg(F.min(F.struct(*others)).alias("_row")).select(key, "_row.*")


def name_both_sides(df: DataFrame, dim: DataFrame, key: str, value: str, sides: dict[str, str]) -> DataFrame:
    """Left-join one dimension once per side; ``sides`` maps a key column to its new column."""
    for side_key, new in sides.items():
        side = dim.select(F.col(key).alias(side_key), F.col(value).alias(new))
        df = df.join(side, side_key, "left")
    return df


def full_outer(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join with one coalesced copy of each key."""
    return left.join(right, list(on), "full")


def against_reference(
    df: DataFrame, entity: str, reference: str, year: str, value: str, out: str
) -> DataFrame:
    """Add value / the reference entity's value of that year; a missing or zero one gives null."""
    ref = (
        df.where(F.col(entity) == reference)
        .groupBy(year)
        .agg(F.max(value).alias("_reference"))
    )
    return (
        df.join(F.broadcast(ref), year, "left")  # one row per calendar year
        .withColumn(out, F.try_divide(F.col(value), F.col("_reference")))
        .drop("_reference")
    )


def by_year(df: DataFrame, yearly: DataFrame, year: str = "year") -> DataFrame:
    """Left-join a table that holds one row per calendar year; whether to broadcast it is left to Spark."""
    return df.join(yearly, year, "left")


def spine(entities: DataFrame, years: Sequence[int], year: str = "year") -> DataFrame:
    """Every entity in every listed year."""
    return entities.withColumn(year, F.explode(F.array(*[F.lit(y) for y in years])))


def fill_spine(grid: DataFrame, values: DataFrame, on: Sequence[str], value: str, text: str = "No data") -> DataFrame:
    """Left-join values onto a spine and mark the gaps; the value becomes text."""
    return grid.join(values, list(on), "left").withColumn(
        value, F.coalesce(F.col(value).cast("string"), F.lit(text))
    )
