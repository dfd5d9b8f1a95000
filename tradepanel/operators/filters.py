"""Row filters, null handling and data-quality counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_members(df: DataFrame, members: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``members``, whose keys are made unique before the shuffle."""
    return df.join(members.select(*on).distinct(), list(on), "left_semi")


def drop_members(df: DataFrame, members: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``members``; rows with a null key stay."""
    return df.join(members.select(*on).distinct(), list(on), "left_anti")


def not_in(c: str, values: Sequence) -> Column:
    """Not one of a short list of values, with null kept."""
    return F.col(c).isNull() | ~F.col(c).isin(list(values))


def reject_marked(df: DataFrame, marker: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows in which any cell contains ``marker``."""
    hits = [
        F.coalesce(F.col(f"`{c}`").cast("string").contains(marker), F.lit(False))
        for c in (columns or df.columns)
    ]
    return df.where(~reduce(or_, hits))


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(columns) if columns else None)


def numeric_key_rows(df: DataFrame, column: str, kind: str = "int") -> DataFrame:
    """Keep rows whose key reads as a number (junk trailing rows do not) and cast it."""
    return df.withColumn(column, F.col(column).try_cast(kind)).where(F.col(column).isNotNull())


def quality_profile(df: DataFrame) -> DataFrame:
    """One row per column: rows in the table, nulls and distinct non-null values.

    Each cell becomes a (column, value) key that is counted before it is counted as
    distinct, so the wide fan-out of one distinct count per column is not needed.
    """
    cells = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                    for c in df.columns
                ]
            )
        ).alias("cell")
    ).select("cell.*")
    counted = cells.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("column_name").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        F.count("value").alias("distinct_count"),
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))
