"""Lags and growth inside one series.

The series keys together with ``year`` must identify a row, so a window holds at most
one row per calendar year however large the table is; ``one_row_per_year`` gets a raw
table into that shape with a map-side combine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradepanel.functions.scalars import exact_sum


def series(keys: Sequence[str], year: str = "year"):
    return Window.partitionBy(*keys).orderBy(year)


def one_row_per_year(df: DataFrame, keys: Sequence[str], measures: Sequence[str], year: str = "year") -> DataFrame:
    return df.groupBy(*keys, year).agg(*[exact_sum(m).alias(m) for m in measures])


def add_lags(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    lags: Sequence[int] = (1, 2, 3),
    year: str = "year",
    adjacent: bool = False,
) -> DataFrame:
    """Add ``<column>_lag<k>``: the value k rows back in the same series.

    With ``adjacent`` a value counts only if it is from exactly k years before.
    """
    w = series(keys, year)
    added = {}
    for column in columns:
        for k in lags:
            value = F.lag(column, k).over(w)
            if adjacent:
                value = F.when(F.lag(year, k).over(w) == F.col(year) - k, value)
            added[f"{column}_lag{k}"] = value
    return df.withColumns(added)


def entity_lag(df: DataFrame, entity: str, value: str, out: str, year: str = "year") -> DataFrame:
    """Previous value per entity, on the entity's own table and before any join."""
    return df.withColumn(out, F.lag(value, 1).over(series([entity], year)))


def yearly_lag(df: DataFrame, value: str, out: str, year: str = "year") -> DataFrame:
    """Previous value of a table that holds a single row per calendar year."""
    return df.withColumn(out, F.lag(value, 1).over(Window.orderBy(year)))


def growth(df: DataFrame, keys: Sequence[str], value: str, out: str, year: str = "year") -> DataFrame:
    """value / previous value - 1, with gaps filled by the last known value first."""
    w = series(keys, year)
    filled = df.withColumn("_filled", F.last(value, ignorenulls=True).over(w))
    before = F.lag("_filled", 1).over(w)
    return filled.withColumn(out, F.try_divide(F.col("_filled"), before) - 1).drop("_filled")
