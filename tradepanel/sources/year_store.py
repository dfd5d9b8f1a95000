"""Stored yearly tables: years are replaced one by one, and readers see only the years they ask for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def save_years(df: DataFrame, path: str, year: str = "year") -> None:
    """Write a table with a folder per year; years that ``df`` holds replace the stored ones, all others stay.

    Rows without a year have no folder to be found in, so they are an error. ``df`` must not read from ``path``.
    """
    checked = df.withColumn(year, F.coalesce(F.col(year), F.raise_error(F.lit("a row has no year")).cast(df.schema[year].dataType)))
    checked.hint("rebalance", year).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(year).parquet(path)


def read_years(spark: SparkSession, path: str, schema: T.StructType, years: Sequence[int] | None = None, year: str = "year") -> DataFrame:
    """The stored table, or only some years of it; other years' folders are not read."""
    df = spark.read.schema(schema).parquet(path)
    return (df if years is None else df.where(F.col(year).isin(list(years)))).select(*schema.names)
