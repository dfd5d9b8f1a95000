"""Schema and column operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def drop_present(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns by name; absent names are no error."""
    return df.drop(*names)


def drop_positions(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    return df.drop(*[df.columns[i] for i in positions])


def trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip().lstrip("\ufeff") for name in df.columns])


def number_names(df: DataFrame, keep: int, start: int) -> DataFrame:
    """Keep the first names and call the rest start, start + 1, and so on."""
    tail = [str(start + i) for i in range(len(df.columns) - keep)]
    return df.toDF(*df.columns[:keep], *tail)


def first_of_each_name(df: DataFrame) -> DataFrame:
    """Keep the first column of every name, as a join may leave duplicates."""
    positions: dict[str, int] = {}
    for i, name in enumerate(df.columns):
        positions.setdefault(name, i)
    numbered = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"_c{i}").alias(name) for name, i in positions.items()])


def cast_columns(df: DataFrame, types: dict[str, str], lenient: bool = False) -> DataFrame:
    """Cast listed columns; lenient casts turn bad values into null."""
    return df.withColumns(
        {c: F.col(c).try_cast(t) if lenient else F.col(c).cast(t) for c, t in types.items()}
    )


def align_keys(left: DataFrame, right: DataFrame, types: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Give the join keys of both sides one type."""
    return cast_columns(left, types), cast_columns(right, types)
