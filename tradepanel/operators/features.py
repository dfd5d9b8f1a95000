"""Feature columns, all as plain expressions."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepanel.functions.scalars import log_floor


def level_flags(df: DataFrame, column: str, levels: Sequence, prefix: str) -> DataFrame:
    """One 0/1 column per listed level."""
    return df.withColumns(
        {f"{prefix}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in levels}
    )


def one_hot(df: DataFrame, column: str, prefix: str | None = None, most: int = 1000) -> DataFrame:
    """Flags for all sorted levels but the first. Only the level names reach the driver."""
    levels = [r[0] for r in df.select(column).dropna().distinct().orderBy(column).limit(most + 1).collect()]
    if len(levels) > most:
        raise ValueError(f"{column} has more than {most} levels; take categories.absorbed_fit or sparse_products, which make no columns")
    return level_flags(df, column, levels[1:], prefix or column)


def interact(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Products of two columns under a new name."""
    return df.withColumns({new: F.col(a) * F.col(b) for new, (a, b) in pairs.items()})


def degree_two(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Squares and pairwise products, named ``a_x_b``."""
    return df.withColumns(
        {f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in combinations_with_replacement(columns, 2)}
    )


def log_columns(df: DataFrame, columns: Sequence[str], floor: float = 1.0) -> DataFrame:
    return df.withColumns({f"log_{c}": log_floor(c, floor) for c in columns})


def moments(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column, from one aggregate row."""
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in columns}


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_scaled``: centred, over the population deviation (1 if that is 0)."""
    out = {}
    for c, (mean, dev) in moments(df, columns).items():
        out[f"{c}_scaled"] = (F.col(c) - F.lit(mean)) / F.lit(dev)
    return df.withColumns(out)
