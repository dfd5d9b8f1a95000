"""Wide to long, symmetric copies and nested lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def widen(df: DataFrame, keys: Sequence[str], name: str, values: Sequence, measure: str) -> DataFrame:
    """One column per listed value of ``name``."""
    wide = df.groupBy(*keys).pivot(name, list(values)).agg(F.first(measure, ignorenulls=True))
    return wide


def melt(df: DataFrame, keys: Sequence[str], name: str, value: str, columns: Sequence[str] | None = None,
         value_type: str = "double") -> DataFrame:
    """Wide to long; by default every column that is no key is melted."""
    columns = list(columns) if columns else [c for c in df.columns if c not in keys]
    typed = df.select(*keys, *[F.col(f"`{c}`").cast(value_type).alias(c) for c in columns])
    return typed.unpivot(list(keys), columns, name, value)


def melt_years(df: DataFrame, keys: Sequence[str], value: str, year: str = "year") -> DataFrame:
    """Melt year-named columns; names that are no year are dropped with their cells."""
    years = [c for c in df.columns if c not in keys and c.strip().isdigit()]
    return melt(df, keys, year, value, years).withColumn(year, F.trim(year).cast("int"))


def entity_series(wide: DataFrame, entity_column: str, entity: str, value: str) -> DataFrame:
    """The yearly series of one row of a wide table."""
    return melt_years(wide.where(F.col(entity_column) == entity), [entity_column], value).drop(entity_column)


def symmetrise(df: DataFrame, a: str, b: str) -> DataFrame:
    """Every row and its copy with both sides swapped, in one scan."""
    sides = F.array(
        F.struct(F.col(a).alias("a"), F.col(b).alias("b")),
        F.struct(F.col(b).alias("a"), F.col(a).alias("b")),
    )
    order = df.columns
    return (
        df.withColumn("_side", F.explode(sides))
        .withColumns({a: F.col("_side.a"), b: F.col("_side.b")})
        .select(*order)
    )


def nested_lookup(df: DataFrame, outer: str, inner: str, fields: Sequence[str], parts: int = 1) -> DataFrame:
    """Group rows into one map (inner key -> struct) per outer key and hash part of the inner key.

    Repeated inner keys are made unique first, keeping the smallest struct. ``part`` runs from 0
    to ``parts`` - 1 at every size of the data; with one part, the default, an outer key is one row.
    Where an outer key can have very many inner keys, more parts keep each map small.
    """
    unique = df.groupBy(outer, inner).agg(F.min(F.struct(*fields)).alias("_entry"))
    placed = unique.withColumn("part", F.pmod(F.xxhash64(inner), F.lit(parts)).cast("int"))
    return placed.groupBy(outer, "part").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(inner), F.col("_entry"))))).alias("lookup")
    )


def lookup_rows(nested: DataFrame, outer: str, inner: str) -> DataFrame:
    """A nested lookup back to one row per entry."""
    return nested.select(outer, F.explode("lookup").alias(inner, "_entry")).select(outer, inner, "_entry.*")


def inner_choices(nested: DataFrame, outer: str) -> DataFrame:
    """Sorted inner keys per outer key and part."""
    return nested.select(outer, "part", F.sort_array(F.map_keys("lookup")).alias("choices"))
