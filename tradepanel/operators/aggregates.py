"""Group sums, subtotals, top-k, de-duplication and unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradepanel.functions.scalars import col, exact_sum
from tradepanel.operators.ordering import INDEX, group_median, shift_rows, with_row_index


def group_sums(df: DataFrame, keys: Sequence[str], measures: Sequence[str], digits: int | None = 4) -> DataFrame:
    """Sums per group; rows with a null key are left out. ``digits`` None sums terms of any scale."""
    return (
        df.dropna(subset=list(keys)).groupBy(*keys).agg(*[exact_sum(m, digits).alias(m) for m in measures])
    )


def with_subtotals(
    df: DataFrame, keys: Sequence[str], labels: dict[str, object], measures: Sequence[str], digits: int | None = 4
) -> DataFrame:
    """Detail sums plus one subtotal row per ``keys``, in one pass.

    ``labels`` names the detail columns and the value each takes in a subtotal row.
    """
    detail = [*keys, *labels]
    out = df.groupingSets([[F.col(c) for c in detail], [F.col(c) for c in keys]], *detail).agg(
        *[exact_sum(m, digits).alias(m) for m in measures],
        *[F.grouping(c).alias(f"_g_{c}") for c in labels],
    )
    relabelled = {
        c: F.when(F.col(f"_g_{c}") == 1, F.lit(v)).otherwise(F.col(c)) for c, v in labels.items()
    }
    return out.withColumns(relabelled).select(*detail, *measures)


def share_of_total(df: DataFrame, chosen: Column, value, digits: int | None = 4) -> DataFrame:
    """Percentage of the total that falls on the chosen rows."""
    part = exact_sum(F.when(chosen, col(value)), digits)
    whole = exact_sum(value, digits)
    return df.agg(
        F.coalesce(part, F.lit(0.0)).alias("chosen_total"),
        whole.alias("all_total"),
        (F.try_divide(F.coalesce(part, F.lit(0.0)), whole) * 100).alias("share_pct"),
    )


def describe(df: DataFrame, value: str) -> DataFrame:
    """Mean, exact median, extremes and sample variance of one column, as one row."""
    stats = df.agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.var_samp(value).alias("variance"),
    )
    middle = group_median(df.select(value, F.lit(1).alias("_all")), ["_all"], [value])
    return stats.withColumn("median", middle.select(value).scalar())


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row per key in a stated order.

    The rank filter is applied on each map task before the shuffle, so a key with very
    many rows sends only one per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct().orderBy(*columns)


def top_k(df: DataFrame, by: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The k largest rows; ties are broken by the given columns."""
    return df.orderBy(F.col(by).desc_nulls_last(), *tie).limit(k)


def autocorrelation(df: DataFrame, value: str, order: Sequence[str], lags: Sequence[int]) -> DataFrame:
    """Correlation of a globally ordered series with itself, k rows back."""
    shifted = shift_rows(
        with_row_index(df, order), {f"_lag{k}": (value, k) for k in lags}, INDEX
    )
    return shifted.agg(*[F.corr(value, f"_lag{k}").alias(f"lag_{k}") for k in lags])


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Append rows by column name; a missing column is filled with null."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def latest_slice(df: DataFrame, year: str = "year") -> DataFrame:
    """Rows of the last year present."""
    return df.where(F.col(year) == df.agg(F.max(year).alias("y")).scalar())


def last_years(df: DataFrame, count: int, year: str = "year") -> DataFrame:
    """The last ``count`` distinct years, newest first."""
    return df.select(year).distinct().orderBy(F.col(year).desc()).limit(count)
