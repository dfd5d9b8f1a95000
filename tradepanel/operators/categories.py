"""Categories with any number of levels, without a column a level.

An indicator column is 0 in almost every row, so only the places of its ones are kept: a row has one position
per category, and cross products exist only where two levels meet. Levels stay in distributed tables and never
reach the driver.

A regression with one category of very many levels is solved by taking the level means out first: the slopes
follow from the cross products within levels, which are as few as the number columns, and each level's effect
from its means. The result equals that of a fit with one 0/1 column per level.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from itertools import combinations, combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepanel.functions.scalars import exact_sum
from tradepanel.operators.ordering import with_row_index
from tradepanel.operators.skew import join_dimension
from tradepanel.session import materialise

EFFECT = "effect"
ONE = "one"


def level_positions(df: DataFrame, categories: Sequence[str]) -> DataFrame:
    """``category``, ``level`` and ``position`` of every level that has an indicator.

    Levels are numbered in their own order, the categories one after another, from 0 without gaps. The first level of
    each category is the base and has a null position. Null is no level.
    """
    def level(nth: int, c: str) -> Column:
        number = F.col(c) if isinstance(df.schema[c].dataType, T.NumericType) else F.lit(None)
        return F.struct(
            F.lit(nth).alias("_nth"), F.lit(c).alias("category"), F.col(c).cast("string").alias("level"), number.cast("double").alias("_number")
        )

    pairs = F.array(*[level(i, c) for i, c in enumerate(categories)])
    levels = df.select(F.explode(pairs).alias("p")).select("p.*").where("level is not null").distinct()
    indexed = with_row_index(levels, ["_nth", "_number", "level"], "_index")
    firsts = indexed.groupBy("_nth").agg(F.min("_index").alias("_first"))
    # One row per category, which the caller lists.
    placed = indexed.join(F.broadcast(firsts), "_nth")
    return placed.select("category", "level", F.when(F.col("_index") > F.col("_first"), F.col("_index") - F.col("_nth") - 1).alias("position"))


def with_positions(df: DataFrame, categories: Sequence[str], positions: DataFrame, spread_by: Sequence[str], large: int | None = None) -> DataFrame:
    """Add ``<category>_position``, the place of the row's one 1 among the indicators; null for the base, null and unknown levels.

    ``spread_by`` are columns that differ between rows of one level, by which a hot level is split.
    """
    for c in categories:
        dim = positions.where(F.col("category") == c).select(F.col("level").alias("_level"), F.col("position").alias(f"{c}_position"))
        keyed = df.withColumn("_key", F.col(c).cast("string"))
        df = join_dimension(keyed, dim, "_key", "_level", spread_by, "left", large=large).drop("_key", "_level")
    return df


def sparse_products(df: DataFrame, numbers: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """Cross products of a constant, number columns and the indicators of all levels, those that are not 0 by construction.

    Columns ``left``, ``left_level``, ``right``, ``right_level`` and ``product``; the level of the constant and of a number is
    null. Each pair stands once, in the order constant, numbers, categories. Every set of at most two categories is a grouping set,
    combined before the shuffle, which carries only the sums that the set is asked for: all for none, those of the terms for one category, a count
    for two. Rows with a null in any of the columns are left out.
    """
    rows = df.dropna(subset=[*numbers, *categories])
    terms = [ONE, *numbers]

    def value(a: str) -> Column:
        return F.lit(1.0) if a == ONE else F.col(a).cast("double")

    def entry(a: str, b: str, total: Column) -> Column:
        level = lambda x: F.col(x).cast("string") if x in categories else F.lit(None).cast("string")
        return F.struct(F.lit(a).alias("left"), level(a).alias("left_level"), F.lit(b).alias("right"), level(b).alias("right_level"), total.alias("product"))

    def entries(sets: list[list[str]], sums: dict[str, Column], made: Callable[[list[str]], list[Column]]) -> DataFrame:
        """One grouping set for each of ``sets``, with the same sums; ``made`` turns those of a set into its entries."""
        number, width = F.lit(None), len(categories)
        for s in sets:
            number = F.when(F.col("_set") == sum(1 << (width - 1 - i) for i, c in enumerate(categories) if c not in s), F.array(*made(s))).otherwise(number)
        grouped = rows.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in categories])
        return grouped.agg(F.grouping_id().alias("_set"), *[x.alias(n) for n, x in sums.items()]).select(F.explode(number).alias("e")).select("e.*")

    whole = {(a, b): f"_s{i}" for i, (a, b) in enumerate(combinations_with_replacement(terms, 2))}
    parts = [entries([[]], {n: exact_sum(value(a) * value(b), None) for (a, b), n in whole.items()}, lambda s: [entry(a, b, F.col(n)) for (a, b), n in whole.items()])]
    if categories:
        single = {f"_s{i}": exact_sum(value(a), None) for i, a in enumerate(terms)}
        parts.append(entries(
            [[c] for c in categories], single, lambda s: [*[entry(a, s[0], F.col(n)) for n, a in zip(single, terms)], entry(s[0], s[0], F.col("_s0"))]
        ))
    if len(categories) > 1:
        count = {"_s0": F.count(F.lit(1)).cast("double")}
        parts.append(entries([list(s) for s in combinations(categories, 2)], count, lambda s: [entry(s[0], s[1], F.col("_s0"))]))
    return reduce(DataFrame.unionAll, parts)


def absorbed_fit(df: DataFrame, numbers: Sequence[str], category: str, label: str) -> tuple[dict[str, float], DataFrame]:
    """Least squares of ``label`` on number columns and one indicator for each level of ``category``.

    Returns the slopes and a table ``category``, ``effect``, ``rows``: a level's prediction where all numbers are 0.
    A number that does not vary within levels has slope 0, as the indicators say it all; of numbers that depend on each other the
    solution of least norm is taken. Rows with a null or NaN in any of the columns do not train. One shuffle by level, combined before it.
    """
    columns = [*numbers, label]
    rows = df.select(category, *[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    means = [F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]
    spreads = [F.covar_pop(columns[i], columns[j]).alias(f"c{i}_{j}") for i, j in pairs]
    levels = materialise(rows.groupBy(category).agg(F.count(F.lit(1)).alias("rows"), *means, *spreads), "levels")
    within = levels.agg(*[F.sum(F.col("rows") * F.col(f"c{i}_{j}")).alias(f"c{i}_{j}") for i, j in pairs]).first()
    size = len(numbers)
    products = np.zeros((size + 1, size + 1))
    for i, j in pairs:
        products[i, j] = products[j, i] = within[f"c{i}_{j}"] or 0.0
    scale = np.sqrt(np.diag(products)[:size])
    scale[scale == 0] = 1.0
    solved = np.linalg.lstsq(products[:size, :size] / np.outer(scale, scale), products[:size, size] / scale, rcond=1e-12)[0] / scale if size else []
    slopes = {c: float(v) for c, v in zip(numbers, solved)}
    effect = F.col(f"m{size}")
    for i, c in enumerate(numbers):
        effect = effect - F.lit(slopes[c]) * F.col(f"m{i}")
    return slopes, levels.select(category, effect.alias(EFFECT), "rows")


def absorbed_predict(
    df: DataFrame, slopes: dict[str, float], effects: DataFrame, category: str, spread_by: Sequence[str], out: str = "prediction", large: int | None = None
) -> DataFrame:
    """Add the prediction; an unknown or null level, or a missing number, gives null. Hot levels are split by ``spread_by``."""
    dim = effects.select(F.col(category).alias("_level"), F.col(EFFECT).alias("_effect"))
    joined = join_dimension(df, dim, category, "_level", spread_by, "left", large=large)
    value = F.col("_effect")
    for c, slope in slopes.items():
        value = value + F.lit(slope) * F.col(c).cast("double")
    return joined.withColumn(out, value).drop("_level", "_effect")
