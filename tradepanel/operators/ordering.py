"""Global row order without a single-task window.

A global position is needed for row shifts, contiguous folds and exact medians.
The frame is range-sorted (balanced partitions), tagged inside each partition, and
written once; partition sizes then give each row its position. No step gathers the
rows in one task, and the written tags do not change when a stage is run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradepanel.session import materialise

INDEX = "row_index"
BLOCK_ROWS = 1 << 20
PIECE_ROWS = 1 << 20  # rows that a task of a median's search has on average, at most


def with_row_index(df: DataFrame, order: Sequence[Column | str], name: str = INDEX) -> DataFrame:
    """Add the 0-based position of each row under ``order`` (which must be total)."""
    tagged = materialise(
        df.orderBy(*order).withColumn("_tag", F.monotonically_increasing_id()), "ordered"
    )
    # The tag holds the partition number above bit 33 and the row number below it.
    part = F.shiftright("_tag", 33)
    sizes = tagged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per sort partition, so broadcasting it is safe at any data size.
    starts = sizes.select(
        F.col("_part"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    inside = F.col("_tag").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        tagged.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + inside)
        .drop("_tag", "_part", "_start")
    )


def shift_rows(
    indexed: DataFrame, shifts: dict[str, tuple[str, int]], index: str = INDEX, block: int = BLOCK_ROWS
) -> DataFrame:
    """Add values taken ``k`` rows earlier (k > 0) or later (k < 0) in the global order.

    ``shifts`` maps a new column to (source column, k). Rows are cut into blocks of
    equal length and only the rows next to a cut are copied to the neighbour block, so
    each window task sees at most ``block`` rows plus that halo.
    """
    offsets = [k for _, k in shifts.values()]
    back, ahead = max(0, *offsets), max(0, *[-k for k in offsets])
    if block < max(back, ahead):
        raise ValueError("block must be at least as long as the longest shift")
    home = F.floor(F.col(index) / F.lit(block)).cast("long")
    place = F.pmod(F.col(index), F.lit(block))

    def copy(to: Column, own: bool) -> Column:
        return F.struct(to.alias("block"), F.lit(own).alias("own"))

    copies = F.array(
        copy(home, True),
        F.when(place >= block - back, copy(home + 1, False)),
        F.when(place < ahead, copy(home - 1, False)),
    )
    spread = indexed.withColumn("_copy", F.explode(F.filter(copies, lambda c: c.isNotNull())))
    w = Window.partitionBy("_copy.block").orderBy(index)
    for new, (source, k) in shifts.items():
        spread = spread.withColumn(new, F.lag(source, k).over(w))
    return spread.where("_copy.own").drop("_copy")


def drop_leading_rows(df: DataFrame, count: int, order: Sequence[Column | str]) -> DataFrame:
    """Leave out the first ``count`` rows of the given order."""
    return with_row_index(df, order).where(F.col(INDEX) >= count).drop(INDEX)


def group_median(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Exact interpolating median of each column per group, for groups of any size.

    Equal values are counted first, so ties cost nothing. The distinct values are then
    range-sorted, and a group that is spread over several sort partitions stays so: the
    small table of (group, partition) row counts tells which piece holds the middle, and
    only that piece is searched. The search is dealt by number of rows, as sorted values pack so well that
    their bytes say little of the memory they need. Groups whose values are all null give no row.
    """
    keys = list(keys)
    group = [*keys, "_measure"]
    cells = F.array(*[F.struct(F.lit(i).alias("m"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)])
    values = df.dropna(subset=keys).select(*keys, F.explode(cells).alias("_x"))
    counted = (
        values.where(F.col("_x.v").isNotNull())
        .groupBy(*keys, F.col("_x.m").alias("_measure"), F.col("_x.v").alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    piece = [*group, "_part"]
    ordered = materialise(
        counted.orderBy(*group, "_value").withColumn("_part", F.spark_partition_id()), "ordered"
    )
    # one row per group and sort partition
    sizes = ordered.groupBy(*piece).agg(F.sum("_n").alias("_size"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("_size").over(whole)
    within = {"_low": F.floor((total - 1) / 2) - F.col("_before"), "_high": F.floor(total / 2) - F.col("_before")}
    wanted = (
        sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .withColumns(within)
        .where((F.col("_high") >= 0) & (F.col("_low") < F.col("_size")))
        .select(*piece, *within)
    )
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-ordered.count() // PIECE_ROWS))
    running = F.sum("_n").over(Window.partitionBy(*piece).orderBy("_value"))

    def holds(at: str) -> Column:
        return (F.col(at) < F.col("_upto")) & (F.col(at) >= F.col("_upto") - F.col("_n"))

    picked = (
        ordered.repartition(parts, *piece)
        .withColumn("_upto", running)
        .join(wanted, piece)
        .where(holds("_low") | holds("_high"))
        .withColumn("_side", F.explode(F.filter(F.array(F.when(holds("_low"), 0), F.when(holds("_high"), 1)), lambda x: x.isNotNull())))
    )
    return picked.groupBy(*keys).agg(
        *[F.avg(F.when(F.col("_measure") == i, F.col("_value"))).alias(c) for i, c in enumerate(columns)]
    )
