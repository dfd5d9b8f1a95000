"""Shards cut from a Hilbert curve through several metadata dimensions.

Each dimension is quantised to a few bits, rows are ordered by their place on the curve, and the
order is cut into runs of equal row counts. Neighbours on the curve are alike in every dimension, so
each shard's range of every dimension is narrow and readers can skip shards by several columns at once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradepanel.llm.common import utf8_size, with_fields

BITS = 4
TAGS = 64  # parts of each cell, so that a cell with most rows is numbered by many tasks


def hilbert_index(cell: Sequence[int], bits: int) -> int:
    """Place of a cell on the Hilbert curve, by the subcubes it lies in from the largest down.

    In each subcube the corner's Gray code gives the step; the entry corner and the direction of
    the curve inside the chosen subcube then follow from that step.
    """
    n = len(cell)
    full = (1 << n) - 1
    turn = lambda x, k: ((x >> k) | (x << (n - k))) & full if k else x  # noqa: E731  rotate right
    back = lambda x, k: ((x << k) | (x >> (n - k))) & full if k else x  # noqa: E731  rotate left
    index, entry, way = 0, 0, 0
    for level in range(bits - 1, -1, -1):
        corner = sum((c >> level & 1) << j for j, c in enumerate(cell))
        gray = turn(corner ^ entry, (way + 1) % n)
        step, rest = 0, gray
        while rest:
            step ^= rest
            rest >>= 1
        index = index << n | step
        # Entry corner and direction of the step-th subcube.
        before = 2 * ((step - 1) // 2) if step else 0
        corner_in = before ^ before >> 1
        if step == 0:
            axis = 0
        else:
            odd = step if step % 2 else step - 1
            axis = ((odd + 1) & -(odd + 1)).bit_length() - 1
            axis %= n
        entry ^= back(corner_in, (way + 1) % n)
        way = (way + axis + 1) % n
    return index


def by_hash(column: Column, bits: int = BITS) -> Column:
    """A name as one of 2^bits classes; null is a class of its own value."""
    return F.pmod(F.xxhash64(column), F.lit(1 << bits)).cast("int")


def by_size(column: Column, bits: int = BITS) -> Column:
    """A count by its binary magnitude; null, negative and NaN count as 0."""
    count = F.greatest(F.coalesce(F.nanvl(column.cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(0.0))
    return F.least(F.floor(F.log2(count + 1)), F.lit((1 << bits) - 1)).cast("int")


def assign_shards(
    docs: DataFrame, dimensions: Mapping[str, Column], shards: int, order: Sequence[Column], bits: int = BITS, tags: int = TAGS
) -> DataFrame:
    """Add ``curve``, ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard) to all rows.

    ``dimensions`` are integer columns in [0, 2^bits). Row counts of shards differ by one at most.
    Inside a cell rows are ordered by a hash of ``order`` and then ``order`` itself; rows that tie in
    all of it are alike, so any order among them will do. An empty table stays empty.

    A first pass counts rows per cell and hash part, reading only the dimensions' and the order's
    columns; starts follow from at most 2^(bits * dimensions) * tags counts, whatever the data size.
    The second pass numbers the rows inside each (cell, part), so no group is larger than a part.
    """
    names = list(dimensions)
    spark = docs.sparkSession
    table = [(i, hilbert_index([i >> bits * j & (1 << bits) - 1 for j in range(len(names))], bits)) for i in range(1 << bits * len(names))]
    curve = F.broadcast(spark.createDataFrame(table, "_cell int, _curve int"))  # one row per cell of the grid
    cell = sum((F.shiftleft(dimensions[d], bits * j) for j, d in enumerate(names)), F.lit(0))
    tag = F.pmod(F.xxhash64(*order), F.lit(tags)).cast("int")
    placed = docs.withColumns({"_cell": cell, "_tag": tag}).join(curve, "_cell").drop("_cell")

    counts = placed.groupBy("_curve", "_tag").agg(F.count(F.lit(1)).alias("_rows"))
    cells = counts.groupBy("_curve").agg(F.sum("_rows").alias("_cell_rows"))
    along = Window.orderBy("_curve")  # at most one row per cell of the grid
    starts = cells.select(
        "_curve",
        (F.sum("_cell_rows").over(along) - F.col("_cell_rows")).alias("_start"),
        F.sum("_cell_rows").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_total"),
    )
    inside = Window.partitionBy("_curve").orderBy("_tag")
    parts = counts.select("_curve", "_tag", (F.sum("_rows").over(inside) - F.col("_rows")).alias("_part_start"))
    starts = parts.join(F.broadcast(starts), "_curve")  # both sides bounded by the grid

    here = Window.partitionBy("_curve", "_tag").orderBy(*order)
    ranked = (
        placed.withColumn("_place", F.row_number().over(here) - 1)
        .join(F.broadcast(starts), ["_curve", "_tag"])
        .withColumn("_place", F.col("_start") + F.col("_part_start") + F.col("_place"))
    )
    shard = F.expr(f"(_place * {shards}) div _total")
    first = F.expr(f"(_shard * _total + {shards - 1}) div {shards}")
    ranked = ranked.withColumn("_shard", shard)
    out = with_fields(ranked, {"curve": F.col("_curve"), "shard": F.col("_shard").cast("int"), "slot": F.col("_place") - first})
    return out.drop("_curve", "_tag", "_place", "_start", "_part_start", "_total", "_shard")


def document_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Shards of documents by language, source and length; adds ``size`` and ``text_crc32`` as well.

    ``size`` is the UTF-8 length of the text plus 8; a null text counts as empty (size 8, CRC 0).
    Null metadata falls into cells like any other value, so no row is lost.
    """
    body = F.col("text").cast("string")
    marked = with_fields(
        docs, {"size": utf8_size(body) + 8, "text_crc32": F.coalesce(F.crc32(body), F.lit(0)).cast("long")}
    )
    # Length by n_chars, so that the counting pass reads no text.
    dimensions = {"lang": by_hash(F.col("lang")), "source": by_hash(F.col("source")), "n_chars": by_size(F.col("n_chars"))}
    return assign_shards(marked, dimensions, shards, [F.col("doc_id"), F.col("n_chars"), F.col("source"), F.col("lang")])


def write_shards(assigned: DataFrame, path: str, tasks: int) -> None:
    """Write one folder per shard, in slot order; a shard is split over several files in rising slots."""
    assigned.repartitionByRange(tasks, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_ranges(assigned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest value of each column per shard: what a reader needs to skip shards."""
    bounds = [f(F.col(c)).alias(f"{c}_{n}") for c in columns for f, n in ((F.min, "min"), (F.max, "max"))]
    return assigned.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), *bounds)
