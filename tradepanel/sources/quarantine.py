"""What a preamble scan leaves out, with its place, so that records and rest together are the whole file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradepanel.sources.csv_files import header_of, parse_records, text_lines


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files: ``file``, ``number`` (from 1 in each file), ``line``.

    Rows of one file split stand together and in order in one partition, so a line's number is its place in the split
    plus the lines of the splits before it. Only one row per split meets in the window. Both readings
    cut the files alike, as they have the same files and settings.
    """
    lines = spark.read.text(path).select(
        F.regexp_replace("value", "^\\ufeff", "").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"),
    )
    splits = lines.groupBy("file", "split").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("split")
    starts = splits.select("file", "split", "first", (F.sum("n").over(before) - F.col("n")).alias("start"))
    return lines.join(starts, ["file", "split"]).select(
        "file", (F.col("at") - F.col("first") + F.col("start") + 1).alias("number"), "line"
    )


def set_aside(spark: SparkSession, path: str, first_field: str) -> DataFrame:
    """Lines that ``read_preamble_csv`` does not return: ``file``, ``number``, ``line``, ``reason``.

    The reason is ``blank``, ``header`` (also repeated ones), ``preamble`` (before the first header of the file) or
    ``record`` (another number of fields than the header has). Records and these lines together are all lines.
    """
    lines = numbered_lines(spark, path)
    header = header_of(text_lines(spark, path), first_field)
    is_header = F.col("line") == header
    first = lines.where(is_header).groupBy("file").agg(F.min("number").alias("header_at"))
    judged = parse_records(lines, header).join(first, "file", "left")
    reason = (
        F.when(is_header, "header")
        .when(F.length(F.trim("line")) == 0, "blank")
        .when(F.col("r._bad").isNotNull(), F.when(F.col("number") < F.col("header_at"), "preamble").otherwise("record"))
    )
    return judged.withColumn("reason", reason).where("reason is not null").select("file", "number", "line", "reason")
