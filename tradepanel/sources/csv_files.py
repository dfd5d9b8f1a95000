"""CSV scans and table sinks."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header line and a stated schema; nothing is inferred."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.regexp_replace("value", "^\\ufeff", "").alias("line"))


def header_of(lines: DataFrame, first_field: str) -> str:
    """The line that starts with ``first_field``; only that line reaches the driver."""
    bare = F.ltrim(F.regexp_replace("line", '^"', ""))
    found = lines.where(bare.startswith(first_field) & F.col("line").contains(",")).first()
    if found is None:
        raise ValueError(f"no header line starting with {first_field!r}")
    return found["line"]


def _names(header: str) -> list[str]:
    return [n.strip() for n in next(csv.reader([header]))]


def parse_records(lines: DataFrame, header: str) -> DataFrame:
    """Lines with their cells as ``r``: text c0, c1, ..., and ``_bad`` where their number is not the header's."""
    raw = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(_names(header)))])
    raw = raw.add("_bad", T.StringType())
    return lines.withColumn(
        "r",
        F.from_csv(
            "line", raw.simpleString()[len("struct<"):-1].replace(":", " "),
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"},
        ),
    )


def read_preamble_csv(
    spark: SparkSession, path: str, first_field: str, types: dict[str, str] | None = None,
    default_type: str = "double",
) -> DataFrame:
    """CSV whose header comes after a free-text preamble of unknown length.

    The header is the line that starts with ``first_field``. Preamble lines, blank lines,
    repeated headers and other lines without the header's number of fields are left out;
    ``quarantine.set_aside`` returns them with file and line number.
    Column names are trimmed. ``types`` gives the type of named columns, and bad cells
    become null. A record must not span lines. Only the header line reaches the driver.
    """
    lines = text_lines(spark, path)
    header = header_of(lines, first_field)
    names = _names(header)
    parsed = parse_records(lines.where((F.col("line") != header) & (F.length(F.trim("line")) > 0)), header)
    types = types or {}
    unnamed = [i for i, n in enumerate(names) if not n]
    return parsed.where(F.col("r._bad").isNull()).select(
        *[
            F.col(f"r.c{i}").try_cast(types.get(n, default_type)).alias(n)
            for i, n in enumerate(names)
            if i not in unnamed
        ]
    )


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """Parquet sink; partition columns (for example the year) become folders.

    Rows are rebalanced by the partition columns first: adaptive execution then splits a
    very large year over several tasks and packs small ones, so that neither one task nor
    a mass of small files results.
    """
    balanced = df.hint("rebalance", *partition_by) if partition_by else df
    balanced.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)
