"""Nested JSON to flat tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json_list(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Files that each hold one JSON list of records."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def _leaves(schema: T.StructType, path: str, name: str) -> list[Column]:
    out = []
    for field in schema.fields:
        inner, label = f"{path}.`{field.name}`", f"{name}_{field.name}" if name else field.name
        if isinstance(field.dataType, T.StructType):
            out += _leaves(field.dataType, inner, label)
        else:
            out.append(F.col(inner).alias(label))
    return out


def flatten(df: DataFrame, column: str, keep: list[str] | None = None) -> DataFrame:
    """A struct column to one column per leaf, nested names joined by '_'."""
    schema = df.schema[column].dataType
    return df.select(*(keep or []), *_leaves(schema, column, ""))


def flatten_records(
    df: DataFrame, text: str, record: T.StructType | str, list_field: str | None = None, keep: list[str] | None = None
) -> DataFrame:
    """JSON text to flat rows; with ``list_field`` each element of that list is a row.

    Documents whose list is missing or empty, or that are no JSON, give no rows.
    """
    keep = keep or []
    record_ddl = record if isinstance(record, str) else record.simpleString()[len("struct<"):-1]
    if list_field is None:
        parsed = df.select(*keep, F.from_json(text, record_ddl).alias("_r"))
        return flatten(parsed.where(F.col("_r").isNotNull()), "_r", keep)
    schema = f"`{list_field}` array<struct<{record_ddl}>>" if isinstance(record, T.StructType) else None
    if schema is None:
        fields = T.StructType.fromDDL(record_ddl)
        schema = f"`{list_field}` array<{fields.simpleString()}>"
    parsed = df.select(*keep, F.from_json(text, schema).alias("_d"))
    return flatten(parsed.select(*keep, F.explode(f"_d.{list_field}").alias("_r")), "_r", keep)
