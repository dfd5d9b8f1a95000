"""What several operators share: values kept by worker processes, text batches, vocabularies."""

from __future__ import annotations

import base64
import ctypes
import gc
import sys
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepanel.session import materialise

_KEPT = "_llm_values_kept_by_this_worker"
SIEVE_WORDS = 1 << 20  # rows of a sieve, 64 hash slots each


def kept(key: Any, build: Callable[[], Any]) -> Any:
    """A value that a worker process builds once and keeps for its later tasks.

    Eight at most, and those of one module only: what another operator left in the worker goes before this one builds its own.
    """
    values = sys.modules.setdefault(_KEPT, type(sys)(_KEPT)).__dict__.setdefault("values", {})
    if key not in values:
        for old in [k for k, (owner, _) in values.items() if owner != build.__module__]:
            del values[old]
        while len(values) >= 8:
            values.pop(next(iter(values)))
        release()
        values[key] = build.__module__, build()
        release()
    return values[key][1]


def release() -> None:
    """Give memory that the process no longer uses back to the system, where the C library can do that."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def read_file(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes and their ranks, from lines of base64 text and number."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


def map_batches(df: DataFrame, run: Callable[[pa.RecordBatch], Iterator[dict[str, Any]]], schema: T.StructType) -> DataFrame:
    """Apply ``run`` to Arrow batches; it yields columns by name, in the types of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for columns in run(batch):
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x := columns[f.name], pa.Array) else pa.array(x, f.type) for f in arrow], schema=arrow
                )

    return df.mapInArrow(batches, schema)


def slices(batch: pa.RecordBatch, column: str, budget: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts take about ``budget`` bytes; one text is never cut."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch[column]), 0)).astype(np.int64)
    start = total = 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > budget:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if len(batch) > start:
        yield batch.slice(start)


def with_fields(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns; one of the same name, whatever its case, gives way."""
    new = {c.lower() for c in columns}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in new], *[c.alias(n) for n, c in columns.items()])


def sieved(rows: DataFrame, keys: DataFrame, key: str, words: int = SIEVE_WORDS) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``key``, a 64-bit hash, is surely not among ``keys``, and those whose key may be; no row is shuffled.

    The keys' hash slots are marked in a table of at most ``words`` rows, a power of two, which is broadcast whatever the number of keys.
    With very many keys more rows may be among them, which costs their way to an exact join and no more.
    """
    word = F.shiftrightunsigned(F.col(key), 6).bitwiseAND(F.lit(words - 1)).alias("_word")
    bit = F.expr(f"shiftleft(1L, cast(`{key}` & 63 as int))")
    marked = F.broadcast(materialise(keys.groupBy(word).agg(F.bit_or(bit).alias("_bits")), "sieve"))
    met = rows.withColumn("_word", word).join(marked, "_word", "left")
    may = F.coalesce(F.col("_bits"), F.lit(0)).bitwiseAND(bit) != 0
    return met.where(~may).select(*rows.columns), met.where(may).select(*rows.columns)


def utf8_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def read_table(spark: SparkSession, folder: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df
