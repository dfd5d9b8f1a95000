"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepanel.session import materialise

HELD = 1 << 20  # links that a task holds at a time


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the links ``a``-``b`` connect, as links of every id to the smallest id of its group."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(ids))
    while len(x):
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != root[root]).any():
            root = root[root]
        x, y = root[x], root[y]
        x, y = x[x != y], y[x != y]
    tied = np.flatnonzero(root != np.arange(len(ids)))
    return ids[tied], ids[root[tied]]


def _contracted(links: DataFrame, most: int) -> DataFrame:
    """Each task's links as stars, ``most`` links at a time; the last id of one portion goes on to the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def close() -> tuple[np.ndarray, np.ndarray]:
            return stars(*(np.concatenate(x) for x in zip(*held)))

        for batch in batches:
            if not len(batch):
                continue
            held.append((np.asarray(batch["a"]), np.asarray(batch["b"])))
            size += len(batch)
            if size >= most:
                a, b = close()
                last = a == held[-1][0][-1]
                yield pa.RecordBatch.from_arrays([pa.array(a[~last]), pa.array(b[~last])], names=["a", "b"])
                held, size = [(a[last], b[last])], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in close()], names=["a", "b"])

    return links.mapInArrow(run, "a long, b long")


def _joined(links: DataFrame, most: int) -> DataFrame:
    """The links of each ``a`` meet in one task, which ties all their ends to the smallest id it sees."""
    met = links.repartition("a").dropDuplicates(["a", "b"]).sortWithinPartitions("a", "b")
    return materialise(_contracted(met, most), "links")


def components(links: DataFrame, most: int = HELD) -> DataFrame:
    """``id`` and ``component`` (smallest id reachable) of every id that has a link; ``links`` has ``a`` and ``b``.

    Links are made stars in the tasks that produce them, so that an id has one smaller neighbour per task
    at most and a hot id is the centre of its star. Then rounds of two steps follow until nothing changes:
    the larger neighbours of an id go to its smallest one, whose search is combined before the shuffle, and
    the links of an id meet in one task. Neither step adds links or makes an end larger, so the rounds end,
    in about log^2 of them, with every id tied to its group's smallest. Links are numbers and
    no task holds many more than ``most`` of them. Every round is written to the shared folder, which cuts
    the lineage. Null ends and links of an id with itself count for nothing.
    """
    ends = links.where("a <> b").select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
    now, before = _joined(_contracted(ends, most), most), None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if not mark["n"] or mark == before:
            break
        before = mark
        # Only ids with a smaller neighbour pass their larger ones on; the smallest of its group keeps them.
        lower = now.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "b")
        now = _joined(now.join(lower, "b", "left").select("a", F.coalesce("m", "b").alias("b")), most)
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
