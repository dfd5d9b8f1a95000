"""Near-duplicate vectors by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard transform; its hash is the
signed axis nearest to the result. ``HASHES`` such hashes make a bucket of one table. Besides its own
bucket a vector also goes to the next likely ones of each table (multiprobe), where one hash takes its
second or third nearest axis. Vectors that meet in a bucket are compared exactly.

Equal vectors are one vector with a count from the start. A bucket with many vectors is compared block by
block. A pair may meet in many buckets; it counts only in the first one of both its members' lists, which
each row carries along, so links are counted without listing them. Only links that connect something new
leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepanel.llm.common import map_batches
from tradepanel.llm.components import components
from tradepanel.session import materialise

TABLES = 6
HASHES = 2
PROBES = 4  # buckets of each table, the vector's own among them
BLOCK = 2048


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, size, step = len(x), x.shape[1], 1
    while step < size:
        y = x.reshape(n, size // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(n, size)
        step *= 2
    return x / np.sqrt(size)


def codes_of(unit: np.ndarray, tables: int, hashes: int, probes: int, seed: int = 7) -> np.ndarray:
    """Buckets of unit vectors: int64 of shape (vectors, tables, probes); the first probe is the own bucket."""
    n, dim = unit.shape
    size = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, size))
    padded[:, :dim] = unit
    near = min(3, size)
    out = np.zeros((n, tables, probes), np.int64)
    for t in range(tables):
        axes, loss = [], []
        for k in range(hashes):
            random = np.random.default_rng([seed, dim, t, k])
            x = padded
            for _ in range(3):
                x = hadamard(x * random.choice([-1.0, 1.0], size))
            top = np.argsort(-np.abs(x), axis=1, kind="stable")[:, :near]
            value = np.take_along_axis(x, top, 1)
            axes.append(top + size * (value < 0))
            loss.append(np.abs(value[:, :1]) - np.abs(value))
        own = np.zeros(n, np.int64)
        for a in axes:
            own = own * (2 * size) + a[:, 0]
        # Candidates: one hash takes a later axis, or two hashes take their second.
        options, costs = [own], [np.zeros(n) - 1]
        changes = [[(k, r)] for k in range(hashes) for r in range(1, near)]
        changes += [[(k, 1), (m, 1)] for k in range(hashes) for m in range(k)]
        for change in changes:
            picked, code = dict(change), np.zeros(n, np.int64)
            for k, a in enumerate(axes):
                code = code * (2 * size) + a[:, picked.get(k, 0)]
            options.append(code)
            costs.append(sum(loss[k][:, r] ** 2 for k, r in change))
        rank = np.argsort(np.stack(costs, 1), axis=1, kind="stable")[:, :probes]
        found = np.take_along_axis(np.stack(options, 1), rank, 1)
        out[:, t, : found.shape[1]] = found
        out[:, t, found.shape[1] :] = own[:, None]
    return out


def first_meeting(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table and bucket in which two vectors of codes (pairs, tables, probes) first meet; table -1 if nowhere."""
    pairs, tables, _ = a.shape
    table, bucket = np.full(pairs, -1), np.zeros(pairs, np.int64)
    left = np.arange(pairs)
    for t in range(tables):
        if not len(left):
            break
        x, y = a[left, t], b[left, t]
        same = (x[:, :, None] == y[:, None, :]).any(2)
        hit = same.any(1)
        table[left[hit]] = t
        bucket[left[hit]] = np.where(same, x, np.iinfo(np.int64).max).min(1)[hit]
        left = left[~hit]
    return table, bucket


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what a symmetric matrix connects, one per vector at most."""
    out, left = [], np.flatnonzero(linked.any(1))
    free = np.zeros(len(linked), bool)
    free[left] = True
    for start in left.tolist():
        if not free[start]:
            continue
        free[start], edge = False, [start]
        while edge:
            u = edge.pop()
            new = np.flatnonzero(linked[u] & free)
            free[new] = False
            out += [(u, v) for v in new.tolist()]
            edge += new.tolist()
    return out


LONG, INT, BIN = T.LongType(), T.IntegerType(), T.BinaryType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def _unit(vectors: list[bytes]) -> np.ndarray:
    x = np.stack([np.frombuffer(v, "<f8") for v in vectors])
    x = x / np.abs(x).max(1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def near_duplicates(
    rows: DataFrame, cosine: float = 0.9, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES, block: int = BLOCK,
    key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of every row; links are found pairs with at least this cosine.

    Null vectors, zero vectors, empty ones and those with null or non-finite components link with
    nothing: no links, their own component, kept. Vectors of different lengths never link. Repeated
    rows are equal vectors and link with one another. A null vec_id takes part but names no component
    unless all ids of it are null. An empty table gives no rows. Only the two named columns are read.
    """

    def load(batch: pa.RecordBatch) -> Iterator[dict]:
        data, ids = [], []
        for v in batch["vector"].to_pylist():
            x = np.array(v, np.float64) if v and None not in v else np.zeros(0)
            good = len(x) and np.isfinite(x).all() and x.any()
            x = x + 0.0  # one zero only
            data.append(x.astype("<f8").tobytes() if good else None)
            ids.append(xxhash.xxh3_64_intdigest(data[-1]) - (1 << 63) if good else None)
        yield {"vec_id": batch["vec_id"], "uid": ids, "data": data}

    chosen = rows.select(rows[key].cast("long").alias("vec_id"), rows[vector].cast("array<double>").alias("vector"))
    loaded = materialise(map_batches(chosen, load, _struct(vec_id=LONG, uid=LONG, data=BIN)), "vectors")
    own = loaded.select("vec_id", "uid")
    distinct = loaded.where("uid is not null").groupBy("uid").agg(F.first("data").alias("data"), F.count(F.lit(1)).alias("times"))

    def place(batch: pa.RecordBatch) -> Iterator[dict]:
        data = batch["data"].to_pylist()
        sizes = np.array([len(x) // 8 for x in data])
        for dim in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == dim)
            for start in range(0, len(at), 1024):
                part = at[start : start + 1024]
                codes = codes_of(_unit([data[k] for k in part]), tables, hashes, probes)
                uid = np.asarray(batch["uid"])[part]
                times = np.asarray(batch["times"])[part]
                out: dict[str, list] = {c: [] for c in ("dim", "t", "bucket", "uid", "times", "data", "codes")}
                for row, k in enumerate(part.tolist()):
                    packed = codes[row].astype("<i8").tobytes()
                    for t in range(tables):
                        for bucket in np.unique(codes[row, t]).tolist():
                            for c, v in zip(out, (dim, t, bucket, uid[row], times[row], data[k], packed)):
                                out[c].append(v)
                yield out

    schema = _struct(dim=INT, t=INT, bucket=LONG, uid=LONG, times=LONG, data=BIN, codes=BIN)
    placed = materialise(map_batches(distinct, place, schema), "buckets")
    bucket_key = ["dim", "t", "bucket"]
    sizes = placed.groupBy(*bucket_key).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    blocks = F.expr(f"cast((members + {block - 1}) div {block} as int)").alias("blocks")
    met = placed.join(sizes.select(*bucket_key, blocks), bucket_key).withColumn("side", F.expr("cast(pmod(uid, blocks) as int)"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select(*bucket_key, F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "uid", "times", "data", "codes")
    schema = _struct(a=LONG, b=LONG, links=LONG)
    arrow = pa.schema([(f.name, pa.int64()) for f in schema])
    group_key = [*bucket_key, "i", "j"]

    def compare(group: list[tuple], where: tuple) -> Iterator[tuple]:
        _, t, bucket, i, j = where
        if len(group) < 2:
            return
        side = np.array([g[0] for g in group])
        x = _unit([g[3] for g in group])
        codes = np.stack([np.frombuffer(g[4], "<i8").reshape(tables, probes) for g in group])
        close = x @ x.T >= cosine
        np.fill_diagonal(close, False)
        if i != j:
            close &= side[:, None] != side[None, :]
        u, v = np.nonzero(np.triu(close))
        for start in range(0, len(u), 1 << 17):  # pairs that met before are counted there
            a, b = u[start : start + (1 << 17)], v[start : start + (1 << 17)]
            table, first = first_meeting(codes[a], codes[b])
            seen = (table != t) | (first != bucket)
            close[a[seen], b[seen]] = close[b[seen], a[seen]] = False
        times = np.array([g[2] for g in group], np.int64)
        links = close @ times
        uid = [g[1] for g in group]
        for k in np.flatnonzero(links).tolist():
            yield uid[k], None, int(links[k])
        for a, b in spanning(close):
            yield uid[a], uid[b], None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group, out = None, [], []
        names = [*group_key, "side", "uid", "times", "data", "codes"]
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in names)):
                if now != row[:5]:
                    if group:
                        out += compare(group, now)
                    now, group = row[:5], []
                group.append(row[5:])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=arrow)
                out = []
        if group:
            out += compare(group, now)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=arrow)

    found = materialise(met.repartition(*group_key).sortWithinPartitions(*group_key).mapInArrow(run, schema), "found")
    links = found.where("b is null").groupBy(F.col("a").alias("uid")).agg(F.sum("links").alias("links"))
    joined = components(found.where("b is not null").select("a", "b")).withColumnsRenamed({"id": "uid", "component": "class"})
    per_vector = distinct.select("uid", "times").join(links, "uid", "left").join(joined, "uid", "left")
    per_vector = per_vector.select("uid", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("links"), F.coalesce("class", "uid").alias("class"))
    # Both are written, so that the joins read plain tables and a vector or class of any size can be split by adaptive execution.
    marked = materialise(own.join(materialise(per_vector, "per-vector"), "uid", "left"), "marked")
    smallest = materialise(marked.where("class is not null").groupBy("class").agg(F.min("vec_id").alias("smallest")), "smallest")
    component = F.coalesce("smallest", "vec_id")
    return marked.join(smallest, "class", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
