"""Best-fit packing into sequences of several permitted lengths.

Only the histogram of lengths decides how bins are filled, and it has at most as many entries as the
longest permitted length, whatever the number of documents. So bins are planned as patterns with
a repeat count: lengths from the longest down go where the least room would be left, and where none fits,
bins of the least-cost length are opened; at the end each bin shrinks to the shortest permitted length
that holds it. Spark counts the lengths and numbers the rows of each length; a row's number then
tells its bin.
"""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepanel.llm import token_transducer
from tradepanel.llm.common import map_batches, utf8_size
from tradepanel.session import materialise

CAPACITIES = (512, 1024, 2048, 4096, 8192)
BIN_COST = 64  # fixed cost of a sequence, in tokens
TAGS = 64


@dataclass(frozen=True)
class Pattern:
    """Bins that are filled alike: their length, (length, times) of their contents, and how many."""

    capacity: int
    contents: tuple[tuple[int, int], ...]
    repeat: int


def plan_patterns(histogram: Mapping[int, int], capacities: Sequence[int] = CAPACITIES, bin_cost: int = BIN_COST) -> list[Pattern]:
    """Patterns that hold all items of the histogram; lengths are in 1 to the largest capacity."""
    sizes = sorted(capacities)
    lengths = sorted((k for k, n in histogram.items() if n), reverse=True)
    if lengths and (lengths[0] > sizes[-1] or lengths[-1] < 1):
        raise ValueError("lengths must lie between 1 and the largest capacity")
    mass = list(itertools.accumulate((k * histogram[k] for k in reversed(lengths)), initial=0))  # of the shortest ones
    rising = lengths[::-1]
    open_bins: dict[int, list[tuple[int, tuple, int]]] = {}  # room -> (capacity, contents, repeat)
    rooms: list[int] = []  # sorted keys of open_bins

    def put(room: int, capacity: int, contents: tuple, repeat: int) -> None:
        if room not in open_bins:
            bisect.insort(rooms, room)
            open_bins[room] = []
        open_bins[room].append((capacity, contents, repeat))

    def cheapest(length: int, count: int) -> int:
        """Permitted length with the least cost per token that can be expected to fill the new bins."""
        best = None
        for size in sizes:
            if size < length:
                continue
            per_bin = min(count, size // length)
            bins = -(-count // per_bin)
            spare = bins * size - count * length
            fillers = mass[bisect.bisect_right(rising, min(length - 1, size - per_bin * length))]
            cost = bins * (size + bin_cost) / (count * length + min(spare, fillers))
            if best is None or cost < best[0]:
                best = (cost, size)
        return best[1]

    for length in lengths:
        left = histogram[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                capacity, contents, repeat = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(at)
                # As many as fit into each of these bins at once.
                times = max(1, min(room // length, left // repeat))
                used = min(repeat, left // times)
                if used < repeat:
                    put(room, capacity, contents, repeat - used)
                put(room - times * length, capacity, (*contents, (length, times)), used)
                left -= used * times
            else:
                size = cheapest(length, left)
                times = min(left, size // length)
                used = left // times
                put(size - times * length, size, ((length, times),), used)
                left -= used * times
    out = []
    for room, bins in open_bins.items():
        for capacity, contents, repeat in bins:
            fits = sizes[bisect.bisect_left(sizes, capacity - room)]
            out.append(Pattern(fits, contents, repeat))
    return sorted(out, key=lambda p: (-p.capacity, p.contents))


def slot_ranges(patterns: Sequence[Pattern]) -> dict[str, np.ndarray]:
    """For each length, runs of item numbers and where they go, sorted by (length, first)."""
    given: dict[int, int] = {}
    rows, base = [], 0
    for p in patterns:
        offset = 0
        for length, times in p.contents:
            first = given.get(length, 0)
            rows.append((length, first, base, times, offset, p.capacity))
            given[length] = first + times * p.repeat
            offset += length * times
        base += p.repeat
    rows.sort()
    names = ("length", "first", "base", "times", "offset", "capacity")
    return {n: np.array([r[i] for r in rows], np.int64) for i, n in enumerate(names)}


def part_starts(counted: pa.Table, tags: int) -> tuple[np.ndarray, np.ndarray, dict[int, int]]:
    """From pieces counted by ``part``, length times ``tags`` plus hash part: the parts in order, the pieces of the same length before each, and the pieces of each length."""
    parts, n = (counted[c].to_numpy() for c in ("part", "n"))
    order = np.argsort(parts)
    parts, n = parts[order], n[order]
    lengths, first = np.unique(parts // tags, return_index=True)
    before = np.cumsum(n) - n
    sums = np.add.reduceat(n, first) if len(n) else n
    starts = before - np.repeat(before[first], np.diff(np.append(first, len(n))))
    return parts, starts, dict(zip(lengths.tolist(), sums.tolist()))


PACKED = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "piece", "start", "length", "bin_id", "capacity", "offset")])


def pack_documents(
    docs: DataFrame, length: Column | None = None, capacities: Sequence[int] = CAPACITIES, bin_cost: int = BIN_COST,
    tags: int = TAGS, key: str = "doc_id",
) -> DataFrame:
    """Pack documents: ``doc_id``, ``piece``, ``start``, ``length``, ``bin_id``, ``capacity``, ``offset`` of every piece.

    ``length`` is the length of a row in tokens; by default a guess, its UTF-8 bytes at four to a token,
    rounded up (``pack_texts`` counts). A document longer than the largest capacity is cut into pieces of that capacity, the last one
    shorter; all others are one piece. A null or empty text has one piece of length 0 without bin (null
    bin_id, capacity and offset). Repeated rows are packed as often as they stand there. An empty
    table gives no rows.

    Two passes: the counts of pieces by length and hash part, at most ``max(capacities) * tags`` rows whatever the data size, go to the
    driver; lengths are planned there, and each (length, part) gets the number its first piece has. Then pieces are numbered inside their
    (length, part), so a length that most documents share is numbered by many tasks, and one sort is all that they go through.
    """
    most = max(capacities)
    if length is None:
        length = F.ceil(utf8_size(F.col("text").cast("string")) / 4)
    whole = docs.select(F.col(key).cast("long").alias("doc_id"), F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0)).alias("_n"))
    cuts = F.sequence(F.lit(0).cast("long"), F.greatest(F.expr(f"(_n - 1) div {most}"), F.lit(0).cast("long")))
    pieces = whole.select("doc_id", "_n", F.explode(cuts).alias("piece")).select(
        "doc_id", "piece", (F.col("piece") * most).alias("start"), F.least(F.col("_n") - F.col("piece") * most, F.lit(most)).alias("length")
    )
    tagged = pieces.withColumn("_tag", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(tags)).cast("long"))
    counted = tagged.where("length > 0").groupBy((F.col("length") * tags + F.col("_tag")).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    parts, starts, histogram = part_starts(counted.toArrow(), tags)
    ranges = slot_ranges(plan_patterns(histogram, capacities, bin_cost))
    sent = docs.sparkSession.sparkContext.broadcast((ranges, parts, starts))  # bounded by the largest capacity and the tags, not by the data
    here = Window.partitionBy("length", "_tag").orderBy("doc_id", "piece")
    numbered = tagged.withColumn("_row", F.row_number().over(here).cast("long") - 1)

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        r, parts, starts = sent.value
        size, tag, row = (np.asarray(batch[c]) for c in ("length", "_tag", "_row"))
        none = size == 0
        number = row.copy()
        number[~none] += starts[np.searchsorted(parts, (size * tags + tag)[~none])]
        at = np.zeros(len(size), np.int64)
        left, right = np.searchsorted(r["length"], size, "left"), np.searchsorted(r["length"], size, "right")
        for value in np.unique(size[~none]):
            rows = size == value
            lo, hi = left[rows][0], right[rows][0]
            at[rows] = lo + np.searchsorted(r["first"][lo:hi], number[rows], "right") - 1
        out = {c: batch[c] for c in ("doc_id", "piece", "start", "length")}
        if len(r["length"]):
            inside = number - r["first"][at]
            where = {
                "bin_id": r["base"][at] + inside // r["times"][at],
                "capacity": r["capacity"][at],
                "offset": r["offset"][at] + inside % r["times"][at] * size,
            }
        else:
            where = dict.fromkeys(("bin_id", "capacity", "offset"), np.zeros(len(size), np.int64))
        yield out | {c: pa.array(v, mask=none) for c, v in where.items()}

    return map_batches(numbered, run, PACKED)


def pack_texts(
    docs: DataFrame, file: bytes, pattern: str, capacities: Sequence[int] = CAPACITIES, bin_cost: int = BIN_COST, key: str = "doc_id"
) -> DataFrame:
    """Pack documents by the tokens of their texts, as the tokenizer of a .json file counts them.

    Texts are counted once; the counts, two numbers a row, are written, as packing reads them three times.
    """
    counted = token_transducer.count_tokens(docs, file, pattern, key=key).select("doc_id", "n_tokens")
    return pack_documents(materialise(counted, "token-counts"), F.col("n_tokens"), capacities, bin_cost)
