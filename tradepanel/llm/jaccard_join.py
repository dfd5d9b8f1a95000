"""Similarity classes of documents by the Jaccard coefficient of their word shingles: T-occurrence search.

Two sets of sizes m and n reach the similarity p/q exactly if they share at least T = p (m + n) / (p + q)
shingles, so at least p/q of the larger set. Searching for sets that occur at least T times in the inverted
lists of a query's shingles follows DivideSkip: short lists are merged and counted, long ones are only
probed by binary search for the few candidates that the short lists leave.

How the search is spread over tasks:

1. Equal sets are one class from the start (by a 128-bit digest); all further work is on distinct sets.
2. Every set is ordered by one global order, the most frequent shingles last and the rest by hash. Of its
   n shingles any n - T + 1 form the short lists; the rarest are taken (the prefix). Similar sets share one.
   Which shingles count as frequent changes the cost, never the result.
3. In each inverted list, members are tied to the list's leader. Ties that hold over many lists form
   tentative clusters: groups of near copies, in which nearly all pairs would be candidates.
4. Inside a cluster the full T-occurrence search runs on blocks of bounded size and yields only links that
   connect something new. Pairs of members of different clusters are counted over all lists
   and verified where their count can still reach T: first by the low bytes of their shingles, which bound
   the overlap from above, then exactly. So every pair that shares a prefix
   shingle is decided, and no list or cluster is expanded into its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepanel.llm import bytescan
from tradepanel.llm.common import kept, map_batches, release, sieved, slices
from tradepanel.llm.components import components
from tradepanel.session import materialise

FREQUENT = 1 << 16  # shingles that are ordered last, at most
LOCAL = 4  # sets of one portion that a shingle must be in to be considered for that
PORTION = 1 << 21  # shingles that a task looks through for that at a time
TEXT_SLICE = 1 << 20  # bytes of text that are made sets at a time
LIST_BLOCK = 2048  # members of a list, or
SHINGLE_BLOCK = 1 << 20  # shingles of a cluster, that are paired with another such block at a time
WIDE = 1 << 12  # shingles of a set from which four bytes of each, not two, bound an overlap
TIED = 0.05  # share of a set's prefix that, in lists led by one leader and at least two of them, ties it to that


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[bytes]]]:
    tables = kept("bytescan", lambda: bytescan._tables(True))
    for rows in slices(batch, "text", TEXT_SLICE):
        sets = bytescan.shingle_sets([(x or "").encode() for x in rows["text"].to_pylist()], size, tables)
        yield rows, sets, [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]


def _ids(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<i8")[::2]


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


LONG, BIN = T.LongType(), T.BinaryType()


def members(docs: DataFrame, size: int) -> DataFrame:
    """One row per document (``doc_id``, ``key``, ``n``, ``set_id``), and rows of locally frequent shingles (``shingle``, ``count``)."""

    def frequent(held: list[np.ndarray]) -> dict:
        flat = np.concatenate(held)
        flat.sort()
        last = flat[LOCAL - 1 :]
        found = np.unique(last[last == flat[: len(last)]])
        count = np.searchsorted(flat, found, "right") - np.searchsorted(flat, found, "left")
        none = pa.nulls(len(found), pa.int64())
        return {"doc_id": none, "key": none, "n": none, "set_id": none, "shingle": found.view(np.int64), "count": count}

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        seen: set[bytes] = set()
        held: list[np.ndarray] = []
        size_held = 0
        for rows, sets, digests in _sets(batch, size):
            none = pa.nulls(len(sets), pa.int64())
            yield {
                "doc_id": rows["doc_id"], "key": rows["key"], "n": [len(s) for s in sets], "set_id": _ids(digests), "shingle": none, "count": none
            }
            for s, digest in zip(sets, digests):
                if digest not in seen:
                    seen.add(digest)
                    held.append(s)
                    size_held += len(s)
            if size_held >= PORTION:
                yield frequent(held)
                held, size_held = [], 0
        if held:
            yield frequent(held)
        held, sets = [], []
        release()

    return map_batches(docs, run, _struct(doc_id=LONG, key=LONG, n=LONG, set_id=LONG, shingle=LONG, count=LONG))


def prefixes(docs: DataFrame, size: int, p: int, q: int, frequent: np.ndarray) -> DataFrame:
    """Prefix entries of the distinct sets of each batch: ``h``, ``set_id``, ``n`` and the position in the order."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent)  # at most FREQUENT numbers

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        hot, seen = sent.value, set()
        for _, sets, digests in _sets(batch, size):
            parts: dict[str, list[np.ndarray]] = {"h": [], "set_id": [], "n": [], "pos": []}
            for s, digest, set_id in zip(sets, digests, _ids(digests)):
                n = len(s)
                if not n or digest in seen:
                    continue
                seen.add(digest)
                keep = n - -(-p * n // q) + 1
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
                    late = hot[at] == s
                    s = np.concatenate([s[~late], s[late]])
                parts["h"].append(s[:keep].view(np.int64))
                parts["set_id"].append(np.full(keep, set_id))
                parts["n"].append(np.full(keep, n))
                parts["pos"].append(np.arange(keep))
            if parts["h"]:
                yield {c: np.concatenate(v) for c, v in parts.items()}
        release()

    return map_batches(docs, run, _struct(h=LONG, set_id=LONG, n=LONG, pos=LONG))


def shared_lists(entries: DataFrame) -> DataFrame:
    """Entries of lists with two sets or more, each with its list's ``leader``; streamed, whatever a list's length."""
    schema = _struct(h=LONG, set_id=LONG, n=LONG, pos=LONG, leader=LONG)
    arrow = pa.schema([(f.name, pa.int64()) for f in schema])
    names = ["h", "set_id", "n", "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {c: np.zeros(0, np.int64) for c in names}  # the last list's rows, one at most
        last: tuple[int, int, int] | None = None  # list that has been passed on in part, its leader, its last set
        for batch in batches:
            x = {c: np.concatenate([held[c], np.asarray(batch[c])]) for c in names}
            h, s = x["h"], x["set_id"]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
            if last and len(h) and (h[0], s[0]) == (last[0], last[2]):
                new[0] = False
            x = {c: v[new] for c, v in x.items()}
            h, s = x["h"], x["set_id"]
            held = {c: v[:0] for c, v in x.items()}
            if not len(h):
                continue
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            length = np.diff(np.concatenate([first, [len(h)]]))
            leader = s[first].copy()
            keep = length > 1
            if last and h[0] == last[0]:
                leader[0], keep[0] = last[1], True
            if not keep[-1]:
                held = {c: v[-1:] for c, v in x.items()}
                last = None
            else:
                last = (int(h[-1]), int(leader[-1]), int(s[-1]))
            rows = np.repeat(keep, length)
            if rows.any():
                x = {c: v[rows] for c, v in x.items()} | {"leader": np.repeat(leader[keep], length[keep])}
                yield pa.RecordBatch.from_arrays([pa.array(x[f.name]) for f in arrow], schema=arrow)

    return entries.repartition("h").sortWithinPartitions("h", "set_id").mapInArrow(run, schema)


def cross_pairs(lists: DataFrame, clusters: DataFrame, p: int, q: int) -> DataFrame:
    """Pairs of sets in different clusters whose count over all lists can still reach T: ``a``, ``b``."""
    own = lists.select("h", "set_id", "n", "pos").join(clusters.hint("merge"), "set_id", "left").withColumn("cluster", F.coalesce("cluster", "set_id"))
    # Only long lists need blocks; they are few, so that the other lists are shuffled once, to their pairs.
    long = lists.groupBy("h").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > LIST_BLOCK)
    long = long.select("h", F.expr(f"cast((members + {LIST_BLOCK - 1}) div {LIST_BLOCK} as int)").alias("blocks"))
    long = materialise(long, "long")  # written, so that its size is known before the entries would be shuffled to it
    own = own.join(long, "h", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = own.withColumn("side", F.expr("cast(pmod(set_id, blocks) as int)"))
    spread = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.select(
        "h", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "set_id", "n", "pos", "cluster"
    )
    schema = _struct(a=LONG, b=LONG, na=LONG, nb=LONG, c=LONG)
    arrow = pa.schema([(f.name, pa.int64()) for f in schema])
    names = ["h", "i", "j", "side", "set_id", "n", "pos", "cluster"]

    def pairs(x: dict[str, np.ndarray]) -> Iterator[np.ndarray]:
        """Pairs of rows of the same list and block pair, one distance between rows at a time."""
        h, i, j = (x[c] for c in names[:3])
        if not len(h):
            return
        first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
        mixed = np.minimum.reduceat(x["cluster"], first) != np.maximum.reduceat(x["cluster"], first)
        mixed = np.repeat(mixed, np.diff(np.concatenate([first, [len(h)]])))
        h, i, j, side, s, n, pos, cluster = (x[c][mixed] for c in names)
        at = np.arange(len(h))
        for d in range(1, len(h)):
            at = at[at + d < len(h)]
            to = at + d
            at = at[(h[at] == h[to]) & (i[at] == i[to]) & (j[at] == j[to])]
            if not len(at):
                return
            to = at + d
            good = (cluster[at] != cluster[to]) & ((i[at] == j[at]) | (side[at] != side[to]))
            u, v = at[good], to[good]
            total = n[u] + n[v]
            good = q * np.minimum(n[u], n[v]) >= p * np.maximum(n[u], n[v])
            reach = np.minimum(pos[u], pos[v]) + 1 + np.minimum(n[u] - pos[u], n[v] - pos[v]) - 1
            good &= (p + q) * reach >= p * total
            u, v = u[good], v[good]
            swap = s[u] > s[v]
            u, v = np.where(swap, v, u), np.where(swap, u, v)
            if len(u):
                yield np.stack([s[u], s[v], n[u], n[v]], 1)

    def counted(found: list[np.ndarray]) -> pa.RecordBatch:
        rows, count = np.unique(np.concatenate(found), axis=0, return_counts=True)
        return pa.RecordBatch.from_arrays([*(pa.array(rows[:, k].copy()) for k in range(4)), pa.array(count)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {c: np.zeros(0, np.int64) for c in names}  # the last group, of two blocks at most
        found: list[np.ndarray] = []
        size = 0
        for batch in batches:
            x = {c: np.concatenate([held[c], np.asarray(batch[c]).astype(np.int64)]) for c in names}
            if not len(x["h"]):
                continue
            tail = (x["h"] == x["h"][-1]) & (x["i"] == x["i"][-1]) & (x["j"] == x["j"][-1])
            cut = int(np.argmax(tail))
            held = {c: v[cut:] for c, v in x.items()}
            for rows in pairs({c: v[:cut] for c, v in x.items()}):
                found.append(rows)
                size += len(rows)
                if size > 1 << 20:
                    yield counted(found)
                    found, size = [], 0
        for rows in pairs(held):
            found.append(rows)
            size += len(rows)
            if size > 1 << 20:
                yield counted(found)
                found, size = [], 0
        if found:
            yield counted(found)

    made = spread.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j").mapInArrow(run, schema)
    total = made.groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"), F.sum("c").alias("c"))
    # Common shingles that no list has counted lie behind one of the two prefixes.
    behind = F.greatest(F.expr(f"({p} * na + {q - 1}) div {q}"), F.expr(f"({p} * nb + {q - 1}) div {q}")) - 1
    return total.where((F.col("c") + behind) * (p + q) >= (F.col("na") + F.col("nb")) * p).select("a", "b")


def search(queries: list[tuple[int, np.ndarray]], index: list[tuple[int, np.ndarray]], p: int, q: int, same: bool) -> list[tuple[int, int]]:
    """Links between queries and indexed sets that connect something new, by DivideSkip.

    ``same`` says that both are the same list; then each pair is looked at once.
    """
    root = {i: i for i, _ in [*queries, *index]}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    sizes = np.array([len(s) for _, s in index])
    order = np.argsort(np.concatenate([s for _, s in index]), kind="stable")
    flat = np.concatenate([s for _, s in index])[order]
    owner = np.repeat(np.arange(len(index)), sizes)[order]
    start = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    keys, stop = flat[start], np.concatenate([start[1:], [len(flat)]])
    links = []
    for number, (me, s) in enumerate(queries):
        at = np.searchsorted(keys, s)
        at = at[(at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == s)]
        least = -(-p * len(s) // q)  # no set shares fewer and is similar
        if len(at) < least:
            continue
        length = stop[at] - start[at]
        at = at[np.argsort(length, kind="stable")]
        # Long lists: as many as still leave a count to reach in the short ones, but only those worth skipping.
        longest = int(length.max())
        skip = min(least - 1, int(least / (0.01 * np.log2(longest + 1) + 1)))
        short, long = at[: len(at) - skip], at[len(at) - skip :]
        merged = np.concatenate([owner[start[k] : stop[k]] for k in short]) if len(short) else np.zeros(0, np.int64)
        count = np.bincount(merged, minlength=len(index))
        found = np.flatnonzero(count >= max(1, least - skip))
        if same:
            found = found[found > number]
        found = found[(q * np.minimum(sizes[found], len(s)) >= p * np.maximum(sizes[found], len(s)))]
        found = found[[find(index[k][0]) != find(me) for k in found.tolist()]] if len(found) else found
        if not len(found):
            continue
        shared = count[found].astype(np.int64)
        for k in long:
            members_of = owner[start[k] : stop[k]]
            place = np.searchsorted(members_of, found)
            shared += (place < len(members_of)) & (members_of[np.minimum(place, len(members_of) - 1)] == found)
        for k in found[(p + q) * shared >= p * (sizes[found] + len(s))].tolist():
            a, b = find(me), find(index[k][0])
            if a != b:
                root[a] = b
                links.append((me, index[k][0]))
    return links


def chosen(own: DataFrame, clusters: DataFrame, pairs: DataFrame) -> DataFrame:
    """One document of each set that is in a cluster or in a pair: ``key``, ``set_id``, ``n``, ``cluster``, ``blocks``, ``paired``, ``copies``.

    ``blocks`` says into how many parts the set's cluster is cut, ``paired`` whether the set is in a pair, ``copies`` how
    many rows have the document's key and set. Everything here is numbers; copies are counted before sets meet their clusters.
    """
    paired = pairs.select(F.explode(F.array("a", "b")).alias("set_id"), F.lit(None).cast("long").alias("cluster"), F.lit(True).alias("paired"))
    needed = clusters.select("set_id", "cluster", F.lit(False).alias("paired")).union(paired)
    needed = needed.groupBy("set_id").agg(F.max("cluster").alias("cluster"), F.max("paired").alias("paired"))
    found = own.where("n > 0").groupBy("set_id", "n", "key").agg(F.count(F.lit(1)).alias("copies"))
    found = found.groupBy("set_id", "n").agg(F.min(F.struct("key", "copies")).alias("x")).join(needed, "set_id")
    found = found.select("x.key", "set_id", "n", "cluster", "paired", "x.copies")
    sizes = found.where("cluster is not null").groupBy("cluster").agg(F.sum("n").alias("shingles"))
    sizes = sizes.select("cluster", F.expr(f"cast((shingles + {SHINGLE_BLOCK - 1}) div {SHINGLE_BLOCK} as int)").alias("blocks"))
    return found.join(sizes, "cluster", "left").select("key", "set_id", "n", "cluster", "blocks", "paired", "copies")


def low_bytes(shingles: np.ndarray) -> bytes:
    """The low two (of large sets four) bytes of each shingle."""
    return shingles.astype(np.uint16 if len(shingles) < WIDE else np.uint32).tobytes()


def full_texts(rows: DataFrame, one: DataFrame) -> DataFrame:
    """``one`` with the text of each of its sets; texts are read again, and only those that a sieve of the keys lets through meet ``one``.

    Both this join and that of list entries with clusters are merged at every size, so that disk and memory a GB do not jump
    where a table of numbers grows past the broadcast limit.
    """
    _, needed = sieved(rows, one, "key")
    found = materialise(needed.join(one.hint("merge"), "key").select("set_id", "n", "cluster", "blocks", "paired", "copies", "text"), "texts")
    # Only rows that are repeated under one key come more than once.
    return found.where("copies = 1").union(found.where("copies > 1").dropDuplicates(["set_id", "text"]))


def _right(batch: pa.RecordBatch, size: int) -> Iterator[tuple[pa.RecordBatch, list[int], list[np.ndarray]]]:
    """The rows of a batch that have the set they stand for, in slices; a repeated key can have other sets too."""
    for part, sets, digests in _sets(batch, size):
        yield part, np.flatnonzero(_ids(digests) == np.asarray(part["set_id"])).tolist(), sets


def paired_sets(texts: DataFrame, size: int) -> DataFrame:
    """The shingles of each set that is in a pair, and ``low``, their low bytes."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for part, right, sets in _right(batch, size):
            out = {c: part[c].take(pa.array(right, pa.int64())) for c in ("set_id", "n")}
            yield out | {"shingles": [sets[k].tobytes() for k in right], "low": [low_bytes(sets[k]) for k in right]}
        release()

    return map_batches(texts.where("paired").select("set_id", "n", "text"), run, _struct(set_id=LONG, n=LONG, shingles=BIN, low=BIN))


def cluster_links(texts: DataFrame, size: int, p: int, q: int) -> DataFrame:
    """Links inside clusters; a cluster with many shingles is searched block by block. Texts move, which are shorter than their sets."""
    own = texts.where("cluster is not null").withColumn("side", F.expr("cast(pmod(set_id, blocks) as int)"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = own.select("cluster", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "set_id", "text")
    schema = _struct(a=LONG, b=LONG)
    arrow = pa.schema([(f.name, pa.int64()) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, []

        def close() -> list[tuple[int, int]]:
            i, j = now[1], now[2]
            left = sorted(((s, x) for side, s, x in group if side == i), key=lambda t: t[0])
            right = left if i == j else sorted(((s, x) for side, s, x in group if side == j), key=lambda t: t[0])
            return search(left, right, p, q, i == j) if left and right else []

        out: list[tuple[int, int]] = []
        for batch in batches:
            for part, right, sets in _right(batch, size):
                c, i, j, side, s = (part[k].to_pylist() for k in ("cluster", "i", "j", "side", "set_id"))
                for k in right:
                    if now != (c[k], i[k], j[k]):
                        if group:
                            out += close()
                        now, group = (c[k], i[k], j[k]), []
                    group.append((side[k], s[k], sets[k]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*out)], schema=arrow)
                out = []
        if group:
            out += close()
        group = []
        release()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*out)], schema=arrow)

    return own.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j").mapInArrow(run, schema)


def possible(pairs: DataFrame, sets: DataFrame, p: int, q: int) -> DataFrame:
    """Pairs that the low bytes of their shingles leave: common shingles have common low bytes, so a bound is never too small."""
    left = sets.select(F.col("set_id").alias("a"), F.col("n").alias("na"), F.col("low").alias("xa"))
    right = sets.select(F.col("set_id").alias("b"), F.col("n").alias("nb"), F.col("low").alias("xb"))

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        good = []
        for x, y, m, n in zip(batch["xa"], batch["xb"], batch["na"].to_pylist(), batch["nb"].to_pylist()):
            u, v = (np.frombuffer(z.as_buffer(), np.uint16 if k < WIDE else np.uint32) for z, k in ((x, m), (y, n)))
            if u.dtype != v.dtype:
                u, v = u.astype(np.uint16), v.astype(np.uint16)
            good.append((p + q) * int(np.isin(u, v).sum()) >= p * (m + n))
        mask = pa.array(good, pa.bool_())
        yield {"a": batch["a"].filter(mask), "b": batch["b"].filter(mask)}

    return map_batches(pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "xa", "xb"), run, _struct(a=LONG, b=LONG))


def verified(pairs: DataFrame, sets: DataFrame, p: int, q: int) -> DataFrame:
    """Pairs that are similar, by the exact overlap of their sets. Only sets of these pairs move."""

    def side(one: str, whole: str) -> DataFrame:
        mine = sets.select(F.col("set_id").alias(one), F.col("shingles").alias(whole))
        return mine.join(pairs.select(one).distinct(), one, "left_semi")

    left, right = side("a", "xa"), side("b", "xb")

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        good = []
        for x, y in zip(batch["xa"], batch["xb"]):
            u, v = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(np.intersect1d(u, v, assume_unique=True))
            good.append((p + q) * both >= p * (len(u) + len(v)))
        mask = pa.array(good, pa.bool_())
        yield {"a": batch["a"].filter(mask), "b": batch["b"].filter(mask)}

    return map_batches(pairs.join(left, "a").join(right, "b").select("a", "b", "xa", "xb"), run, _struct(a=LONG, b=LONG))


def similarity_classes(docs: DataFrame, p: int = 3, q: int = 4, size: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for each row of ``docs``; similar means Jaccard >= p / q.

    Words are runs of characters other than space and 0x09 to 0x0D, A-Z lower-cased. A set holds the
    distinct ``size``-word shingles; a shorter text has its whole word sequence as one. Texts without
    words (null, empty, blank) have no set and are linked with nothing: their component is their own
    doc_id. ``component_id`` is the smallest doc_id reachable by links. Repeated rows and ties are equal
    sets and thus linked; a null doc_id is never the smallest unless it is alone. An empty table gives
    no rows. Only the two named columns are read.
    """
    return text_classes(docs, p, q, size, key, text).select("doc_id", "n_shingles", "component_id")


def text_key(key: Column, text: Column) -> Column:
    """Tells rows of one id with different texts apart."""
    return F.xxhash64(key.cast("long"), text.cast("string"))


def text_classes(docs: DataFrame, p: int = 3, q: int = 4, size: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``similarity_classes`` with the ``text_key`` of each row as ``key``, and its ``class`` (null without words)."""
    spark = docs.sparkSession
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    rows = rows.withColumn("key", text_key(F.col("doc_id"), F.col("text")))  # rows without id are found again too
    first = materialise(members(rows, size), "members")
    own = first.where("set_id is not null").select("doc_id", "key", "n", "set_id")
    hottest = first.where("shingle is not null").groupBy("shingle").agg(F.sum("count").alias("c"))
    hottest = hottest.orderBy(F.desc("c"), "shingle").limit(FREQUENT).collect()  # a bounded list of numbers
    frequent = np.sort(np.array([r["shingle"] for r in hottest], np.int64).view(np.uint64))

    lists = materialise(shared_lists(prefixes(rows, size, p, q, frequent)), "lists")
    ties = lists.where("set_id <> leader").groupBy("set_id", "leader").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"))
    prefix = F.col("n") - F.expr(f"({p} * n + {q - 1}) div {q}") + 1
    ties = ties.where((F.col("c") >= 2) & (F.col("c") >= F.lit(TIED) * prefix)).select(F.col("set_id").alias("a"), F.col("leader").alias("b"))
    clusters = materialise(components(ties).withColumnsRenamed({"id": "set_id", "component": "cluster"}), "clusters")
    pairs = materialise(cross_pairs(lists, clusters, p, q), "pairs")

    # One document of each needed set; its text is read once more for the full set.
    texts = full_texts(rows, materialise(chosen(own, clusters, pairs), "chosen"))
    sets = materialise(paired_sets(texts, size), "sets")
    near = materialise(possible(pairs, sets, p, q), "near")
    links = cluster_links(texts, size, p, q).union(verified(near, sets, p, q))
    joined = components(links).withColumnsRenamed({"id": "set_id", "component": "class"})
    marked = own.join(joined, "set_id", "left").withColumn("class", F.when(F.col("n") > 0, F.coalesce("class", "set_id")))
    marked = materialise(marked, "classes")
    # Written, so that the join reads two plain tables and a class of any size can be split by adaptive execution.
    smallest = materialise(marked.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("component_id")), "smallest")
    return marked.join(smallest, "class", "left").select(
        "doc_id", "key", "class", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
