"""Byte-level BPE by monoid tree reduction.

Encodings of byte strings form a monoid: the join of two encodings is the encoding of the
joined bytes. A piece is encoded as the join of its halves, recursively. A join re-encodes a
window around the seam and lets it grow until the tokens outside provably cannot change.

Why that is certain: a sequence of tokens is the encoding of its bytes exactly when every
neighbouring pair is the encoding of its own bytes. (Until a first merge crosses a seam,
each pair evolves as it would alone, so that merge would also happen in the pair alone.)
Pairs inside both halves are already good, as are those inside the re-encoded window, so only
the two pairs at the window's edges need a test.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tradepanel.llm.common import kept, map_batches, parse_ranks
from tradepanel.llm.pieces import Splitter, budget_slices

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("decoded", T.BinaryType()),
    ]
)
SHORT = 8  # halves up to this many bytes are remembered
MOST_KEPT = 400_000  # entries of each memory of parts before it starts anew
MOST_PIECES = 1_000_000
FEW = 24  # parts that are merged without a heap
NEVER = 1 << 60


def merge(parts: list[bytes], ranks: dict[bytes, int]) -> list[bytes]:
    """Plain merging, lowest rank first and leftmost among equals; beyond a few parts with a heap over linked parts."""
    n = len(parts)
    if n <= FEW:
        rank = ranks.get
        order = [rank(parts[i] + parts[i + 1], NEVER) for i in range(n - 1)]
        while order and (low := min(order)) != NEVER:
            i = order.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del order[i]
            if i < len(order):
                order[i] = rank(parts[i] + parts[i + 1], NEVER)
            if i:
                order[i - 1] = rank(parts[i - 1] + parts[i], NEVER)
        return parts
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or parts[i] != a or parts[j] != b:
            continue
        parts[i], alive[j], k = a + b, False, after[j]
        after[i] = k
        if k < n:
            before[k] = i
            if (r := ranks.get(parts[i] + parts[k])) is not None:
                heapq.heappush(heap, (r, i, parts[i], parts[k]))
        if (h := before[i]) >= 0 and (r := ranks.get(parts[h] + parts[i])) is not None:
            heapq.heappush(heap, (r, h, parts[h], parts[i]))
    return [p for p, there in zip(parts, alive) if there]


class TreeEncoder:
    """Encodes and decodes with one table of ranks; the tokens of a tree are byte strings."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.single = [bytes([i]) for i in range(256)]
        self.halves: dict[bytes, list[bytes]] = {}
        self.windows: dict[bytes, list[bytes]] = {}
        self.pieces: dict[bytes, bytes] = {}

    def window(self, data: bytes) -> list[bytes]:
        found = self.windows.get(data)
        if found is None:
            found = merge([self.single[x] for x in data], self.ranks)
            if len(data) <= 4 * SHORT:
                if len(self.windows) >= MOST_KEPT:
                    self.windows.clear()
                self.windows[data] = found
        return found

    def stable(self, a: bytes, b: bytes) -> bool:
        """Whether two neighbouring tokens are the encoding of their own bytes."""
        found = self.window(a + b)
        return len(found) == 2 and found[0] == a

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        k = 1
        while True:
            head, tail = left[:-k], right[k:]
            middle = self.window(b"".join(left[-k:]) + b"".join(right[:k]))
            if (not head or self.stable(head[-1], middle[0])) and (not tail or self.stable(middle[-1], tail[0])):
                return head + middle + tail
            k *= 2

    def tree(self, data: bytes) -> list[bytes]:
        if len(data) <= 1:
            return [data] if data else []
        if len(data) <= SHORT and (found := self.halves.get(data)) is not None:
            return found
        half = len(data) // 2
        found = self.join(self.tree(data[:half]), self.tree(data[half:]))
        if len(data) <= SHORT:
            if len(self.halves) >= MOST_KEPT:
                self.halves.clear()
            self.halves[data] = found
        return found

    def encode_piece(self, data: bytes) -> list[int]:
        """Ids of one match of the pattern; a match that is a token stays whole."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else [self.ranks[t] for t in self.tree(data)]

    def piece_ids(self, piece: bytes) -> bytes:
        """Ids of one piece as little-endian unsigned 32-bit integers."""
        ids = self.pieces.get(piece)
        if ids is None:
            ids = np.array(self.encode_piece(piece), "<u4").tobytes()
            if len(piece) <= 64:
                if len(self.pieces) >= MOST_PIECES:
                    self.pieces.clear()
                self.pieces[piece] = ids
        return ids

    def encode_texts(self, texts: list[str], splitter: Splitter) -> list[np.ndarray]:
        """Ids of each text; every different piece of the batch is looked up once."""
        pieces, begins = splitter.split(texts)
        if not len(pieces):
            return [np.zeros(0, "<u4")] * len(texts)
        coded = pieces.dictionary_encode()
        which = np.asarray(coded.indices)
        ids = list(map(self.piece_ids, coded.dictionary.to_pylist()))
        flat = np.frombuffer(b"".join(ids), "<u4")
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        source = (np.cumsum(size) - size)[which]  # first id of each piece in ``flat``
        sizes = size[which]
        target = np.concatenate([[0], np.cumsum(sizes)])
        out = flat[np.arange(target[-1]) + np.repeat(source - target[:-1], sizes)]
        bounds = target[begins]
        return [out[i:j] for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def decode(self, ids: list[int], leaf: int = 8192) -> bytes:
        """Bytes of the ids, concatenated up a tree."""
        if len(ids) <= leaf:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half], leaf) + self.decode(ids[half:], leaf)


def encode_documents(
    docs: DataFrame, vocabulary: bytes, pattern: str, digests: bool = False, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode whole texts and decode the ids again: one row per row of ``docs``.

    Returns the key, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit) and ``decoded`` bytes;
    with ``digests`` the last two are lowercase hex SHA-256 strings instead. A null text counts as
    empty: no tokens, no bytes. Repeated rows give repeated rows, an empty table an empty one; only
    the two named columns are read, so others cannot clash. No shuffle.
    """
    names = {"ids": "ids_sha256", "decoded": "decoded_sha256"}
    schema = SCHEMA
    if digests:
        schema = T.StructType([T.StructField(names.get(f.name, f.name), T.StringType() if f.name in names else f.dataType) for f in SCHEMA])
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # one file of fixed size
    mark = hashlib.sha256(vocabulary).hexdigest()

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        coder = kept(("byte_bpe", mark), lambda: TreeEncoder(parse_ranks(sent.value)))
        splitter = kept(("splitter", pattern), lambda: Splitter(pattern))
        start = 0
        for texts in budget_slices([x or "" for x in batch["text"].to_pylist()]):
            found = coder.encode_texts(texts, splitter)
            rows = batch["doc_id"].slice(start, len(texts))
            start += len(texts)
            ids = [x.tobytes() for x in found]
            back = [coder.decode(x.tolist()) for x in found]
            out = {"doc_id": rows, "n_tokens": [len(x) for x in found], "ids": ids, "decoded": back}
            if digests:
                out |= {names[c]: [hashlib.sha256(x).hexdigest() for x in out[c]] for c in names}
            yield out

    chosen = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return map_batches(chosen, run, schema)
