"""Token counts by a finite-state transducer and a prefix scan over chunks.

**Transducer.** Merging by rank has one property that makes it finite-state: a token sequence
is the encoding of its bytes exactly when each token, and each neighbouring pair, encodes its
own bytes. So the encoding of a prefix ends in the one token that is a suffix of the prefix and
forms a good pair with the last token of what lies before it. A state therefore needs, for every
suffix that may still grow into a token, the trie node of that suffix, the token before it (or,
where few tokens lie below the node, which of them go well with it), and how many tokens lie
before it, relative to the encoding of the whole prefix. A transition reads one byte and is
annotated with the change of the token count. States are made on first use and kept up to a
bound; beyond it the tables start anew, which costs time, not results.

**Scan.** A text is cut into chunks. Wherever a whitespace character follows another kind of
character, the splitting pattern starts a new piece, whatever lies further left or right. So the
map of a chunk over incoming states is constant but for its head: it is stored as (head before
the first such place, count between, tail after the last). Maps compose associatively, and
a two-sweep prefix scan composes them for all chunks of a text.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepanel.llm.common import kept, map_batches, release, slices, utf8_size
from tradepanel.llm.pieces import Splitter, budget_slices

CHUNK = 1 << 16  # characters
MOST_STATES = 120_000  # about 100 MB with their transitions; fewer are made anew too often
MOST_PAIRS = 250_000  # about 35 MB
MOST_PIECES = 100_000  # of 64 bytes at most, in each of two generations, about 20 MB together
FEW_TOKENS = 16
START = -1
NEVER = 1 << 60


class Transducer:
    """Counts the tokens of byte strings; ``merges`` maps pairs of tokens to (rank, token).

    A merge must rank after the merges that make its two parts, as training orders them.
    """

    def __init__(self, tokens: list[bytes], merges: dict[tuple[int, int], tuple[int, int]], of_byte: list[int]):
        self.tokens, self.of_byte = tokens, of_byte
        self.rank_of = {pair: rank for pair, (rank, _) in merges.items()}
        self.made = {pair: token for pair, (_, token) in merges.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        for pair, token in self.made.items():
            if token in self.parts:
                raise ValueError("a token is made by two merges")
            self.parts[token] = pair
            if any(p in self.parts and self.rank_of[self.parts[p]] > self.rank_of[pair] for p in pair):
                raise ValueError("a merge ranks before one that makes its part")
        self.child: dict[int, int] = {}  # node << 8 | byte -> node
        self.ends: dict[int, int] = {}  # node -> token
        self.below: dict[int, list[int] | None] = {}  # node -> tokens strictly below, or None if many
        nodes = 1
        for i, token in enumerate(tokens):
            node, path = 0, []
            for x in token:
                path.append(node)
                to = self.child.get(node << 8 | x)
                if to is None:
                    to = self.child[node << 8 | x] = nodes
                    nodes += 1
                node = to
            if token:
                self.ends[node] = i
            for above in path:
                found = self.below.setdefault(above, [])
                if found is not None:
                    found.append(i)
                    if len(found) > FEW_TOKENS:
                        self.below[above] = None
        self.pairs: dict[tuple[int, int], bool] = {}
        self.edges: dict[tuple[int, bool], list[tuple[int, int]]] = {}
        self.pieces: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}  # the generation before; what is still in use moves up again
        self.forget()

    def forget(self) -> None:
        # A thread: (trie node of the suffix, token before it or the tokens allowed below, tokens before it less those of the prefix).
        first = ((0, START, 0),)
        self.states, self.number, self.steps = [first], {first: 0}, {}

    def encode(self, data: bytes) -> list[int]:
        """Plain merging; only used on the bytes of one token."""
        ids = [self.of_byte[x] for x in data]
        while len(ids) > 1:
            best = min(((r, i) for i in range(len(ids) - 1) if (r := self.rank_of.get((ids[i], ids[i + 1]))) is not None), default=None)
            if best is None:
                break
            i = best[1]
            ids[i : i + 2] = [self.made[ids[i], ids[i + 1]]]
        return ids

    def edge(self, token: int, right: bool) -> list[tuple[int, int]]:
        """The parts of a token at one of its ends, from the byte up, each with the rank at which it is absorbed."""
        found = self.edges.get((token, right))
        if found is None:
            found, rank, t = [], NEVER, token
            while True:
                found.append((t, rank))
                if t not in self.parts:
                    break
                rank, t = self.rank_of[self.parts[t]], self.parts[t][right]
            found = self.edges[token, right] = found[::-1]
        return found

    def good(self, before: int, token: int) -> bool:
        """Whether a token stands after another one (or at the start) in an encoding.

        Merges happen in order of rank, so it is enough to watch the seam: the parts beside it
        must each be absorbed into their own token before they would merge with one another. Of
        equal ranks the leftmost merge comes first.
        """
        found = self.pairs.get((before, token))
        if found is not None:
            return found
        if before == START:
            found = self.encode(self.tokens[token]) == [token]
        else:
            found, left, right, i, j = True, self.edge(before, True), self.edge(token, False), 0, 0
            while True:
                (x, x_end), (y, y_end) = left[i], right[j]
                rank = self.rank_of.get((x, y), NEVER)
                if rank < x_end and rank <= y_end and rank < NEVER:
                    found = False
                    break
                if x_end == NEVER and y_end == NEVER:
                    break
                if x_end <= y_end:
                    i += 1
                else:
                    j += 1
        if len(self.pairs) >= MOST_PAIRS:
            self.pairs.clear()
        self.pairs[before, token] = found
        return found

    def thread(self, node: int, before: int | tuple, less: int) -> tuple | None:
        """A thread in the form that states are compared by; None if it can never yield a token."""
        tokens = self.below.get(node, ())
        if tokens is None:
            return node, before, less
        if isinstance(before, tuple):
            under = tuple(t for t in before if t in tokens)
        else:
            under = tuple(t for t in tokens if self.good(before, t))
        return (node, under, less) if under else None

    def compile_step(self, state: int, byte: int) -> tuple[int, int]:
        """The transition of a state by one byte: next state and change of the token count."""
        grown, last = [], None
        for node, before, less in self.states[state]:
            to = self.child.get(node << 8 | byte)
            if to is None:
                continue
            grown.append((to, before, less))
            token = self.ends.get(to)
            if token is not None and last is None and (token in before if isinstance(before, tuple) else self.good(before, token)):
                last = (token, less + 1)
        if last is None:
            raise ValueError(f"the vocabulary has no token for byte {byte}")
        token, change = last
        threads = tuple(t for node, before, less in grown if (t := self.thread(node, before, less - change)))
        threads += ((0, token, 0),)
        to = self.number.get(threads)
        if to is None:
            to = self.number[threads] = len(self.states)
            self.states.append(threads)
        self.steps[state << 8 | byte] = (to, change)
        return to, change

    def count(self, data: bytes) -> int:
        """Tokens of one piece."""
        found = self.pieces.get(data)
        if found is not None:
            return found
        total = self.older.get(data)
        if total is None:
            if len(self.states) >= MOST_STATES:
                self.forget()
            state = total = 0
            steps = self.steps
            for x in data:
                step = steps.get(state << 8 | x)
                if step is None:
                    step = self.compile_step(state, x)
                state = step[0]
                total += step[1]
        if len(data) <= 64:
            if len(self.pieces) >= MOST_PIECES:
                self.older, self.pieces = self.pieces, {}
            self.pieces[data] = total
        return total


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does to any incoming state. ``cut`` is false if the chunk has no certain place."""

    head: str
    count: int
    tail: str
    cut: bool


class Counter:
    """Counts tokens of whole texts as the tokenizer of a .json file does."""

    def __init__(self, file: bytes, pattern: str, chunk: int = CHUNK):
        spec = json.loads(file)
        model, before = spec["model"], spec["pre_tokenizer"]
        plain = before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        if model["type"] != "BPE" or not plain or spec["normalizer"] or model.get("ignore_merges"):
            raise ValueError("only byte-level BPE files without normalizer are compiled")
        # Printable stand-ins of the 256 bytes: printable Latin-1 characters stand for themselves, the rest from 256 on.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in own]
        byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}
        self.special = sorted((x["content"] for x in spec["added_tokens"]), key=len, reverse=True)
        tokens = [b""] * (max(model["vocab"].values()) + 1)
        for word, i in model["vocab"].items():
            if word not in self.special:
                tokens[i] = bytes(byte_of[c] for c in word)
        ids, merges = model["vocab"], {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            merges.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
        of_byte = [0] * 256
        for c, b in byte_of.items():
            of_byte[b] = ids[c]
        self.transducer = Transducer(tokens, merges, of_byte)
        self.splitter = Splitter(pattern)
        self.place = regex.compile(r"\S(?=\s)")
        self.last_place = regex.compile(r"(?r)\S(?=\s)")
        self.at_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.chunk = chunk

    def tokens_in(self, texts: list[str]) -> np.ndarray:
        """Tokens of texts that begin and end at certain places; every different piece is looked up once."""
        pieces, begins = self.splitter.split(texts)
        coded = pieces.dictionary_encode()
        known = coded.dictionary.to_pylist()
        each = np.fromiter(map(self.transducer.count, known), np.int64, len(known))
        total = np.concatenate([[0], np.cumsum(each[np.asarray(coded.indices)])])[begins]
        return np.diff(total)

    def sum_of(self, *texts: str) -> int:
        return int(self.tokens_in(list(texts)).sum())

    def map_of(self, text: str) -> ChunkMap:
        first = self.place.search(text)
        if first is None:
            return ChunkMap(text, 0, "", False)
        a, b = first.end(), self.last_place.search(text).end()
        return ChunkMap(text[:a], self.sum_of(text[a:b]), text[b:], True)

    def compose(self, x: ChunkMap, y: ChunkMap) -> ChunkMap:
        # A chunk's end can hide a place: its last character may be followed by a space in the next chunk.
        if not x.cut or not y.cut:
            if not x.cut and not y.cut:
                whole = self.map_of(x.head + y.head)
                return whole
            if not x.cut:
                start = self.map_of(x.head + y.head)
                if not start.cut:
                    return ChunkMap(x.head + y.head, y.count, y.tail, True)
                inner = self.sum_of(start.tail)
                return ChunkMap(start.head, start.count + inner + y.count, y.tail, True)
            end = self.map_of(x.tail + y.head)
            if not end.cut:
                return ChunkMap(x.head, x.count, x.tail + y.head, True)
            inner = self.sum_of(end.head)
            return ChunkMap(x.head, x.count + inner + end.count, end.tail, True)
        return ChunkMap(x.head, x.count + self.sum_of(x.tail + y.head) + y.count, y.tail, True)

    def close(self, x: ChunkMap) -> int:
        """Tokens of the text whose map this is, from the start state to its end."""
        return x.count + self.sum_of(x.head, x.tail)

    def count_texts(self, texts: list[str]) -> np.ndarray:
        """Tokens of whole texts. A text within one chunk is its own closed map."""
        total, short, owner = np.zeros(len(texts), np.int64), [], []
        for i, text in enumerate(texts):
            parts = self.at_special.split(text) if self.at_special else [text]
            total[i] = len(parts) - 1
            for part in parts:
                if len(part) <= self.chunk:
                    short.append(part)
                    owner.append(i)
                else:
                    maps = [self.map_of(part[k : k + self.chunk]) for k in range(0, len(part), self.chunk)]
                    total[i] += self.close(prefix_scan(maps, self.compose)[-1])
        start = 0
        for run in budget_slices(short, 2 << 20):
            np.add.at(total, owner[start : start + len(run)], self.tokens_in(run))
            start += len(run)
        return total


def prefix_scan(items: list[Any], compose: Callable[[Any, Any], Any]) -> list[Any]:
    """All prefixes of an associative operation in two sweeps of logarithmic depth."""
    if len(items) == 1:
        return items
    pairs = [compose(items[i], items[i + 1]) for i in range(0, len(items) - 1, 2)]
    above = prefix_scan(pairs, compose)
    out = [items[0]]
    for i in range(1, len(items)):
        out.append(above[i // 2] if i % 2 else compose(above[i // 2 - 1], items[i]))
    return out


def count_tokens(
    docs: DataFrame, file: bytes, pattern: str, limit: int = 1024, chunk: int = CHUNK, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Token counts of whole texts: key, ``n_bytes``, ``n_tokens`` and ``over_limit`` for each row of ``docs``.

    Special strings inside a text count as one token each. A null text counts as empty (0 tokens).
    Repeated rows give repeated rows, an empty table an empty one; only the two named columns are
    read. No shuffle; a text of any length is counted, in time linear in its length where white
    space stands in every chunk, and more than linear in runs of many chunks without any.
    """
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    sent = docs.sparkSession.sparkContext.broadcast(file)  # one file of fixed size
    mark = hashlib.sha256(file).hexdigest()

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        counter = kept(("counter", mark, pattern, chunk), lambda: Counter(sent.value, pattern, chunk))
        for part in slices(batch, "text"):
            found = counter.count_texts([x or "" for x in part["text"].to_pylist()])
            yield {"doc_id": part["doc_id"], "n_bytes": part["n_bytes"], "n_tokens": found}
        release()

    body = docs[text].cast("string")
    chosen = docs.select(docs[key].cast("long").alias("doc_id"), utf8_size(body).alias("n_bytes"), body.alias("text"))
    return map_batches(chosen, run, schema).withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
