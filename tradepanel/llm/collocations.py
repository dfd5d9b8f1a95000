"""Phrase collocations: contiguous phrases counted in HAT-tries, scored by their weakest cut.

A task counts phrases in a trie over word ids: the first levels are tables of children, below them hang hash containers that
burst into a level of their own when they get full. When the trie outgrows its budget, whole subtrees are written out as
sorted runs, the largest first. Spark deals the runs by prefix partition and adds them up there.

A phrase can be frequent only if its words and its pairs are. One pass over the texts counts words; two passes sieve pairs, and then phrases
of three and four words, by counting hash slots instead of phrases; the last pass counts the phrases that came through, exactly. What is
frequent goes from pass to pass as a filter with a fixed number of bits, whatever the corpus; a bit set in vain, or two phrases in
one slot, cost a count that is dropped later, and lose nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepanel.session import materialise

BLOCK = 4 << 20  # bytes of text looked at together
FILTER_BITS = 1 << 26
SLICES = 64  # of a prefix partition, so that a frequent first word is no task of its own
FULL = 8192  # entries of a container that bursts
BUDGET = 400_000  # entries of a trie before subtrees are written out
RUN_ROWS = 20_000  # of a batch of runs
SLOT_BITS = 32  # of the hash slots that sieve phrases
BUCKET_BITS = 12  # slots are dealt by their first bits; a task holds the counts of one bucket at a time
HELD = 2_000_000  # slots that a task adds up before it passes them on
TEXT_BUDGET = 32 << 20  # bytes of words that a task holds
ID_BITS = 21  # of a word id inside a container's key
MOST_WORDS = 4

BLANK, STOP = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = BLANK
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = STOP


class HatTrie:
    """Counts of sequences of word ids. A node is a container (rest of the sequence, packed: count) or a ``Branch``; ``single`` counts words alone."""

    def __init__(self, full: int = FULL):
        self.top: dict[int, dict[int, int] | Branch] = {}
        self.single: dict[int, int] = {}
        self.full, self.size = full, 0

    def add_words(self, words: np.ndarray, counts: np.ndarray) -> None:
        before = len(self.single)
        for word, n in zip(words.tolist(), counts.tolist()):
            self.single[word] = self.single.get(word, 0) + n
        self.size += len(self.single) - before

    def add(self, first: np.ndarray, rest: np.ndarray, counts: np.ndarray) -> None:
        """Add counts of distinct sequences of two ids or more, ordered by their first id."""
        cuts = np.flatnonzero(np.diff(first, prepend=-1)).tolist()
        rests, numbers = rest.tolist(), counts.tolist()
        for a, b, word in zip(cuts, [*cuts[1:], len(rests)], first[cuts].tolist()):
            node = self.top.get(word)
            if node is None:
                node = self.top[word] = {}
            before = len(node)
            self.top[word] = _put(node, rests[a:b], numbers[a:b], self.full, MOST_WORDS - 1)
            self.size += len(self.top[word]) - before

    def largest(self, least: int) -> list[int]:
        """First ids of the largest subtrees that have ``least`` entries together."""
        out, total = [], 0
        for word in sorted(self.top, key=lambda w: -len(self.top[w])):
            if total >= least:
                break
            out.append(word)
            total += len(self.top[word])
        return out

    def take(self, word: int, rests: list[int], counts: list[int]) -> int:
        """Remove the subtree of a first id and append its packed rests and counts; returns their number."""
        node = self.top.pop(word)
        self.size -= len(node)
        _list(node, 0, MOST_WORDS - 1, rests, counts)
        return len(node)


class Branch(dict):
    """A burst container: next id to node, and the count of the sequence that ends here under key 0."""

    entries = 0

    def __len__(self) -> int:
        return self.entries


def _split(rest: int, depth: int) -> tuple[int, int]:
    """The next id of a packed rest of at most ``depth`` ids, and the rest behind it."""
    shift = ID_BITS * (depth - 1)
    return rest >> shift, rest & ((1 << shift) - 1)


def _put(node: dict | Branch, rests: list[int], counts: list[int], full: int, depth: int) -> dict | Branch:
    if isinstance(node, Branch):
        for rest, n in zip(rests, counts):
            _into(node, rest, n, full, depth)
        return node
    get = node.get
    for rest, n in zip(rests, counts):
        node[rest] = get(rest, 0) + n
    if len(node) <= full or depth < 2:
        return node
    burst = Branch()
    for rest, n in node.items():
        _into(burst, rest, n, full, depth)
    return burst


def _into(branch: Branch, rest: int, n: int, full: int, depth: int) -> None:
    word, behind = _split(rest, depth)
    child = branch.get(word)
    if child is None:
        child = branch[word] = {}
    before = len(child)
    branch[word] = child = _put(child, [behind], [n], full, depth - 1)
    branch.entries += len(child) - before


def _list(node: dict | Branch, before: int, depth: int, rests: list[int], counts: list[int]) -> None:
    if isinstance(node, Branch):
        for word, child in node.items():
            _list(child, before | word << ID_BITS * (depth - 1), depth - 1, rests, counts)
    else:
        rests.extend([before | rest for rest in node] if before else node)
        counts.extend(node.values())


def unpacked(rests: np.ndarray) -> list[np.ndarray]:
    """The ids of packed rests, one column for each place; 0 where a sequence has ended."""
    return [rests >> ID_BITS * d & (1 << ID_BITS) - 1 for d in range(MOST_WORDS - 2, -1, -1)]


@dataclass
class Filter:
    """A Bloom filter as broadcast bits; two bits for each entry."""

    bits: np.ndarray

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        size = np.uint64(len(self.bits) * 64)
        for h in (hashes, _mix(hashes)):
            at = h % size
            out &= (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def _word_hash(lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang + b"\0" + word)


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(a * np.uint64(0x9E3779B97F4A7C15) + b)


def _collected(rows: DataFrame, bits: int) -> Filter:
    """A filter from rows ``slot`` (of 64 bits) and ``bit``: at most ``bits`` / 64 numbers come to the driver."""
    slots = rows.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[slots["slot"].to_numpy()] = slots["bits"].to_numpy().view(np.uint64)
    return Filter(out)


def _filter_bits(keys: np.ndarray, bits: int) -> pa.RecordBatch:
    at = np.concatenate([keys % np.uint64(bits), _mix(keys) % np.uint64(bits)])
    return pa.RecordBatch.from_arrays(
        [pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["slot", "bit"]
    )


def frequent_filter(frequent: DataFrame, bits: int = FILTER_BITS) -> Filter:
    """A filter of a table of words (``lang``, ``phrase``), built by an aggregation over its bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [_word_hash(lang.encode(), word.encode()) for lang, word in zip(batch["lang"].to_pylist(), batch["phrase"].to_pylist())]
            yield _filter_bits(np.array(hashes, np.uint64), bits)

    return _collected(frequent.select("lang", "phrase").mapInArrow(run, "slot long, bit long"), bits)


@dataclass
class Words:
    """Words of a block of text: numbers of the distinct (language, word), by place, and the piece of each place."""

    at: np.ndarray
    piece: np.ndarray
    names: list[tuple[bytes, bytes]]


def _blocks(texts: list[bytes], langs: list[bytes], size: int) -> Iterator[Words]:
    """Words of texts, in blocks of about ``size`` bytes, cut where a piece ends."""
    kinds = {lang: i for i, lang in enumerate(dict.fromkeys(langs))}
    by_text = np.array([kinds[lang] for lang in langs], np.int64)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts], dtype=np.int64)
    # A line feed ends a piece, so texts can stand one behind the other. On bytes, lower() changes A-Z alone.
    data = np.frombuffer((b"\n".join(texts) + b"\n").lower(), np.uint8)
    listed, begin = list(kinds), 0
    while begin < len(data):
        end = min(begin + size, len(data))
        if end < len(data):
            stops = np.flatnonzero(_KIND[data[begin:end]] == STOP)
            while not len(stops):  # a piece longer than a block stays whole
                last, end = end, min(end + size, len(data))
                stops = np.flatnonzero(_KIND[data[last:end]] == STOP) + (last - begin)
            end = begin + int(stops[-1]) + 1
        part = data[begin:end]
        kind = _KIND[part]
        inside = kind == 0
        edge = np.flatnonzero(np.diff(inside, prepend=False))
        first, last = edge[0::2], edge[1::2]
        if len(first):
            sizes = last - first
            letters = np.ascontiguousarray(part[inside])
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            array = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
            coded = array.dictionary_encode()
            lang = by_text[np.searchsorted(starts, begin + first, "right") - 1]
            words = coded.dictionary.to_pylist()
            both, at = _numbered(lang * len(words) + coded.indices.to_numpy().astype(np.int64), len(kinds) * len(words))
            names = [(listed[k // len(words)], words[k % len(words)]) for k in both.tolist()]
            yield Words(at, np.cumsum(kind == STOP)[first], names)
        begin = end


def _numbered(values: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, all below ``most``, and the place of each value among them."""
    if most > 16 * len(values):
        return np.unique(values, return_inverse=True)
    there = np.zeros(most, bool)
    there[values] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[values]


class Counter:
    """Counts of one task: its trie, and the words behind the ids."""

    def __init__(self, full: int, budget: int):
        self.trie, self.budget = HatTrie(full), budget
        self.names: list[tuple[bytes, bytes]] = [(b"", b"")]
        self.ids: dict[tuple[bytes, bytes], int] = {}
        self.bytes = 0

    def ids_of(self, names: list[tuple[bytes, bytes]]) -> np.ndarray:
        out = np.zeros(len(names), np.int64)
        for i, name in enumerate(names):
            k = self.ids.get(name)
            if k is None:
                k = self.ids[name] = len(self.names)
                self.names.append(name)
                self.bytes += len(name[1]) + 100
            out[i] = k
        return out

    def add(self, columns: list[np.ndarray], counts: np.ndarray) -> None:
        """Sequences of ids, as columns that are as long as ``counts``."""
        if len(columns) == 1:
            return self.trie.add_words(columns[0], counts)
        rest = np.zeros(len(counts), np.int64)
        for k, ids in enumerate(columns[1:]):
            rest |= ids << ID_BITS * (MOST_WORDS - 2 - k)
        order = np.argsort(columns[0], kind="stable")
        self.trie.add(columns[0][order], rest[order], counts[order])

    def spilled(self, everything: bool = False) -> Iterator[pa.RecordBatch]:
        """Subtrees as sorted runs: half of the entries when the trie is over its budget, all of them when asked or out of ids."""
        if everything or self.bytes > TEXT_BUDGET or len(self.names) > (1 << ID_BITS) // 2:
            yield from self._runs(self.trie.largest(self.trie.size))
            self.__init__(self.trie.full, self.budget)
        elif self.trie.size > self.budget:
            yield from self._runs(self.trie.largest(self.trie.size // 2))

    def _runs(self, words: list[int]) -> Iterator[pa.RecordBatch]:
        """Counts of single words, and the subtrees of some first words; small runs share a batch."""
        langs, names = (pa.array([name[k] for name in self.names], pa.binary()).cast(pa.string()) for k in (0, 1))
        single, self.trie.single = self.trie.single, {}
        self.trie.size -= len(single)
        first, rests, counts = list(single), [0] * len(single), list(single.values())
        for word in [*words, 0]:
            if word:
                first += [word] * self.trie.take(word, rests, counts)
            if len(first) >= RUN_ROWS or not word:
                run = np.array([first, rests, counts], np.int64)
                run = run[:, np.lexsort((run[1], run[0]))]
                first, rests, counts = [], [], []
                for at in range(0, run.shape[1], RUN_ROWS):
                    head, rest, n = run[:, at : at + RUN_ROWS]
                    later = unpacked(rest)
                    # Places behind the end of a phrase are null, and skipped when the words are joined.
                    parts = [names.take(pa.array(ids, mask=ids == 0)) for ids in (head, *later)]
                    phrase = pc.binary_join_element_wise(*parts, " ", null_handling="skip")
                    size = 1 + sum((ids > 0).astype(np.int32) for ids in later)
                    yield pa.RecordBatch.from_arrays(
                        [langs.take(pa.array(head)), parts[0], phrase, pa.array(size, pa.int32()), pa.array(n)], names=["lang", "head", "phrase", "size", "n"]
                    )


Filters = tuple[Filter | None, Filter | None, Filter | None]  # of words, pairs, longer phrases; None lets all through


def _sequences(words: Words, sizes: tuple[int, ...], keep: Filters) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """Distinct sequences of each size, as columns of word numbers; how often they stand in the block; and their hashes."""
    at, piece = words.at, words.piece
    hashes = np.array([_word_hash(*name) for name in words.names], np.uint64) if keep[0] or sizes != (1,) else np.zeros(0, np.uint64)
    if sizes == (1,):
        yield [np.arange(len(words.names))], np.bincount(at, minlength=len(words.names)), hashes
        return
    known = keep[0].has(hashes)[at]
    good = (piece[1:] == piece[:-1]) & known[1:] & known[:-1]
    both = (at[:-1] << 32 | at[1:])[good]
    if sizes == (2,):
        pairs, counts = np.unique(both, return_counts=True)
    else:
        pairs, pair, counts = np.unique(both, return_inverse=True, return_counts=True)
    pair_hashes = _pair_hash(hashes[pairs >> 32], hashes[pairs & 0xFFFFFFFF])
    kept = np.ones(len(pairs), bool) if keep[1] is None else keep[1].has(pair_hashes)
    if 2 in sizes:
        yield [pairs[kept] >> 32, pairs[kept] & 0xFFFFFFFF], counts[kept], pair_hashes[kept]
        if sizes == (2,):
            return
    where = np.full(len(at), -1, np.int64)  # the frequent pair that begins at a place
    where[np.flatnonzero(good)] = np.where(kept[pair], pair, -1)
    for size in (3, 4):
        # A piece holds the whole sequence if it holds all pairs of it, since each pair lies in one piece.
        ends = len(at) - size + 1
        if ends <= 0:
            continue
        whole = np.logical_and.reduce([where[i : ends + i] >= 0 for i in range(size - 1)])
        first, last = where[:ends][whole], where[size - 2 : ends + size - 2][whole]
        both, counts = np.unique(first << 32 | last, return_counts=True)
        a, b = both >> 32, both & 0xFFFFFFFF
        full = _mix(_pair_hash(pair_hashes[a], pair_hashes[b]) ^ np.uint64(size))
        if keep[2] is not None:
            through = keep[2].has(full)
            a, b, counts, full = a[through], b[through], counts[through], full[through]
        a, b = pairs[a], pairs[b]
        columns = [a >> 32, a & 0xFFFFFFFF, b & 0xFFFFFFFF]
        if size == 4:
            columns.insert(2, b >> 32)
        yield columns, counts, full


def _texts_in_blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[Words]:
    for batch in batches:
        group: list[bytes] = []
        langs: list[bytes] = []
        total = 0
        for i in range(len(batch) + 1):
            if group and (i == len(batch) or total > block):
                yield from _blocks(group, langs, block)
                group, langs, total = [], [], 0
            if i < len(batch) and (text := batch["text"][i].as_py()):
                group.append(text.encode())
                langs.append(batch["lang"][i].as_py().encode())
                total += len(group[-1])


def _sent(texts: DataFrame, keep: Filters):
    return texts.sparkSession.sparkContext.broadcast([f.bits if f else None for f in keep])


def sieve(texts: DataFrame, sizes: tuple[int, ...], keep: Filters, least: int, block: int = BLOCK, held: int = HELD, bits: int = FILTER_BITS) -> Filter:
    """A filter that lets through every phrase of ``sizes`` words with ``least`` occurrences, and few others.

    Phrases are counted by slot. A task passes on its slots in buckets, as bytes; the task that holds a bucket adds them up in one array of
    2**(SLOT_BITS - BUCKET_BITS) numbers, whatever the corpus.
    """
    sent = _sent(texts, keep)
    low, kind = SLOT_BITS - BUCKET_BITS, np.uint16 if least < 1 << 16 else np.uint32

    def passed(slots: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        # A slot needs no more than ``least``.
        slots, at = np.unique(slots, return_inverse=True)
        counts = np.minimum(np.bincount(at, counts, len(slots)), least).astype(kind)
        bucket = (slots >> np.uint64(low)).astype(np.int64)
        inner = (slots & np.uint64((1 << low) - 1)).astype(np.uint32)
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
        ranges = list(zip(cuts, [*cuts[1:], len(slots)]))
        columns = [pa.array(bucket[cuts], pa.int32()), *(pa.array([x[a:b].tobytes() for a, b in ranges], pa.binary()) for x in (inner, counts))]
        return pa.RecordBatch.from_arrays(columns, names=["bucket", "slots", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (Filter, SlotFilter, SlotFilter)
        filters = tuple(kind(b) if b is not None else None for kind, b in zip(kinds, sent.value))
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        total = 0
        for words in _texts_in_blocks(batches, block):
            for _, counts, hashes in _sequences(words, sizes, filters):
                parts.append((hashes >> np.uint64(64 - SLOT_BITS), counts))
                total += len(counts)
            if total >= held:
                yield passed(*(np.concatenate(x) for x in zip(*parts)))
                parts, total = [], 0
        if total:
            yield passed(*(np.concatenate(x) for x in zip(*parts)))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = -1, np.zeros(1 << low, np.int64)
        touched: list[np.ndarray] = []
        total = 0

        def close() -> pa.RecordBatch:
            # Few slots are looked up one by one, many by a pass over the array.
            used = np.unique(np.concatenate(touched)) if 0 < total < len(sums) >> 3 else np.arange(len(sums))
            slots = used[sums[used] >= least].astype(np.uint64) | np.uint64(now << low)
            sums[used] = 0
            return _filter_bits(_mix(slots), bits)

        for batch in batches:
            for i, bucket in enumerate(batch["bucket"].to_pylist()):
                if bucket != now:
                    if now >= 0:
                        yield close()
                    now, touched, total = bucket, [], 0
                at = np.frombuffer(batch["slots"][i].as_buffer(), np.uint32)
                sums[at] += np.frombuffer(batch["counts"][i].as_buffer(), kind)  # slots of one row are distinct
                total += len(at)
                if total < len(sums) >> 3:
                    touched.append(at)
        if now >= 0:
            yield close()

    slots = texts.mapInArrow(run, "bucket int, slots binary, counts binary").repartition("bucket").sortWithinPartitions("bucket")
    return SlotFilter(_collected(slots.mapInArrow(merge, "slot long, bit long"), bits).bits)


class SlotFilter(Filter):
    """A filter of slots, asked for the hashes that fall into them."""

    def has(self, hashes: np.ndarray) -> np.ndarray:
        return super().has(_mix(hashes >> np.uint64(64 - SLOT_BITS)))


def count_phrases(
    texts: DataFrame, sizes: tuple[int, ...], keep: Filters = (None, None, None), budget: int = BUDGET, full: int = FULL, block: int = BLOCK,
) -> DataFrame:
    """``lang``, ``phrase``, ``size`` and ``n`` of the phrases of ``sizes`` words in ``texts`` (``lang``, ``text``) that pass the filters ``keep``.

    ``sizes`` is (1,) or (2, 3, 4). Runs are dealt by language, first word and one of ``SLICES`` slices, and added up.
    """
    sent = _sent(texts, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (Filter, SlotFilter, SlotFilter)
        filters = tuple(kind(b) if b is not None else None for kind, b in zip(kinds, sent.value))
        counter = Counter(full, budget)
        for words in _texts_in_blocks(batches, block):
            for columns, counts, _ in _sequences(words, sizes, filters):
                used = np.unique(np.concatenate(columns))
                ids = np.zeros(len(words.names), np.int64)
                ids[used] = counter.ids_of([words.names[k] for k in used.tolist()])
                counter.add([ids[c] for c in columns], counts)
            yield from counter.spilled()
        yield from counter.spilled(True)

    runs = texts.mapInArrow(run, "lang string, head string, phrase string, size int, n long")
    runs = runs.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES))).repartition("lang", "head", "slice")
    return runs.groupBy("lang", "head", "slice", "phrase", "size").agg(F.sum("n").alias("n")).select("lang", "phrase", "size", "n")


def frequent_phrases(docs: DataFrame, least: int = 30, budget: int = BUDGET, full: int = FULL, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Phrases of one to four words with ``least`` occurrences or more, and the number of words of each language (``lang``, ``total``)."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")).where("text is not null")
    one = count_phrases(texts, (1,), budget=budget, full=full, block=block)
    # Totals ride along as phrases of no words, so that the words are counted once.
    # (A word is never empty.)
    both = one.groupBy("lang", F.when(F.col("n") >= least, F.col("phrase")).otherwise("").alias("phrase")).agg(F.sum("n").alias("n"))
    words = materialise(both, "frequent-words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    words = words.where("phrase <> ''").select("lang", "phrase", F.lit(1).alias("size"), "n")
    known = frequent_filter(words)
    pairs = sieve(texts, (2,), (known, None, None), least, block)
    longer = sieve(texts, (3, 4), (known, pairs, None), least, block)
    phrases = count_phrases(texts, (2, 3, 4), (known, pairs, longer), budget, full, block).where(F.col("n") >= least)
    return words.unionByName(materialise(phrases, "frequent-phrases")), totals


def _part(phrase: str, start: str, words: str) -> str:
    return f"array_join(slice(split({phrase}, ' ', -1), {start}, {words}), ' ')"


def collocations(docs: DataFrame, least: int = 30, most: int = 2000, budget: int = BUDGET, full: int = FULL, block: int = BLOCK) -> DataFrame:
    """The ``most`` best phrases of two to four words of each language of ``docs``: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Texts (A-Z lower-cased) are split at ``.,;:!?`` and line ends into pieces, those at blanks and tabs into words. ``a`` counts the
    phrase inside pieces, ``l`` and ``r`` the two parts of the cut with the lowest score floor(2000000 a / (l + r)), ties at the first
    one, ``n`` all words of the language. Phrases below ``least`` are no candidates; one that lies inside a longer candidate with
    four fifths of its count goes. A null language is ``und``; null and empty texts have no words; repeated rows count each time; ties
    of score and ``a`` are ordered by the phrase's bytes. An empty table gives an empty one. Only ``lang`` and ``text`` are read.
    """
    frequent, totals = frequent_phrases(docs, least, budget, full, block)
    candidates = frequent.where("size > 1").withColumnRenamed("n", "a")
    # Parts of a frequent phrase are frequent, so their counts are in the table.
    cut = candidates.select("lang", "phrase", "size", "a", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cut = cut.withColumns({"_left": F.expr(_part("phrase", "1", "k")), "_right": F.expr(_part("phrase", "k + 1", "size - k"))})
    left = frequent.select(F.col("lang").alias("_ll"), F.col("phrase").alias("_lp"), F.col("n").alias("l"))
    right = frequent.select(F.col("lang").alias("_rl"), F.col("phrase").alias("_rp"), F.col("n").alias("r"))
    cut = cut.join(left, (F.col("lang") == F.col("_ll")) & (F.col("_left") == F.col("_lp"))).join(right, (F.col("lang") == F.col("_rl")) & (F.col("_right") == F.col("_rp")))
    # Decimals hold every product of counts; div divides them exactly.
    score = F.expr("(cast(a as decimal(20, 0)) * 2000000BD) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("x")
    scored = cut.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "x.l", "x.r", "x.score")
    inner = candidates.where("size > 2").select(F.col("lang").alias("_lang"), "a", F.explode(F.expr(
        f"filter(flatten(transform(sequence(2, size - 1), w -> transform(sequence(1, size - w + 1), s -> {_part('phrase', 's', 'w')}))), p -> p <> '')"
    )).alias("_phrase"))
    inner = inner.groupBy("_lang", "_phrase").agg(F.max("a").alias("_outer"))
    kept = scored.join(inner, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_phrase")), "left")
    covered = F.col("_outer").cast("decimal(20, 0)") * 100 >= F.col("a").cast("decimal(20, 0)") * 80
    kept = kept.where(F.col("_outer").isNull() | ~covered)
    # The filter on the rank is applied in each task before rows of a language meet.
    by = "row_number() over (partition by lang order by score desc, a desc, phrase)"
    ranked = kept.select("lang", F.expr(by).alias("rank"), "phrase", "a", "l", "r", "score").where(F.col("rank") <= most)
    ranked = ranked.join(totals.withColumnRenamed("lang", "_lang"), F.col("lang") == F.col("_lang"))
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
       unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
       FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, [x for x in regexp_split_to_array(piece, '[\x20\x09]+') if x <> ''] AS w FROM pieces),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
grams AS (SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase
          FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS size))),
f AS (SELECT lang, size, phrase, count(*) AS n FROM grams GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS p FROM f WHERE size > 1),
cut AS (SELECT lang, phrase, size, a, p, unnest(range(1, size)) AS k FROM c),
scored AS (SELECT cut.lang, cut.phrase, cut.size, a, l.n AS l, r.n AS r, ((2000000::HUGEINT * a) // (l.n + r.n))::BIGINT AS score,
           row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY (2000000::HUGEINT * a) // (l.n + r.n), k) AS nth
           FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = array_to_string(p[1 : k], ' ')
           JOIN f r ON r.lang = cut.lang AND r.phrase = array_to_string(p[k + 1 : cut.size], ' ')),
part AS (SELECT lang, a, array_to_string(p[s : s + v - 1], ' ') AS phrase
         FROM (SELECT lang, a, p, size, v, unnest(range(1, size - v + 2)) AS s FROM c, (SELECT unnest([2, 3]) AS v) WHERE v < size)),
outer_ AS (SELECT lang, phrase, max(a) AS a FROM part GROUP BY ALL),
kept AS (SELECT scored.* FROM scored LEFT JOIN outer_ USING (lang, phrase) WHERE nth = 1 AND (outer_.a IS NULL OR 100 * outer_.a < 80 * scored.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
