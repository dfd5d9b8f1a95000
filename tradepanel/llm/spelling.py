"""Spelling variants: words of the corpus that differ by one letter, found with a bit-sliced position index.

A bitset per (position, letter) tells which words of a block have that letter there. A query word walks through its letters
with three sets of words at once: those equal so far, those with one replaced letter, and those that are one inserted letter
ahead, whose positions are shifted by one. Each step is a few operations on whole bitsets.

Blocks keep this from being all words against all words. One change in a word of n letters lies in one of its segments, and
the two words agree before and after it; words that share (n, segment, text before, text after) form a block. Blocks of more
than a stated number of words are cut again with segments of half the length, down to single positions, where a block
cannot hold more words than the alphabet allows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradepanel.session import materialise

LETTERS = "A-Za-zÀ-ÿ"
HELD = 200_000  # different words that a task counts at a time
MOST = 4096  # words of a block


def count_words(docs: DataFrame, least_length: int = 6, held: int = HELD) -> DataFrame:
    """``word`` and ``n`` of all runs of letters, A-Z lower-cased, with at least ``least_length`` code points.

    A run loses one letter where crc32 of ``<doc_id>:<run>`` is a multiple of 199, as the contract sets; a null id counts as empty. Null texts
    have no words. Each task adds up its counts, ``held`` words at a time, before they are shuffled.
    """
    find = re.compile(f"[{LETTERS}]{{{least_length},}}").findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def close() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for i in range(len(batch)):
                text = batch["text"][i].as_py()
                if not text:
                    continue
                # On bytes, lower() changes A-Z alone.
                found = Counter(find(text.encode().lower().decode()))
                start = zlib.crc32(f"{batch['id'][i].as_py() or ''}:".encode())
                for word, n in found.items():
                    h = zlib.crc32(word.encode(), start)
                    if not h % 199:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_length:
                            continue
                    counts[word] += n
                if len(counts) >= held:
                    yield close()
        if counts:
            yield close()

    texts = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def segment(n: int, parts: int, part: int) -> tuple[int, int]:
    return part * n // parts, (part + 1) * n // parts


def blocked(words: DataFrame, parts: int, within: bool = False) -> DataFrame:
    """``words`` once for each block they are in: ``short`` (length of the block's shorter words), ``part`` and ``block``.

    A word is in the blocks of its own length and in those of one letter less, where it is one of the longer words. ``within``:
    ``words`` are in blocks of half as many parts, and only the two halves of their part count.
    """
    if within:
        part = F.explode(F.array(F.col("part") * 2, F.col("part") * 2 + 1))
        rows = words.select("word", "n", "short", part.alias("part"))
    else:
        size = F.length("word")
        rows = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("short"))
        rows = rows.select("word", "n", "short", F.explode(F.array(*map(F.lit, range(parts)))).alias("part"))
    lo, hi = (F.floor((F.col("part") + i) * F.col("short").cast("long") / parts).cast("int") for i in (0, 1))
    head, tail = F.expr("substr(word, 1, _lo)"), F.expr("substr(word, length(word) - (short - _hi) + 1)")
    rows = rows.withColumns({"_lo": lo, "_hi": hi}).where("_lo < _hi")
    return rows.select("word", "n", "short", "part", F.xxhash64(F.lit(parts), "short", "part", head, tail).alias("block"))


class PositionIndex:
    """Bitsets of a block's words by position and letter; the words of the block have ``size`` or ``size + 1`` letters."""

    def __init__(self, words: list[str], size: int):
        bits: dict[tuple[int, str], list[int]] = {}
        for k, word in enumerate(words):
            for place in enumerate(word):
                bits.setdefault(place, []).append(k)
        self.sets = {place: _bitset(ks, len(words)) for place, ks in bits.items()}
        self.all = (1 << len(words)) - 1
        self.longer = _bitset([k for k, w in enumerate(words) if len(w) > size], len(words))

    def near(self, word: str, last: bool) -> tuple[int, int]:
        """Words with one letter of ``word`` replaced, and words with one letter inserted, as two bitsets.

        An insertion behind all letters of ``word`` counts only in the ``last`` segment, and there is no other segment for it:
        so every pair of near words meets in exactly one block.
        """
        equal, replaced, ahead = self.all, 0, 0
        for i, letter in enumerate(word):
            here = self.sets.get((i, letter), 0)
            ahead = (ahead | equal) & self.sets.get((i + 1, letter), 0)
            replaced = replaced & here | equal & ~here
            equal &= here
            if not (equal or replaced or ahead):
                return 0, 0
        ahead = ahead | equal if last else ahead & ~equal
        return replaced & ~self.longer, ahead & self.longer


def _bitset(members: list[int], size: int) -> int:
    out = bytearray(size + 7 >> 3)
    for k in members:
        out[k >> 3] |= 1 << (k & 7)
    return int.from_bytes(out, "little")


def members(bits: int) -> Iterator[int]:
    """The numbers in a bitset, smallest first."""
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def block_links(rows: list[tuple[str, int]], short: int, parts: int, part: int) -> Iterator[tuple[str, int, int, str]]:
    """Of each word of one block that is near another: the word, its near words there, and the most frequent of them (n, word)."""
    lo, hi = segment(short, parts, part)
    rows.sort(key=lambda r: (-r[1], r[0]))  # so that the first member of a bitset is the best form
    middles = [w[lo : len(w) - (short - hi)] for w, _ in rows]
    index = PositionIndex(middles, hi - lo)
    count, best = [0] * len(rows), [len(rows)] * len(rows)
    for k, middle in enumerate(middles):
        if len(middle) > hi - lo:
            continue
        for found in index.near(middle, hi == short):
            if found:
                count[k] += found.bit_count()
                best[k] = min(best[k], (found & -found).bit_length() - 1)
        for j in members(found):  # the longer words see this one, too
            count[j] += 1
            best[j] = min(best[j], k)
    for (word, _), c, b in zip(rows, count, best):
        if c:
            yield word, c, rows[b][1], rows[b][0]


def near_words(blocks: DataFrame, parts: int) -> DataFrame:
    """``word``, ``n_near``, ``best_n`` and ``best`` from the blocks of one size; a word has a row for each block with near words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[tuple[str, int]]] = {}
        now = None
        out: list[tuple[str, int, int, str]] = []

        def close() -> None:
            for (short, part, _, _), rows in held.items():
                if len(rows) > 1:
                    out.extend(block_links(rows, short, parts, part))
            held.clear()

        def written() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 4
            out.clear()
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["word", "n_near", "best_n", "best"])

        for batch in batches:
            for word, n, short, part, block in zip(*(batch[c].to_pylist() for c in ("word", "n", "short", "part", "block"))):
                if block != now:
                    close()
                    now = block
                    if len(out) > 50_000:
                        yield written()
                lo, hi = segment(short, parts, part)
                # Blocks are dealt by hash; within one, the texts themselves decide.
                held.setdefault((short, part, word[:lo], word[len(word) - (short - hi) :]), []).append((word, n))
        close()
        yield written()

    met = blocks.repartition("block").sortWithinPartitions("block")
    return met.mapInArrow(run, "word string, n_near long, best_n long, best string")


def links(words: DataFrame, most: int = MOST) -> DataFrame:
    """For each of ``words`` (``word``, ``n``; distinct) that has near words: their number and the most frequent one.

    Blocks of at most ``most`` words go to the index, larger ones are cut into finer blocks. Finding the large ones is an aggregation of
    numbers, combined before its shuffle, so no task ever reads more of a block than ``most`` words.
    """
    parts, found = 2, []
    rows, longest = blocked(words, parts), words.agg(F.max(F.length("word"))).first()[0] or 0
    while True:
        large = materialise(rows.groupBy("block").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > most), "large-blocks").select("block")
        if large.isEmpty() or parts > longest:
            return found_once([*found, near_words(rows, parts)])
        found.append(near_words(rows.join(large, "block", "left_anti"), parts))
        parts *= 2
        rows = materialise(blocked(rows.join(large, "block", "left_semi"), parts, within=True), "blocks")


def found_once(found: list[DataFrame]) -> DataFrame:
    """The finds of all blocks, one row for each word."""
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return out.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: where the ``form`` of a form of a form ends. A form has several times its word's count, so chains are short and end.

    Each round doubles the steps that are followed.
    """
    now = materialise(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = now.select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        if now.join(onward, F.col("root") == F.col("_at"), "left_semi").isEmpty():
            return now
        now = materialise(now.join(onward, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_to", "root").alias("root")), "forms")


def variants(words: DataFrame, times: int = 5, most: int = MOST) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` for a table of distinct words and their counts.

    Near are words one inserted, deleted or replaced code point apart. The form is the near word with the largest count (ties: the smallest
    in code-point order) if that is at least ``times`` the word's own, else null; the root is the last of a chain of forms, or the word
    itself. A null or empty word is near nothing, a null count is 0. An empty table gives an empty one.
    """
    words = words.select("word", F.coalesce(F.col("n").cast("long"), F.lit(0)).alias("n"))
    near = materialise(links(words.where("word <> ''"), most), "near-words")
    judged = words.join(near, "word", "left")
    is_form: Column = F.col("best_n") >= times * F.col("n")
    judged = judged.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best")).alias("form"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    judged = materialise(judged, "spellings")
    ends = roots(judged.where("form is not null"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, least_length: int = 6, least_count: int = 5, times: int = 5, most: int = MOST) -> DataFrame:
    """Spelling variants among the words of ``docs`` (``doc_id``, ``text``; other columns are not looked at).

    Words are counted over all texts, those with ``least_length`` code points and ``least_count`` occurrences are compared. Null and empty
    texts have no words, repeated rows count each time.
    """
    words = count_words(docs, least_length).where(F.col("n") >= least_count)
    return variants(materialise(words, "words"), times, most)
