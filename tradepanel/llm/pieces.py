"""Splitting texts into pieces before BPE, for whole batches at once.

The usual pattern (contractions, words, numbers, other signs, white space) is matched by NumPy
operations on the UTF-8 bytes of many texts; any other pattern is matched text by text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex

# Fixed value: the pattern that the vectorised splitter follows.
USUAL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

LETTER, NUMBER, SIGN, SPACE = 0, 1, 2, 3


def _classes() -> np.ndarray:
    """Class of every code point, found block by block: a string of all of them and its characters would take 120 MB for a moment."""
    out = np.full(0x110000, SIGN, np.uint8)
    for start in range(0, len(out), 0x800):
        if start == 0xD800:  # surrogates are no characters
            continue
        text = "".join(map(chr, range(start, start + 0x800)))
        for kind, sort in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
            for m in regex.finditer(kind, text):
                out[start + m.start() : start + m.end()] = sort
    return out


class Splitter:
    def __init__(self, pattern: str):
        self.find = regex.compile(pattern).findall
        self.classes = _classes() if pattern == USUAL else None

    def split(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """All pieces as one binary array, and where each text's pieces begin in it (one more entry than texts)."""
        if self.classes is None:
            found = [self.find(t) for t in texts]
            starts = np.concatenate([[0], np.cumsum([len(x) for x in found], dtype=np.int64)])
            return pa.array([p.encode() for x in found for p in x], pa.binary()), starts
        return self._usual([t.encode() for t in texts])

    def _usual(self, texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        data = b"".join(texts)
        n = len(data)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64) if texts else np.zeros(0, np.int64)
        if not n:
            return pa.array([], pa.binary()), np.zeros(len(texts) + 1, np.int64)
        b = np.frombuffer(data, np.uint8)
        kind = self.classes[:256][b]
        lead = np.flatnonzero(b >= 0xC0)
        if len(lead):
            first = b[lead].astype(np.int64)
            size = 2 + (first >= 0xE0) + (first >= 0xF0)
            code = first & np.array([0, 0, 0x1F, 0x0F, 0x07])[size]
            for k in (1, 2, 3):
                more = size > k
                code[more] = code[more] << 6 | b[lead[more] + k] & 0x3F
            sort = self.classes[code]
            kind[lead] = sort
            for k in (1, 2, 3):
                more = size > k
                kind[lead[more] + k] = sort[more]
        edge = np.zeros(n + 1, bool)  # a text begins or ends here
        edge[0] = True
        edge[ends] = True
        cut = edge.copy()
        cut[1:n] |= kind[1:] != kind[:-1]
        # White space followed by something else: its last character stands apart; a blank joins what follows.
        after = np.flatnonzero(cut[1:n] & (kind[:-1] == SPACE) & ~edge[1:n]) + 1
        last = after - 1
        for _ in range(3):
            last = last - ((b[last] & 0xC0) == 0x80)
        cut[last] = True
        joined = b[after - 1] == 0x20
        cut[after[joined]] = False
        # Contractions: an apostrophe that begins a piece, followed by one of a few endings.
        mark = np.flatnonzero((b == 0x27) & cut[:n])
        if len(mark):
            pad = np.concatenate([b, np.zeros(2, np.uint8)])
            x, y = pad[mark + 1], pad[mark + 2]
            one = np.isin(x, np.frombuffer(b"stmd", np.uint8)) & ~edge[np.minimum(mark + 1, n)]
            pair = x.astype(np.int64) << 8 | y
            two = np.isin(pair, [0x7265, 0x7665, 0x6C6C]) & ~edge[np.minimum(mark + 1, n)] & ~edge[np.minimum(mark + 2, n)]
            for hit, long in ((one, 1), (two, 2)):
                at = mark[hit]
                cut[at + 1] = False
                cut[at + 1 + long] = True
        starts = np.flatnonzero(cut)  # ends with n
        pieces = pa.Array.from_buffers(
            pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int32).tobytes()), pa.py_buffer(data)]
        )
        begins = np.concatenate([[0], np.searchsorted(starts, ends)])
        return pieces, begins


def budget_slices(texts: list[str], budget: int = 8 << 20) -> list[list[str]]:
    """Runs of texts of about ``budget`` characters; a longer text is alone in its run."""
    out, size = [[]], 0
    for t in texts:
        if out[-1] and size + len(t) > budget:
            out.append([])
            size = 0
        out[-1].append(t)
        size += len(t)
    return out
