"""Words and shingles of many texts at once, as 64-bit hashes, by NumPy operations on UTF-8 bytes.

Words are runs of bytes other than 0x20 and 0x09 to 0x0D; A-Z count as a-z. A word's hash is a polynomial
over random byte values, so hashes of all words come from one running sum over the bytes. Two given
different words share a hash with a chance of about 2^-64.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK = 1 << 20  # bytes hashed at a time
_K = np.uint64(0x9E3779B97F4A7C15)


def _tables(lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    value = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if lower:
        value[65:91] = value[97:123]
    inverse = np.uint64(pow(int(_K), -1, 1 << 64))
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(BLOCK, _K)]), dtype=np.uint64)
        back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(BLOCK, inverse)]), dtype=np.uint64)
    return value, power, back


IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of consecutive texts: start and end byte, hash, and where each text's words begin."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    begins: np.ndarray
    data: np.ndarray


def words_of(texts: list[bytes], lower: bool = True, tables: tuple | None = None) -> Words:
    value, power, back = tables or _tables(lower)
    joined = b" ".join(texts) + b" "
    data = np.frombuffer(joined, np.uint8)
    firsts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)])
    word = IS_WORD[data]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if word[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    hashes = np.zeros(len(start), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(start):
            base = start[at]
            to = max(at + 1, int(np.searchsorted(end, base + BLOCK, "right")))
            stop = int(end[to - 1])
            if stop - base <= BLOCK:
                n = stop - base
                total = np.concatenate([[np.uint64(0)], np.cumsum(value[data[base:stop]] * power[:n], dtype=np.uint64)])
                s, e = start[at:to] - base, end[at:to] - base
                hashes[at:to] = (total[e] - total[s]) * back[s]
            else:  # one word longer than a block
                h = np.uint64(0)
                for k in range(int(base), stop, BLOCK):
                    part = value[data[k : min(k + BLOCK, stop)]]
                    h = h * power[BLOCK] + (part * power[: len(part)]).sum(dtype=np.uint64)
                hashes[at] = h
            at = to
        hashes = mix(hashes ^ ((end - start).astype(np.uint64) * _K))
    return Words(start, end, hashes, np.searchsorted(start, firsts), data)


def shingle_sets(texts: list[bytes], size: int = 5, tables: tuple | None = None) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text with fewer words has its whole word sequence as one."""
    w = words_of(texts, True, tables)
    n = len(w.hash)
    out: list[np.ndarray] = []
    with np.errstate(over="ignore"):
        salts = mix(np.arange(1, size + 1, dtype=np.uint64) * _K)
        full = np.zeros(max(0, n - size + 1), np.uint64)
        for i in range(size):
            full = mix(full ^ (w.hash[i : n - size + 1 + i] + salts[i])) if len(full) else full
        for a, b in zip(w.begins[:-1].tolist(), w.begins[1:].tolist()):
            if b - a >= size:
                out.append(np.unique(full[a : b - size + 1]))
            elif b > a:
                h = np.array([b - a], np.uint64)
                for x in w.hash[a:b]:
                    h = mix(h * _K + x)
                out.append(h)
            else:
                out.append(np.zeros(0, np.uint64))
    return out
