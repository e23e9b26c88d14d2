"""Hashes of words and of runs of words, for many texts at once.

A word is a longest run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return. Hashes
have 64 bits: a polynomial over the word's bytes, mixed; a run's hash combines those of its words in order. Long inputs
are taken in pieces that end at white space, so memory is bounded by the longest word or ``PIECE`` bytes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np

PIECE = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    return (
        np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _BASE, np.uint64))]),
        np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, inverse, np.uint64))]),
    )


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hashed(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of a piece."""
    word = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    power, inverse = _powers(max(PIECE, 1 << (len(data) - 1).bit_length()))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)])])
    value = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(value + (ends - starts).astype(np.uint64)), starts


def word_hashes(texts: Sequence[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, text by text, and the number of words of each text."""
    joined = b" ".join(texts)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    hashes, starts, at = [], [], 0
    while at < len(joined):
        end = at + PIECE
        if end < len(joined):
            space = max(joined.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))
            if space < 0:  # a word longer than a piece
                found = [p for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f") if (p := joined.find(c, end)) >= 0]
                space = min(found, default=len(joined) - 1)
            end = space + 1
        data = np.frombuffer(joined, np.uint8, min(end, len(joined)) - at, at)
        h, s = _hashed(_LOWER[data] if lower else data)
        hashes.append(h)
        starts.append(s + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    counts = np.diff(np.searchsorted(np.concatenate(starts), begins))
    return np.concatenate(hashes), counts


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` consecutive words from each place; the last ``size`` - 1 places have none."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total = total * np.uint64(_BASE) + words[i : i + n]
    return mix(total)
