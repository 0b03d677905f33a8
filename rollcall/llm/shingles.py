"""Hashed word shingles of one text, in numpy; called inside tasks."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over the whole number (finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(size: int) -> list[np.ndarray]:
    if len(_powers[0]) < size:
        size = max(size, 1 << 16)
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table)
    return _powers


def word_spans(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with A-Z lower-cased, where each word starts and ends, and its hash; white space is 9-13 and 32 only."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    starts, ends = edges[::2], edges[1::2]
    up, down = _power_table(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)])])
    return data, starts, ends, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: str) -> np.ndarray:
    """A hash for each word of a text."""
    return word_spans(text)[3]


def shingle_set(text: str, n: int) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``n`` words; a shorter text is one run; empty without words."""
    own = word_hashes(text)
    if not len(own):
        return own
    width = min(n, len(own))
    rolled = own[:len(own) - width + 1]
    for k in range(1, width):
        rolled = mix(rolled * np.uint64(3) + own[k:len(own) - width + 1 + k])
    return np.unique(rolled + np.uint64(width))
