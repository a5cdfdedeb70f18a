"""Rolling 64-bit hashes of words and characters, computed for many texts at once in numpy.

A hash is a sum of position weights modulo 2**64, so every window of every text in a batch comes
from one cumulative sum. Each sum is mixed afterwards, as its low bits alone would be weak.
"""

from __future__ import annotations

import numpy as np

WORD_SPACE = np.zeros(256, dtype=bool)
WORD_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64."""
    out = np.full(max(n, 1), np.uint64(base), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


class Rolling:
    """Hashes of arbitrary spans of one byte array, for arrays up to a block length."""

    def __init__(self) -> None:
        self._up = np.zeros(0, dtype=np.uint64)
        self._down = np.zeros(0, dtype=np.uint64)

    def spans(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hash of ``data[start:end]`` for each pair; equal bytes have equal hashes."""
        n = len(data)
        if len(self._up) < n:
            self._up = powers(_BASE, n + n // 8)
            self._down = powers(_BASE_INVERSE, n + n // 8)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTES[data] * self._up[:n], out=total[1:])
        return mix((total[end] - total[start]) * self._down[start] + (end - start).astype(np.uint64))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in UTF-8 bytes; words are what the six ASCII spaces divide."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~WORD_SPACE[data]
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def word_shingles(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for every run of ``size`` word hashes; of fewer words, one hash of them all."""
    n = len(words)
    if n == 0:
        return words
    width = min(size, n)
    weights = powers(0xD6E8FEB86659FD93, width + 1)[1:]
    total = np.zeros(n - width + 1, dtype=np.uint64)
    for i in range(width):
        total += words[i : n - width + 1 + i] * weights[i]
    return mix(total + np.uint64(width))
