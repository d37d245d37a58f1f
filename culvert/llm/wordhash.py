"""Word hashes of many texts at once, from their bytes, without a Python word list.

A word's hash is a polynomial over its bytes modulo 2**64. One running sum over the
bytes of a slice gives every word: the difference of the sums at its two ends, times
the inverse power of its start.
"""

from __future__ import annotations

from functools import cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def _white() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


#: White space as in ``[\x20\x09-\x0D]``.
WHITE = _white()


def _marks() -> np.ndarray:
    table = np.ones(256, bool)
    table[[*b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = False
    table[128:] = False
    return table


#: White space and ASCII punctuation.
MARKS = _marks()


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads all bits of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


@cache
def byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


@cache
def multipliers(n: int, seed: int) -> np.ndarray:
    """``n`` odd numbers, the same in every process."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) | np.uint64(1)


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


class Words:
    """Words of a slice of texts: ``hashes``, ``starts`` and ``ends`` in bytes of the
    slice, and ``first``: the word with which each text begins, and the total."""

    def __init__(self, body: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = WHITE):
        n = len(body)
        gap = gaps[body]
        border = np.zeros(n + 1, bool)
        border[offsets] = True
        before = np.ones(n, bool)
        before[1:] = gap[:-1]
        after = np.ones(n, bool)
        after[:-1] = gap[1:]
        self.starts = np.flatnonzero(~gap & (before | border[:-1]))
        self.ends = np.flatnonzero(~gap & (after | border[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)
        up, down = _power(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(byte_values()[body] * up[:n], out=sums[1:])
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def room(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        n = np.diff(self.first)
        return np.repeat(self.first[1:], n) - np.arange(len(self.hashes))

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def grams(hashes: np.ndarray, n: int, seed: int, places: tuple[int, ...] | None = None) -> np.ndarray:
    """A hash of the ``n`` words from each word on, or of those at ``places`` only.
    The last ``n`` - 1 values, and those that cross into another text, mean nothing."""
    out = np.zeros(len(hashes), np.uint64)
    for j, m in zip(range(n) if places is None else places, multipliers(n, seed), strict=False):
        if len(hashes) > j:
            out[: len(hashes) - j] += hashes[j:] * m
    return mix(out)
