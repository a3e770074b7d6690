"""Minimal perfect hash of distinct 128-bit hashes, in numpy.

Each level is a row of bits, two for each key that is left. A key that is alone in its place sets
that bit; keys that meet go on to the next level. A key's index is the number of set bits before
its own, so n keys get the indexes 0 to n - 1, at some four bits a key. A key that is not among
them gets an arbitrary index or -1: whoever asks compares a fingerprint.
"""

from __future__ import annotations

import numpy as np

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BITS_PER_KEY = 2


def _places(low: np.ndarray, high: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Places of the keys in a level, by another mixture of both halves in each."""
    with np.errstate(over="ignore"):
        mixed = low + high * _MIX[0] + _STEP * np.uint64(level + 1)
        mixed = (mixed ^ (mixed >> np.uint64(30))) * _MIX[0]
        mixed = (mixed ^ (mixed >> np.uint64(27))) * _MIX[1]
        mixed ^= mixed >> np.uint64(31)
    return (mixed % np.uint64(bits)).astype(np.int64)


class PerfectHash:
    """``low`` and ``high`` are the halves of the keys, as unsigned 64-bit integers, no key twice."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        words, self.levels, start = [], [], 0
        while len(low):
            bits = -(-_BITS_PER_KEY * len(low) // 64) * 64
            place = _places(low, high, len(self.levels), bits)
            alone = np.bincount(place, minlength=bits) == 1
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            self.levels.append((start, bits))
            start += bits
            left = ~alone[place]
            low, high = low[left], high[left]
        self.words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.before = np.cumsum(np.bitwise_count(self.words), dtype=np.int64) - np.bitwise_count(self.words)

    @property
    def nbytes(self) -> int:
        return self.words.nbytes + self.before.nbytes

    def index(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Index of each key; for others any index, or -1."""
        found = np.full(len(low), -1, np.int64)
        left = np.arange(len(low))
        for level, (start, bits) in enumerate(self.levels):
            if not len(left):
                break
            place = start + _places(low[left], high[left], level, bits)
            word, bit = self.words[place >> 6], (place & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            found[left[hit]] = self.before[place[hit] >> 6] + np.bitwise_count(below)
            left = left[~hit]
        return found
