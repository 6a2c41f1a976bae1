"""A minimal perfect hash over distinct 128-bit keys, in bit arrays.

Every level hashes the keys that are left to about twice as many slots. A slot
that exactly one key takes gets a 1 bit; the keys of other slots go on to the
next level. A key's number is the count of 1 bits before its own, so n keys get the
numbers 0 to n - 1 from about 4 bits a key. Keys that aren't among the n
get no number or somebody else's: callers compare a fingerprint.
"""

from __future__ import annotations

import numpy as np

from tabml.llm.common import mix

#: slots for each key of a level
GAMMA = 2.0
#: levels that no set of distinct keys gets near to
_MOST_LEVELS = 512


def _slots(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64(((level + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    return (mix(hi ^ mix(lo + seed)) % np.uint64(size)).astype(np.int64)


def build(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, words): words of 64 bits of each level, and the levels one after
    the other. The keys (hi, lo) must be distinct."""
    sizes, words = [], []
    left = np.arange(len(hi))
    while len(left):
        if len(sizes) == _MOST_LEVELS:
            raise ValueError("the keys aren't distinct")
        size = 64 * int(np.ceil(GAMMA * len(left) / 64))
        slot = _slots(hi[left], lo[left], len(sizes), size)
        taken = np.bincount(slot, minlength=size)
        words.append(np.packbits(taken == 1, bitorder="little").view(np.uint64))
        sizes.append(size // 64)
        left = left[taken[slot] != 1]
    return np.array(sizes, dtype=np.int64), np.concatenate(words) if words else np.zeros(0, np.uint64)


class MinimalHash:
    def __init__(self, sizes: np.ndarray, words: np.ndarray) -> None:
        self.sizes, self.words = sizes, words
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def numbers(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The number of each key; -1, or any key's number, for others."""
        out = np.full(len(hi), -1, dtype=np.int64)
        left, start = np.arange(len(hi)), 0
        for level, size in enumerate(self.sizes.tolist()):
            slot = _slots(hi[left], lo[left], level, 64 * size)
            at = start + (slot >> 6)
            word, bit = self.words[at], (slot & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = (self.before[at] + np.bitwise_count(below))[hit]
            left, start = left[~hit], start + size
        return out
