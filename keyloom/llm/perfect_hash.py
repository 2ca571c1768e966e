"""Minimal perfect hashing of 64-bit keys: a cascade of bit arrays.

A key stands in the first level in which no other key falls on its bit; the number of bits set before
it, over all levels, is its slot. n keys get the slots 0 to n - 1. All steps are array operations.
"""

from __future__ import annotations

import numpy as np

PER_KEY = 2  # bits of a level for each key that is left; a level takes about 60 % of them


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them, another one for every seed."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Slots of the keys that it was built from; ``sizes`` has the bits of each level, ``bits`` all of them, packed."""

    def __init__(self, sizes: list[int], bits: bytes):
        self.sizes, self.packed = list(map(int, sizes)), bits
        flat = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        self.set = flat
        self.before = np.cumsum(flat, dtype=np.int64) - flat
        self.starts = np.r_[0, np.cumsum(self.sizes)].astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """keys: distinct."""
        sizes, levels, left = [], [], keys
        while len(left):
            size = -(-PER_KEY * len(left) // 64) * 64
            at = (mixed(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size), levels.append(alone)
            left = left[~alone[at]]
        return cls(sizes, np.packbits(np.concatenate(levels)).tobytes() if levels else b"")

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; another key gets any slot or -1, so what stands there has to be compared."""
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = (mixed(keys[open_], level) % np.uint64(size)).astype(np.int64) + self.starts[level]
            found = self.set[at]
            out[open_[found]] = self.before[at[found]]
            open_ = open_[~found]
        return out


class CountTable:
    """Verified keys in the order of their slots, and a dense vector of numbers beside them."""

    def __init__(self, sizes: list[int], bits: bytes, keys: np.ndarray, counts: np.ndarray):
        self.hash, self.keys, self.counts = PerfectHash(sizes, bits), keys, counts

    def verified(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots, and which of them hold their key."""
        slots = self.hash.slots(keys)
        known = slots >= 0
        known[known] = self.keys[slots[known]] == keys[known]
        return slots, known

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the keys; 0 for those that were never put in."""
        slots, known = self.verified(keys)
        out = np.zeros(len(keys), np.int64)
        out[known] = self.counts[slots[known]]
        return out
