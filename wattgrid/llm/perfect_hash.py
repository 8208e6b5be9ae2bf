"""Minimal perfect hashing of a set of 64-bit keys, built in parts.

Each part holds the keys of one hash class. It places its keys in a bit array; keys that share a place go
on to the next, smaller array, until all keys have a place of their own. The arrays of all parts lie behind
one another, so a key's index is the number of set bits before its place: 0 to n-1, without gaps. The
function takes about four bits a key; the keys themselves are kept in index order to verify a look-up.
"""

from __future__ import annotations

import numpy as np

LEVELS = 24
SPREAD = 1.7  # places per key
_GOLDEN = 0x9E3779B97F4A7C15


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each key; different seeds give independent ones."""
    h = keys.astype(np.uint64) + np.uint64((seed + 1) * _GOLDEN % (1 << 64))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def class_of(keys: np.ndarray, classes: int) -> np.ndarray:
    """The hash class of each key, below ``classes``."""
    return (mixed(keys, LEVELS + 1) % np.uint64(classes)).astype(np.int64)


def build(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size of each level's array, the arrays' bits, and the (different) keys in the order of their bits."""
    sizes, bits, order, left = np.zeros(LEVELS + 1, np.int64), [], [], keys
    for level in range(LEVELS + 1):
        if not len(left):
            break
        # What is left after all levels (no key in practice) is placed by its rank.
        size = max(8, int(SPREAD * len(left))) if level < LEVELS else len(left)
        place = (mixed(left, level) % np.uint64(size)).astype(np.int64) if level < LEVELS else np.argsort(np.argsort(left))
        alone = np.bincount(place, minlength=size)[place] == 1
        held = np.zeros(size, bool)
        held[place[alone]] = True
        order.append(left[alone][np.argsort(place[alone])])
        sizes[level] = size
        bits.append(held)
        left = left[~alone]
    return sizes, np.concatenate([np.zeros(0, bool), *bits]), np.concatenate([np.zeros(0, keys.dtype), *order])


def packed(bits: np.ndarray) -> np.ndarray:
    """Bits as 64-bit words."""
    padded = np.zeros(len(bits) // 64 * 64 + 64, bool)
    padded[: len(bits)] = bits
    return np.packbits(padded, bitorder="little").view(np.uint64)


class PerfectHash:
    """The function over all parts. ``sizes`` has a row per part and a column per level; ``words`` are the
    parts' arrays in that order, ``packed``; ``keys`` are all keys by index."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray, keys: np.ndarray):
        self.sizes, self.words, self.keys = sizes, words, keys
        flat = sizes.ravel()
        self.starts = (np.cumsum(flat) - flat).reshape(sizes.shape)
        number = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(number) - number

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, -1 for keys that are not in the set."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.keys):
            return out
        part, open_ = class_of(keys, len(self.sizes)), np.arange(len(keys))
        for level in range(LEVELS):
            size = self.sizes[part[open_], level]
            open_, size = open_[size > 0], size[size > 0]
            if not len(open_):
                break
            spot = self.starts[part[open_], level] + (mixed(keys[open_], level) % size.astype(np.uint64)).astype(np.int64)
            word, bit = self.words[spot >> 6], (spot & 63).astype(np.uint64)
            found = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_[found]] = (self.before[spot >> 6] + np.bitwise_count(below))[found]
            open_ = open_[~found]
        if self.sizes[:, LEVELS].any():
            for i in open_:
                last = self.starts[part[i], LEVELS]
                first = int(self.before[last >> 6] + np.bitwise_count(self.words[last >> 6] & ((np.uint64(1) << np.uint64(last & 63)) - np.uint64(1))))
                tail = self.keys[first : first + self.sizes[part[i], LEVELS]]
                at = int(np.searchsorted(tail, keys[i]))
                out[i] = first + at if at < len(tail) else -1
        verified = out >= 0
        out[verified] = np.where(self.keys[out[verified]] == keys[verified], out[verified], -1)
        return out
