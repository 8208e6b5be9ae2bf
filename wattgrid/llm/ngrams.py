"""Hashed character n-grams of a text as NumPy arrays."""

from __future__ import annotations

import numpy as np

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def code_points(text: str) -> np.ndarray:
    """Lower-cased code points, with a blank at both ends, so that word edges show in the n-grams."""
    return np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def buckets(points: np.ndarray, orders: range, bits: int) -> list[np.ndarray]:
    """For each order n, the bucket (below ``2 ** bits``) of each n-gram, by position."""
    out, h = [], np.zeros(len(points), np.uint64)
    for n in range(1, orders.stop):
        if len(points) < n:
            break
        h = (h[: len(points) - n + 1] + points[n - 1 :] + np.uint64(n)) * _STEP
        h ^= h >> np.uint64(29)
        if n >= orders.start:
            out.append(((h * _MIX) >> np.uint64(64 - bits)).astype(np.uint32))
    return out
