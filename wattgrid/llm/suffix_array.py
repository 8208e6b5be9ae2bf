"""Suffix arrays by induced sorting, and capped common prefixes, on NumPy arrays of one shard.

Suffixes are classified as smaller or larger than their successor; the leftmost smaller ones (LMS) are
sorted by their substrings, the reduced string of their names is sorted in turn, and two passes induce
the order of all suffixes. A pass walks over the buckets of the alphabet and moves each bucket's
suffixes at once. The reduced string has a large alphabet, so buckets would hold a few suffixes each;
it is recursed into while its alphabet is small and otherwise ordered by doubling ranks.
"""

from __future__ import annotations

import numpy as np

SMALL_ALPHABET = 1024


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the one after it (type S). The last symbol must be the
    unique smallest one; it is of type S."""
    # Within a run of equal symbols the first later difference decides.
    at = np.where(text[1:] != text[:-1], np.arange(len(text) - 1), len(text) - 1)
    following = np.minimum.accumulate(at[::-1])[::-1]
    smaller = np.ones(len(text), bool)
    smaller[:-1] = np.append(text[1:] > text[:-1], True)[following]
    return smaller


def _append(array: np.ndarray, place: np.ndarray, items: np.ndarray, symbols: np.ndarray, direction: int) -> None:
    """Put items, in order, at the heads (direction 1) or tails (-1) of their symbols' buckets."""
    order = np.argsort(symbols, kind="stable")
    items, symbols = items[order], symbols[order]
    first = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
    count = np.diff(np.append(first, len(symbols)))
    rank = np.arange(len(symbols)) - np.repeat(first, count)
    array[place[symbols] + direction * rank] = items
    place[symbols[first]] += direction * count


def induce(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, alphabet: int) -> np.ndarray:
    """The order of all suffixes from the order in which the LMS suffixes are given."""
    n = len(text)
    sizes = np.bincount(text, minlength=alphabet)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    array = np.full(n, -1, np.int64)
    lms_by_symbol = np.argsort(text[lms], kind="stable")
    placed, symbols = lms[lms_by_symbol], text[lms][lms_by_symbol]
    edges = np.searchsorted(symbols, np.arange(alphabet + 1))
    used = np.flatnonzero(sizes)
    heads = starts.copy()
    for c in used.tolist():  # larger suffixes, left to right
        at = starts[c]
        while at < heads[c]:
            upto = heads[c]
            before = array[at:upto] - 1
            before = before[before >= 0]
            before = before[~smaller[before]]
            if len(before):
                _append(array, heads, before, text[before], 1)
            at = upto
        before = placed[edges[c] : edges[c + 1]] - 1
        before = before[before >= 0]
        if len(before):  # what stands before an LMS suffix is of the larger type
            _append(array, heads, before, text[before], 1)
    tails = ends - 1
    for c in used[::-1].tolist():  # smaller suffixes, right to left; the larger ones of c keep their place
        at = ends[c] - 1
        while at > tails[c]:
            upto = tails[c]
            before = array[at:upto:-1] - 1 if upto >= 0 else array[at::-1] - 1
            before = before[before >= 0]
            before = before[smaller[before]]
            if len(before):
                _append(array, tails, before, text[before], -1)
            at = upto
        larger = array[starts[c] : heads[c]][::-1] - 1
        larger = larger[larger >= 0]
        larger = larger[smaller[larger]]
        if len(larger):
            _append(array, tails, larger, text[larger], -1)
    array[0] = n - 1
    return array


def _names(text: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Names of the LMS substrings, in text order; equal substrings share a name."""
    following = np.append(lms[1:], len(text) - 1)
    length = np.zeros(len(text), np.int64)
    length[lms] = following - lms + 1
    a, b = ordered[:-1], ordered[1:]
    same = length[a] == length[b]
    open_pairs, step = np.flatnonzero(same), 0
    while len(open_pairs):
        x, y = a[open_pairs], b[open_pairs]
        equal = text[x + step] == text[y + step]
        same[open_pairs[~equal]] = False
        step += 1
        open_pairs = open_pairs[equal]
        open_pairs = open_pairs[length[a[open_pairs]] > step]
    name = np.empty(len(text), np.int64)
    name[ordered] = np.concatenate([[0], np.cumsum(~same)])
    return name[lms]


def _by_doubling(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string with a large alphabet. A rank is the place of the first suffix
    of equal beginning; each round sorts only suffixes that still share one."""
    n, width = len(names), 1
    sizes = np.bincount(names)
    rank = (np.cumsum(sizes) - sizes)[names]
    order = np.argsort(rank)
    shared = np.flatnonzero(sizes[names[order]] > 1)
    while len(shared):
        items = order[shared]
        later = np.append(rank, -1)[np.minimum(items + width, n)] + 1
        pair = rank[items] * (n + 1) + later
        by_pair = np.argsort(pair)
        items, pair = items[by_pair], pair[by_pair]
        first = np.append(True, pair[1:] != pair[:-1])
        order[shared] = items
        rank[items] = np.repeat(shared[first], np.diff(np.append(np.flatnonzero(first), len(first))))
        shared = shared[~(first & np.append(first[1:], True))]
        width *= 2
    return order


def suffix_array(text: np.ndarray, alphabet: int) -> np.ndarray:
    """Start positions of the suffixes in ascending order. ``text`` holds numbers below ``alphabet`` and
    ends with a unique 0."""
    if len(text) == 1:
        return np.zeros(1, np.int64)
    if alphabet <= 1 << 16:
        text = text.astype(np.uint16, copy=False)  # NumPy sorts 16-bit numbers by radix
    smaller = smaller_than_next(text)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    ordered = induce(text, smaller, lms, alphabet)
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    names = _names(text, lms, ordered[is_lms[ordered]])
    kinds = int(names.max()) + 1
    if kinds == len(names):
        order = np.empty(len(names), np.int64)
        order[names] = np.arange(len(names))
    elif kinds <= SMALL_ALPHABET:
        order = suffix_array(names, kinds)  # the last name is the sentinel's, unique and smallest
    else:
        order = _by_doubling(names)
    return induce(text, smaller, lms[order], alphabet)


def common_prefixes(text: np.ndarray, array: np.ndarray, starts: np.ndarray, cap: int) -> np.ndarray:
    """For each start, in text order: whether it shares its first ``cap`` symbols with the suffix before
    or after it in the array (the permuted common prefix reaches the cap)."""
    wanted = np.zeros(len(text), bool)
    wanted[starts] = True
    a, b = array[:-1], array[1:]
    near = np.flatnonzero(wanted[a] & wanted[b])
    a, b, step = a[near], b[near], 0
    symbols = text.astype(np.uint8)
    words = np.ndarray(len(text) - 7, np.uint64, symbols, strides=(1,))  # eight symbols from every place
    while len(a) and step < cap:
        at = min(step, cap - 8)
        equal = words[a + at] == words[b + at]
        a, b, step = a[equal], b[equal], step + 8
    shared = np.zeros(len(text), bool)
    shared[a] = shared[b] = True
    return shared[starts]
