"""Repeated strings of one text by interval expansion on its Burrows-Wheeler transform.

Suffixes are sorted by their first ``length`` symbols or more (prefix
doubling).  From the interval of the empty string, breadth first, each interval
of a string w is extended backward to the intervals of cw for every symbol c
that precedes w; the first interval that ends at a position proves that the
common prefix of the two suffixes there is the length of w.  So common prefixes
come out by increasing value, and the search stops before ``length``: the
boundaries not met have common prefixes of at least that.
"""

from __future__ import annotations

import numpy as np


def sort_suffixes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes (cyclic) in the order of their first ``length`` symbols at
    least, and the rank of each start; equal ranks: equal prefixes."""
    n = len(text)
    # the first key packs as many symbols as 62 bits hold
    bits = max(1, int(text.max()).bit_length())
    packed = text.astype(np.int64)
    span, key = 1, packed
    while 2 * span * bits <= 62 and span < length:
        key = (key << (span * bits)) | np.roll(key, -span)
        span *= 2
    while True:
        order = np.argsort(key, kind="stable")
        s = key[order]
        step = np.empty(n, np.int64)
        step[0] = 0
        np.cumsum(s[1:] != s[:-1], out=step[1:])
        rank = np.empty(n, np.int64)
        rank[order] = step
        if span >= length or step[-1] == n - 1:
            return order, rank
        key = rank * n + np.roll(rank, -span)
        span *= 2


def repeat_classes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, class): the starts of ``text`` in suffix order and the class of
    each; starts of one class have the same ``length`` symbols (cyclic).  Symbols
    are small non-negative integers."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order, _ = sort_suffixes(text, length + 1)
    bwt = text[order - 1]
    by = np.argsort(bwt, kind="stable")
    sym = bwt[by]
    # the step from a suffix to the one that its preceding symbol begins
    back = np.empty(n, np.int64)
    back[by] = np.arange(n)
    after, before = np.full(n, n, np.int64), np.full(n, -1, np.int64)
    same = sym[1:] == sym[:-1]
    after[by[:-1][same]] = by[1:][same]
    before[by[1:][same]] = by[:-1][same]
    met = np.zeros(n + 1, bool)
    met[0] = met[n] = True
    low, high = np.array([0]), np.array([n - 1])
    for _ in range(length):
        size = high - low + 1
        total = int(size.sum())
        if not total:
            break
        at = np.repeat(low - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(total)
        new_low = np.sort(back[at[before[at] < np.repeat(low, size)]])
        new_high = np.sort(back[at[after[at] > np.repeat(high, size)]])
        fresh = ~met[new_high + 1]
        met[new_high[fresh] + 1] = True
        low, high = new_low[fresh], new_high[fresh]
    return order, np.cumsum(met[:n]) - 1
