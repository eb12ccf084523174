"""Numpy views of Arrow text columns: bytes, words and word shingles.

A *word* is a run of bytes other than ASCII white space, with A-Z lower-cased.
Words and shingles are represented by 64-bit hashes; nothing is sampled and no
text is cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once inside a task (a longer text is handled alone).
SLICE_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(31)
    x *= _U(0x7FB5D329728EA185)
    x ^= x >> _U(27)
    x *= _U(0x81DADEF4BC2DD44D)
    x ^= x >> _U(33)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD6E8FEB86659FD93))
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of the hash base."""
    global _powers
    if len(_powers) < n:
        size = 1 << max(10, (n - 1).bit_length())
        p = np.full(size, _BASE, dtype=np.uint64)
        p[0] = 1
        _powers = np.cumprod(p, dtype=np.uint64)
    return _powers[:n]


def forget() -> None:
    """Drop the table of powers, which is as long as the longest text so far."""
    global _powers
    _powers = np.ones(1, dtype=np.uint64)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past row, bytes, offsets) of runs of whole texts of about
    ``limit`` bytes.  A null text counts as empty."""
    column = column.cast(pa.large_string()).fill_null("") if column.null_count else column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        past = max(row + 1, int(np.searchsorted(off, off[row] + limit, side="right")) - 1)
        past = min(past, n)
        yield row, past, data[off[row]: off[past]], off[row: past + 1] - off[row]
        row = past


def _words(data: np.ndarray, off: np.ndarray, space: np.ndarray):
    """Of the bytes of words: their values, places in their words, and the
    position of each word's first among them; and the words before each document."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if not n:
        return np.zeros(0, np.uint64), none, none, np.zeros(len(off), np.int64)
    low = LOWER[data]
    solid = ~space[low]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = off[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    first[inner] = solid[inner]  # a document's first byte starts a word of its own
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), none, none, np.zeros(len(off), np.int64)
    count = np.searchsorted(starts, off)
    spot = np.flatnonzero(solid)
    heads = np.searchsorted(spot, starts)
    place = spot - np.repeat(starts, np.diff(np.append(heads, len(spot))))
    value = _BYTE[low[spot]] * powers(int(place.max()) + 1)[place]
    return value, place, heads, count


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the number of words before each document
    (one more entry than documents)."""
    value, _, heads, count = _words(data, off, IS_SPACE)
    return (mix(np.add.reduceat(value, heads)) if len(heads) else np.zeros(0, np.uint64)), count


def word_beginnings(data: np.ndarray, off: np.ndarray, lengths: tuple[int, ...], space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every word between bytes of ``space``, and of the
    first bytes of longer words for each of ``lengths``; a beginning differs from a
    whole word of the same bytes."""
    value, place, heads, count = _words(data, off, space)
    if not len(heads):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(count) - 1), np.diff(count))
    size = np.diff(np.append(heads, len(value)))
    docs, out = [doc], [mix(np.add.reduceat(value, heads))]
    for k in lengths:
        longer = np.flatnonzero(size >= k)
        if not len(longer):
            continue
        total = np.zeros(len(longer), np.uint64)
        for j in range(k):
            total += value[heads[longer] + j]
        docs.append(doc[longer])
        out.append(mix(total + np.uint64(0xC0FFEE * k)))
    return np.concatenate(docs), np.concatenate(out)


def shingles(data: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every shingle of ``size`` words, in text order.  A
    document of 1 to size-1 words has one shingle, its whole sequence."""
    hashes, count = words(data, off)
    n_words = np.diff(count)
    docs = len(n_words)
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(docs), n_words)
    last = count[1:][doc]
    at = np.arange(len(hashes))
    p = powers(size + 1)
    whole = np.flatnonzero(at + size <= last)
    h = np.zeros(len(whole), np.uint64)
    for j in range(size):
        h = h * _BASE + hashes[whole + j]
    h = mix(h + _U(size))
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if not len(short):
        return doc[whole], h
    s = np.zeros(len(short), np.uint64)
    for j in range(size - 1):
        has = n_words[short] > j
        s[has] = s[has] * _BASE + hashes[count[:-1][short][has] + j]
    s = mix(s * p[1] + n_words[short].astype(np.uint64))
    d = np.concatenate([doc[whole], short])
    order = np.argsort(d, kind="stable")
    return d[order], np.concatenate([h, s])[order]


def distinct_pairs(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (doc, hash) pairs, ordered by doc, then hash."""
    if not len(doc):
        return doc, h
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    keep = np.ones(len(doc), bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[keep], h[keep]
