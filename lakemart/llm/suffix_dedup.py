"""Removal of byte strings that already occurred, over a whole corpus.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts
earlier: in a smaller document, or in the same one before.

Equal strings must meet.  Of the 32-byte grams in a string of 100 bytes, the
one of the smallest hash (the first, of several) is its anchor, so equal
strings have equal anchors at equal places.  The strings of a text that share
an anchor form one segment.  Segments travel as hashes of their anchor and of
their bytes; equal segments are folded into the earliest one, in each task and
again where they meet, and all strings of the others are known to repeat.
Where an anchor has several different segments, the earliest of each are fetched
as bytes, and their common strings are found by threshold-bounded interval
expansion on a Burrows-Wheeler transform of each bucket (see ``bwt``).

Nothing passes through one task whole: buckets have bounded text, and an
anchor with very many different segments sends its strings one by one, each to
the bucket of its own hash.  Rows are dealt by id and text together, so that only
equal rows meet, and of these each task sends one text: the others are removed
whole and go anywhere, without their texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.arrays import _BASE, _BYTE, mix, powers, text_slices
from lakemart.llm.bwt import repeat_classes
from lakemart.llm.memory import light
from lakemart.llm.packed import by_bucket, five_bytes, from_five_bytes, pack, text_buckets, unpack

_U = np.uint64
LENGTH, GRAM = 100, 32
#: Positions handled at once; longer texts are cut into overlapping parts.
PART = 1 << 20
#: Bytes of text whose segments are folded and sent together.
FOLD_BYTES = 12 << 20
#: Different segments of one anchor that go to one bucket; beyond it, strings go one by one.
WIDE = 1 << 15
#: Bytes of one Burrows-Wheeler transform, unless one anchor has more.
BLOCK_BYTES = 1 << 20

_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _inverse_powers(n: int) -> np.ndarray:
    p = np.full(n, _INVERSE, dtype=np.uint64)
    p[:1] = 1
    return np.cumprod(p, dtype=np.uint64)


def string_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range of ``data``."""
    total = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE[data] * powers(max(1, len(data))), out=total[1:])
    inverse = _inverse_powers(len(data) + 1)
    return mix((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(_U))


def segments(data: np.ndarray, off: np.ndarray):
    """(begin, strings, anchor hash, segment hash) of the segments of the
    documents at ``off`` in ``data`` (PART bytes at most)."""
    none = np.zeros(0, np.int64)
    n = len(data)
    if n < LENGTH:
        return none, none, none.astype(_U), none.astype(_U)
    h, span, base = _BYTE[data], 1, int(_BASE)
    while span < GRAM:
        h = h[:-span] * _U(pow(base, span, 1 << 64)) + h[span:]
        span *= 2
    h = mix(h)
    place = _U(PART - 1)
    v = (h & ~place) | np.arange(len(h), dtype=_U)
    grams, span = LENGTH - GRAM + 1, 1
    while 2 * span <= grams:
        v = np.minimum(v[:-span], v[span:])
        span *= 2
    rest = grams - span
    if rest:
        v = np.minimum(v[: len(v) - rest], v[rest:])
    valid = np.ones(len(v), bool)
    for k in range(1, len(off) - 1):  # no string crosses documents
        valid[max(0, off[k] - LENGTH + 1): off[k]] = False
    start = np.flatnonzero(valid)
    if not len(start):
        return none, none, none.astype(_U), none.astype(_U)
    anchor = (v[start] & place).astype(np.int64)
    head = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (np.diff(start) != 1)]))
    begin = start[head]
    strings = np.diff(np.append(head, len(start)))
    end = begin + strings + LENGTH - 1
    return begin, strings, h[anchor[head]], mix(string_hashes(data, begin, end) + _U(7) * (anchor[head] - begin).astype(_U))


def _text_parts(column: pa.Array):
    """(first row, past row, bytes, offsets, place of the bytes in a long document)."""
    for row, past, data, off in text_slices(column, PART // 2):
        if len(data) <= PART:
            yield row, past, data, off, 0
        else:
            step = PART - LENGTH + 1
            for at in range(0, len(data) - LENGTH + 1, step):
                part = data[at: at + PART]
                yield row, past, part, np.array([0, len(part)]), at


def _first_of(*keys: np.ndarray) -> np.ndarray:
    """With rows sorted by ``keys``: whether a row differs from the one before."""
    new = np.zeros(len(keys[0]), bool)
    if len(new):
        new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


_ROWS = "bucket int, kind int, payload binary"
_SCHEMA = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("payload", pa.binary())])
#: Kinds of rows: segments (by bucket of the anchor); removed ranges and requests
#: for bytes (by part of the document); bytes of segments (by bucket).
SEGMENTS, RANGES, REQUESTS, BYTES = range(4)


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [(), (), ()]
    return pa.record_batch([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())], schema=_SCHEMA)


def _part(doc: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """The part of each document, by its id and the hash of its text."""
    return (doc ^ text) % n


def _prime(n: int) -> int:
    """The smallest prime from n on, so that ids in regular steps spread over all parts."""
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _deal(n: int, fetched: bool):
    """Documents (id, text hash, text, other columns) with their part and a
    number of removed bytes.  Of equal rows of a task all but the first lose
    their text, and all of its bytes count as removed.  Those and texts of less
    than LENGTH bytes need to meet no others: they are spread evenly, or left
    out where only texts to be ``fetched`` are wanted."""
    def run(batches):
        seen: set[tuple[int, int]] = set()
        at = TaskContext.get().partitionId()
        for b in batches:
            ids, hashes, text = np.asarray(b.column(0)), np.asarray(b.column(1)), b.column(2)
            size = np.asarray(pc.binary_length(text)).astype(np.int64)
            long = size >= LENGTH
            again = np.zeros(len(size), bool)
            for i in np.flatnonzero(long).tolist():
                key = (int(ids[i]), int(hashes[i]))
                again[i] = key in seen
                seen.add(key)
            meet = long & ~again
            part = _part(ids, hashes, n)
            part[~meet] = (at + np.arange(int((~meet).sum()))) % n
            at += int((~meet).sum())
            cols = [pa.array(part.astype(np.int32)), *b.columns]
            names = ["bucket", *b.schema.names]
            if fetched:
                yield pa.record_batch(cols, names=names).filter(pa.array(meet))
            else:
                cols[3] = pc.if_else(pa.array(again), pa.scalar(None, text.type), text)
                yield pa.record_batch([*cols, pa.array(size, mask=~again)], names=[*names, "gone"])
    return run


def _put_ranges(rows, doc, text, begin, end, n: int) -> None:
    """Rows of removed ranges, by the part of their documents."""
    for p, at in by_bucket(_part(doc, text, n), n):
        at = at[np.lexsort((begin[at], text[at], doc[at]))]
        rows.append((p, RANGES, pack(doc[at], text[at], begin[at].astype(np.int64), end[at].astype(np.int64))))


def _map(n: int):
    """Texts -> folded segments by bucket, and ranges known to repeat inside the task."""
    def fold(held):
        doc, text, begin, strings, anchor, whole = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((begin, text, doc, whole, anchor))
        doc, text, begin, strings, anchor, whole = (x[order] for x in (doc, text, begin, strings, anchor, whole))
        new = _first_of(anchor, whole, doc, text, begin)  # repeated rows of the table: one
        keep = _first_of(anchor, whole)
        rows: list = []
        again = new & ~keep
        _put_ranges(rows, doc[again], text[again], begin[again], begin[again] + strings[again] + LENGTH - 1, n)
        doc, text, begin, strings, anchor, whole = (x[keep] for x in (doc, text, begin, strings, anchor, whole))
        bucket = ((anchor >> _U(40)) % _U(n)).astype(np.int64)
        for b, at in by_bucket(bucket, n):
            at = at[np.lexsort((begin[at], text[at], doc[at]))]
            own = np.flatnonzero(_first_of(doc[at], text[at]))
            size = np.diff(np.append(own, len(at)))
            rows.append((b, SEGMENTS, pack(doc[at][own], text[at][own], size.astype(np.int32), begin[at].astype(np.uint32),
                                           strings[at].astype(np.uint8), five_bytes(anchor[at]), whole[at])))
        return _rows(rows)

    def run(batches):
        held, size = [], 0
        for b in batches:
            doc_id, text_hash = np.asarray(b.column(0)), np.asarray(b.column(1))
            for row, past, data, off, at in _text_parts(b.column(2)):
                begin, strings, anchor, whole = segments(data, off)
                if len(begin):
                    k = np.searchsorted(off, begin, side="right") - 1
                    held.append((doc_id[row + k], text_hash[row + k], begin - off[k] + at, strings, anchor, whole))
                size += len(data)
                if size >= FOLD_BYTES and held:
                    yield fold(held)
                    held, size = [], 0
        if held:
            yield fold(held)
    return run


def _meet(n: int):
    """One bucket of segments -> ranges that repeat, and requests for the bytes
    of the different segments of an anchor."""
    def run(table: pa.Table) -> pa.Table:
        kinds, payload = table.column("kind").to_pylist(), table.column("payload")
        rows, cols, bucket = [], [], table.column("bucket")[0].as_py()
        for i, kind in enumerate(kinds):
            blob = payload[i].as_buffer()
            if kind != SEGMENTS:
                rows.append((bucket, kind, blob.to_pybytes()))
                continue
            doc, text, size, begin, strings, anchor, whole = unpack(blob, np.int64, np.int64, np.int32, np.uint32, np.uint8, np.uint8, _U)
            cols.append((np.repeat(doc, size), np.repeat(text, size), begin, strings, from_five_bytes(anchor), whole))
        if cols:
            doc, text, begin, strings, anchor, whole = (np.concatenate(x) for x in zip(*cols, strict=True))
            order = np.lexsort((anchor,))
            a = anchor[order]
            many = np.bincount(np.cumsum(_first_of(a)) - 1)
            order = order[np.repeat(many, many) > 1]  # anchors that stand once repeat nothing
            doc, text, begin, strings, anchor, whole = (x[order] for x in (doc, text, begin.astype(np.int64), strings.astype(np.int64), anchor, whole))
            order = np.lexsort((begin, text, doc, whole, anchor))
            doc, text, begin, strings, anchor, whole = (x[order] for x in (doc, text, begin, strings, anchor, whole))
            keep = _first_of(anchor, whole)
            again = ~keep & _first_of(anchor, whole, doc, text, begin)
            _put_ranges(rows, doc[again], text[again], begin[again], begin[again] + strings[again] + LENGTH - 1, n)
            doc, text, begin, strings, anchor = (x[keep] for x in (doc, text, begin, strings, anchor))
            group = np.cumsum(_first_of(anchor)) - 1
            kinds_of = np.bincount(group)[group] if len(group) else group
            on = kinds_of > 1
            wide = (kinds_of > WIDE)[on]
            doc, text, begin, strings, anchor = (x[on] for x in (doc, text, begin, strings, anchor))
            for p, at in by_bucket(_part(doc, text, n), n):
                rows.append((p, REQUESTS, pack(doc[at], text[at], begin[at], strings[at].astype(np.uint8), anchor[at], wide[at],
                                               np.full(len(at), bucket, np.int32))))
        return pa.Table.from_batches([_rows(rows)])
    return run


def _merge(doc, text, begin, end):
    """Overlapping or touching ranges of a document made one; sorted."""
    order = np.lexsort((begin, text, doc))
    doc, text, begin, end = doc[order], text[order], begin[order], end[order]
    if not len(doc):
        return doc, text, begin, end
    new = _first_of(doc, text)
    group = np.cumsum(new) - 1
    reach = np.maximum.accumulate(end + group * (int(end.max()) + 1)) - group * (int(end.max()) + 1)
    head = new.copy()
    head[1:] |= begin[1:] > reach[:-1]
    at = np.flatnonzero(head)
    return doc[at], text[at], begin[at], reach[np.append(at[1:], len(doc)) - 1]


def _read_ranges(blobs):
    cols = [unpack(b, np.int64, np.int64, np.int64, np.int64) for b in blobs]
    return [np.concatenate([c[k] for c in cols]) if cols else np.zeros(0, np.int64) for k in range(4)]


def _texts(table: pa.Table):
    """(ids, text hashes, text bytes, offsets) of a part's documents."""
    column = table.column("text").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return np.asarray(table.column("id")), np.asarray(table.column("text_hash")), data, off


def _fetch(n: int):
    """A part's documents and its rows -> bytes of requested segments, by bucket."""
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        rows: list = []
        kinds, payload = found.column("kind").to_pylist(), found.column("payload")
        blobs = [payload[i].as_buffer() for i in range(len(kinds))]
        ranges = [b for b, k in zip(blobs, kinds, strict=True) if k == RANGES]
        asked = [unpack(b, np.int64, np.int64, np.int64, np.uint8, _U, bool, np.int32) for b, k in zip(blobs, kinds, strict=True) if k == REQUESTS]
        if ranges:
            got = _merge(*_read_ranges(ranges))
            rows.append((int(found.column("bucket")[0].as_py()), RANGES, pack(*got)))
        if asked and docs.num_rows:
            doc, text, begin, strings, anchor, wide, bucket = (np.concatenate(x) for x in zip(*asked, strict=True))
            ids, hashes, data, off = _texts(docs)
            place = {k: i for i, k in enumerate(zip(ids.tolist(), hashes.tolist(), strict=True))}
            base = off[[place[k] for k in zip(doc.tolist(), text.tolist(), strict=True)]] + begin
            strings, bucket = strings.astype(np.int64), bucket.astype(np.int64)
            if wide.any():
                w = np.flatnonzero(wide)
                s = strings[w]
                step = np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s)
                one = np.repeat(base[w], s) + step
                key = string_hashes_at(data, one)
                rest = ~wide
                doc = np.concatenate([doc[rest], np.repeat(doc[w], s)])
                text = np.concatenate([text[rest], np.repeat(text[w], s)])
                begin = np.concatenate([begin[rest], np.repeat(begin[w], s) + step])
                anchor = np.concatenate([anchor[rest], key])
                bucket = np.concatenate([bucket[rest], (key % _U(n)).astype(np.int64)])
                base = np.concatenate([base[rest], one])
                strings = np.concatenate([strings[rest], np.ones(len(one), np.int64)])
            size = strings + LENGTH - 1
            for b, at in by_bucket(bucket, n):
                s = size[at]
                take = np.repeat(base[at] - (np.cumsum(s) - s), s) + np.arange(s.sum())
                rows.append((b, BYTES, pack(doc[at], text[at], begin[at], strings[at].astype(np.uint8), anchor[at], data[take])))
        return pa.Table.from_batches([_rows(rows)])
    return run


def string_hashes_at(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Hash of the LENGTH bytes at each start."""
    h = np.zeros(len(start), _U)
    for j in range(LENGTH):
        h = h * _BASE + _BYTE[data[start + j]]
    return mix(h)


def repeated_strings(doc, text, begin, strings, anchor, data):
    """Which strings of segments (of the bytes in ``data``, one after the other)
    also stand in an earlier segment: their document, text hash, begin and end."""
    size = strings + LENGTH - 1
    first = np.cumsum(size) - size
    out = []
    order = np.argsort(anchor, kind="stable")
    edges = np.flatnonzero(_first_of(anchor[order]))
    edges = np.append(edges, len(order))
    weight = np.concatenate([[0], np.cumsum(size[order])])
    k = 0
    while k < len(edges) - 1:  # whole anchors, BLOCK_BYTES together
        j = k + 1
        while j < len(edges) - 1 and weight[edges[j + 1]] - weight[edges[k]] <= BLOCK_BYTES:
            j += 1
        at = order[edges[k]: edges[j]]
        k = j
        s = size[at]
        begins = np.cumsum(s + 1) - (s + 1)
        symbols = np.zeros(int(s.sum()) + len(at), np.int64)  # 0 stands after each segment
        inside = np.repeat(begins - (np.cumsum(s) - s), s) + np.arange(s.sum())
        symbols[inside] = data[np.repeat(first[at] - (np.cumsum(s) - s), s) + np.arange(s.sum())].astype(np.int64) + 1
        suffix, cls = repeat_classes(symbols, LENGTH)
        owner = np.repeat(np.arange(len(at)), s + 1)[suffix]
        step = suffix - begins[owner]
        on = step < strings[at][owner]
        shared = np.bincount(cls[on], minlength=int(cls[-1]) + 1 if len(cls) else 0)
        on &= shared[cls] > 1
        owner, step, cls = at[owner[on]], step[on], cls[on]
        spot = begin[owner] + step
        o = np.lexsort((spot, text[owner], doc[owner], cls))
        again = o[~_first_of(cls[o])]
        out.append((doc[owner[again]], text[owner[again]], spot[again], spot[again] + LENGTH))
    if not out:
        return [np.zeros(0, np.int64)] * 4
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def _expand(n: int):
    """One bucket of segments' bytes -> ranges that repeat."""
    def run(table: pa.Table) -> pa.Table:
        kinds, payload = table.column("kind").to_pylist(), table.column("payload")
        rows, cols, bucket = [], [], table.column("bucket")[0].as_py()
        for i, kind in enumerate(kinds):
            blob = payload[i].as_buffer()
            if kind == BYTES:
                cols.append(unpack(blob, np.int64, np.int64, np.int64, np.uint8, _U, np.uint8))
            else:
                rows.append((bucket, kind, blob.to_pybytes()))
        if cols:
            doc, text, begin, strings, anchor, data = (np.concatenate(x) for x in zip(*cols, strict=True))
            _put_ranges(rows, *_merge(*repeated_strings(doc, text, begin, strings.astype(np.int64), anchor, data)), n)
        return pa.Table.from_batches([_rows(rows)])
    return run


def _remove(columns: list[str], as_text: bool):
    """A part's documents and removed ranges -> documents with spans and kept bytes."""
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        payload = found.column("payload")
        doc, text, begin, end = _merge(*_read_ranges([payload[i].as_buffer() for i in range(found.num_rows)]))
        ids, hashes, data, off = _texts(docs)
        heads = np.append(np.flatnonzero(_first_of(doc, text)), len(doc))
        ranges = {(int(doc[a]), int(text[a])): (begin[a:b], end[a:b]) for a, b in zip(heads[:-1], heads[1:], strict=True)}
        seen, spans, kept = set(), [], []
        none = np.zeros(0, np.int64)
        gone = docs.column("gone").to_pylist()
        for i, key in enumerate(zip(ids.tolist(), hashes.tolist(), strict=True)):
            raw = data[off[i]: off[i + 1]]
            if gone[i] is not None:  # the same row again: all of it stands in the one before
                spans.append([[0, gone[i]]])
                kept.append(b"")
                continue
            b, e = ranges.get(key, (none, none))
            if key in seen and len(raw) >= LENGTH:  # and in another task
                b, e = np.array([0]), np.array([len(raw)])
            seen.add(key)
            spans.append(np.stack([b, e], 1).tolist())
            if len(b):
                cover = np.zeros(len(raw) + 1, np.int8)
                cover[b] += 1
                cover[e] -= 1
                raw = raw[np.cumsum(cover[:-1]) == 0]
            kept.append(raw.tobytes())
        cols = [docs.column(c).combine_chunks() for c in columns]
        kept = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
        return pa.table([*cols, pa.array(spans, pa.list_(pa.list_(pa.int64()))), kept], names=[*columns, "__spans", "__kept"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", as_text: bool = False) -> DataFrame:
    """The columns of ``docs`` but the text, with spans (array of [begin, end)
    in bytes, the maximal removed runs) and kept (binary, the remaining bytes
    joined; as_text: a string without characters of which only a part remains),
    one row per input row.

    Texts are UTF-8 bytes; null: empty.  Matches never cross documents, and are
    judged on the input.  Documents are ordered by id, rows of one id by a hash
    of their text; a null id comes before all others; of rows that agree in
    both, the first found is the earlier.  Other columns are carried along;
    columns named spans or kept are replaced.  An empty table gives no rows.
    """
    others = [c for c in docs.columns if c not in (text_col, "spans", "kept")]
    n = _prime(text_buckets(docs, text_col))
    names = {c: f"c{i}" for i, c in enumerate(others)}
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(text).alias("text_hash"),
                      text.alias("text"), *[F.col(c).alias(k) for c, k in names.items()])
    found = src.select("id", "text_hash", "text").mapInArrow(light(_map(n)), _ROWS).groupBy("bucket").applyInArrow(light(_meet(n)), _ROWS)
    dealt = "bucket int, id long, text_hash long, text string"
    asked = src.select("id", "text_hash", "text").mapInArrow(light(_deal(n, True)), dealt).groupBy("bucket")
    fetched = asked.cogroup(found.groupBy("bucket")).applyInArrow(light(_fetch(n)), _ROWS)
    marked = fetched.groupBy("bucket").applyInArrow(light(_expand(n)), _ROWS)
    types = dict(src.dtypes)
    keep = list(names.values())
    schema = ", ".join(f"`{k}` {types[k]}" for k in keep) + ", __spans array<array<long>>, __kept " + ("string" if as_text else "binary")
    dealt += "".join(f", `{k}` {types[k]}" for k in keep) + ", gone long"
    by_part = src.mapInArrow(light(_deal(n, False)), dealt).groupBy("bucket")
    out = by_part.cogroup(marked.groupBy("bucket")).applyInArrow(light(_remove(keep, as_text)), schema)
    return out.select(*[F.col(k).alias(c) for c, k in names.items()], F.col("__spans").alias("spans"), F.col("__kept").alias("kept"))

