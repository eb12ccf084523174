"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are partitioned by the size of their shingle sets.  For a size class
of at most S shingles, long documents are cut into windows of 2S shingles, S
apart, so that any S shingles in a row lie in one window and the Jaccard
similarity of an item and its window is bounded from below by the containment.
Item and window are a candidate pair when one of their MinHash values is equal;
candidates are then verified by exact containment in the whole document.
The multipliers are odd, so a MinHash value is equal only where the least shingle is
one of the item's: documents without a shingle of any item are left out before the
windows are made, which loses no candidate.

Classes begin at one shingle and double.  An item of one shingle is looked up as
it is, exactly.  An item of s > S / 2 shingles that a window holds to the
threshold t has a Jaccard similarity of at least t*s / (2S + (1-t)*s), 0.19 for
t = 0.8; all 64 values differ with a probability under 2e-6 there, and under
1e-10 for items that fill their class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.arrays import distinct_pairs, mix, shingles, text_slices
from lakemart.llm.memory import light
from lakemart.llm.packed import saved

_U = np.uint64
#: MinHash functions.
HASHES = 64
#: Bytes of item texts searched in one pass over the documents, and broadcast in it.
ITEM_BYTES = 8 << 20


class Items:
    """MinHash tables of one block of items."""

    def __init__(self, ids: list, texts: list[str], words: int, rows: list[int]):
        """``rows``: how often each item stands in its table."""
        self.rows = rows
        doc, h = [], []
        for row, _, data, off in text_slices(pa.array(texts, pa.string())):
            d, x = shingles(data, off, words)
            doc.append(d + row)
            h.append(x)
        doc = np.concatenate(doc) if doc else np.zeros(0, np.int64)
        h = np.concatenate(h) if h else np.zeros(0, _U)
        doc, h = distinct_pairs(doc, h)
        ends = np.searchsorted(doc, np.arange(len(ids) + 1))
        self.ids = ids
        self.sets = [h[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        size = np.diff(ends)
        # the items' shingles, and which leading bits they have (at least 8 places for each)
        self.all = np.unique(h)
        self.bits = max(10, (8 * len(self.all)).bit_length())
        self.held = np.zeros(1 << self.bits, bool)
        self.held[self.all >> _U(64 - self.bits)] = True
        self.classes = {}
        self.factor = mix(np.arange(1, HASHES + 1, dtype=_U)) | _U(1)
        low, top = 0, 1
        while size.size and low < size.max():
            mine = np.flatnonzero((size > low) & (size <= top))
            if len(mine):
                own = np.concatenate([self.sets[i] for i in mine])
                heads = np.cumsum(size[mine]) - size[mine]
                tables = []
                for a in self.factor[: 1 if top == 1 else HASHES]:
                    least = np.minimum.reduceat(own * a, heads)
                    order = np.argsort(least, kind="stable")
                    tables.append((least[order], mine[order]))
                self.classes[top] = tables
            low, top = top, 2 * top

    def near(self, doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All shingles of the documents that have one of an item's."""
        maybe = np.flatnonzero(self.held[h >> _U(64 - self.bits)])
        kept = np.zeros(int(doc[-1]) + 1, bool)
        kept[doc[maybe[np.isin(h[maybe], self.all)]]] = True
        return doc[kept[doc]], h[kept[doc]]

    def candidates(self, doc: np.ndarray, h: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) pairs of documents' shingles in text order."""
        found: set[tuple[int, int]] = set()
        if not len(h) or not self.classes:
            return found
        doc, h = self.near(doc, h)
        if not len(h):
            return found
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        place = np.arange(len(doc)) - np.repeat(first, np.diff(np.append(first, len(doc))))
        top = max(self.classes)

        def search(values, items, window, owner):
            lo = np.searchsorted(values, window)
            hit = np.flatnonzero(values[np.minimum(lo, len(values) - 1)] == window)
            count = np.searchsorted(values, window[hit], side="right") - lo[hit]
            at = np.repeat(lo[hit], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            found.update(zip(np.repeat(owner[hit], count).tolist(), items[at].tolist(), strict=True))

        if 1 in self.classes:  # a set of one: equal in one MinHash value is equal
            search(*self.classes[1][0], h * self.factor[0], doc)
        for k, a in enumerate(self.factor):
            least, owner, step, at = h * a, doc, 1, place
            while step < top:
                # blocks of the next size class: minima of pairs of smaller blocks
                heads = np.flatnonzero(at % 2 == 0)
                least, owner = np.minimum.reduceat(least, heads), owner[heads]
                at = at[heads] // 2
                step *= 2
                if step not in self.classes:
                    continue
                window = least.copy()
                same = owner[1:] == owner[:-1]
                window[:-1][same] = np.minimum(window[:-1][same], least[1:][same])
                search(*self.classes[step][k], window, owner)
        return found


def marked(docs: DataFrame, items: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
           item_id: str = "item_id", item_text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The columns ``keep`` of every row and hits: an array of (item_id,
    n_shared, n_item) of the items of which its text holds at least ``percent``
    of the distinct shingles of ``words`` words.

    Words are runs without white space, A-Z lower-cased; a text of fewer words
    is one shingle, its whole sequence.  Null, empty and blank texts have no
    shingles and match nothing.  Null ids and repeated rows, of documents and
    items, stay as they are (a repeated item hits as often).  Items are read in blocks of bounded size, one pass over the
    documents each, written between passes; a block is what is broadcast.  Other columns are not read;
    ``keep`` must not hold hits.
    """
    spark = docs.sparkSession
    items = items.groupBy(F.col(item_id).alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text")).agg(F.count("*").alias("rows"))
    hit = f"array<struct<item_id:{dict(items.dtypes)['item_id']},n_shared:bigint,n_item:bigint>>"
    size = items.agg(F.sum(F.octet_length("text") + 16).alias("b")).first()["b"] or 0
    passes = max(1, -(-int(size) // ITEM_BYTES))
    now = docs.select(*keep, F.lit(None).cast(hit).alias("hits"), F.col(text_col).alias("__text"))
    schema = ", ".join(f"`{c}` {t}" for c, t in now.dtypes)
    for p in range(passes):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == p) if passes > 1 else items
        rows = block.collect()
        # at most about ITEM_BYTES of text
        shared = spark.sparkContext.broadcast(Items([r["item_id"] for r in rows], [r["text"] for r in rows], words, [r["rows"] for r in rows]))

        def run(batches, shared=shared):
            found = shared.value
            for b in batches:
                text, hits = b.column(b.num_columns - 1), b.column(b.num_columns - 2)
                new: dict[int, list] = {}
                for row, past, data, off in text_slices(text):
                    doc, h = shingles(data, off, words)
                    pairs = sorted(found.candidates(doc, h))
                    ends = np.searchsorted(doc, np.arange(past - row + 1)) if pairs else None
                    for d, i in pairs:
                        n = int(np.isin(found.sets[i], h[ends[d]: ends[d + 1]]).sum())
                        if 100 * n >= percent * len(found.sets[i]):
                            hit = {"item_id": found.ids[i], "n_shared": n, "n_item": len(found.sets[i])}
                            new.setdefault(row + d, []).extend([hit] * found.rows[i])
                if new:
                    hits = pa.array([(old or []) + new.get(i, []) for i, old in enumerate(hits.to_pylist())], hits.type)
                yield pa.record_batch([*b.columns[:-2], hits, text], names=b.schema.names)

        now = now.mapInArrow(light(run), schema)
        if p < passes - 1:
            now = saved(now, spark)  # one block's table in a worker at a time
    return now.select(*keep, F.coalesce("hits", F.array().cast(hit)).alias("hits"))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item), a row for each hit of ``marked``."""
    hits = marked(docs, items, keep=(id_col,), **options)
    return hits.select(F.col(id_col), F.explode("hits").alias("h")).select(id_col, "h.item_id", "h.n_shared", "h.n_item")
