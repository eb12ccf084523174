"""Exact Jaccard join of word n-gram sets with PartEnum signatures.

Sets whose sizes can match stand in two neighbouring size bands.  In a band,
two sets that are similar enough differ in at most k features, so of k + 1
parts of the feature domain at least one is equal in both: the hash of a set's
features in a part is its signature there.  Parts that are empty in a set say
nothing; a band has spare parts for the usual number of them, and a set with
more empty parts also signs further, independent partitions of the domain, up
to the last one, where such sets share one signature.

Sets that share a signature are compared in blocks: all sets that share a
signature whose smallest member is p form the block of p.  A block's sets meet
in one task (large blocks: chunk against chunk), first as parity sketches, whose
distance bounds that of the sets from below, so that a set without a possible
partner goes; then as sets, which are compared exactly.  They give at most one
link per set and chunk, so nothing grows with the square of a group.  Equal
sets count as one from the first task on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.arrays import mix, shingles, text_slices
from lakemart.llm.components import components
from lakemart.llm.memory import light
from lakemart.llm.packed import by_bucket, five_bytes, from_five_bytes, pack, saved, text_buckets, unpack

_U = np.uint64
#: Bits of a feature kept beside 12 bits of the document's place in a slice.
FEATURE_BITS = 52
SLICE_DOCS = 1 << 12
#: Partitions of the domain that a set with many empty parts may sign.
ROUNDS = 4
#: Sets of a block compared in one task; larger blocks are compared chunk by chunk.
BLOCK_SETS = 1024
#: Bits of a bitmap for each id that it marks.
MARK_BITS = 16
#: 64-bit words of a parity sketch.
SKETCH_WORDS = 16


def feature_sets(column: pa.Array, size: int):
    """(first row, past row, document, feature) for slices of a text column:
    each document's distinct features, in order."""
    for row, past, data, off in text_slices(column):
        for lo in range(row, past, SLICE_DOCS):
            hi = min(past, lo + SLICE_DOCS)
            o = off[lo - row: hi - row + 1]
            doc, h = shingles(data[o[0]: o[-1]], o - o[0], size)
            key = np.unique((doc.astype(_U) << _U(FEATURE_BITS)) | (h >> _U(64 - FEATURE_BITS)))
            yield lo, hi, (key >> _U(FEATURE_BITS)).astype(np.int64), key & _U((1 << FEATURE_BITS) - 1)


def parity_sketches(doc: np.ndarray, feature: np.ndarray, n_docs: int) -> np.ndarray:
    """SKETCH_WORDS words a set: each bit is the parity of the features that
    fall on it.  Two sets differ in at least as many features as their
    sketches in bits."""
    x = mix(feature + _U(0x5CE7C4))
    at = (x % _U(SKETCH_WORDS)).astype(np.int64)
    out = np.zeros(n_docs * SKETCH_WORDS, _U)
    np.bitwise_xor.at(out, doc * SKETCH_WORDS + at, _U(1) << (x >> _U(58)))
    return out.reshape(n_docs, SKETCH_WORDS)


class Bands:
    """Size bands for a threshold of num/100, and the parts of each."""

    def __init__(self, num: int):
        low, k, parts, spare = [1], [], [], []
        while low[-1] < 1 << 40:
            r = low[-1] * 100 // num
            k.append(2 * (100 - num) * r // (100 + num))
            least = low[-2] if len(low) > 1 else 1
            n = k[-1] + 1
            empty = n * np.exp(-least / n) if n > 1 else 0.0
            more = 0 if empty < 0.25 else int(np.ceil(empty + 2 * np.sqrt(empty)))
            parts.append(n + more)
            spare.append(more)
            low.append(r + 1)
        self.low = np.array(low, np.int64)
        self.parts, self.spare = np.array(parts, np.int64), np.array(spare, np.int64)

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, size, side="right") - 1


def signatures(bands: Bands, doc: np.ndarray, feature: np.ndarray, n_docs: int):
    """(document, signature) of sets given by (document, feature)."""
    size = np.bincount(doc, minlength=n_docs)
    out_doc, out_sig = [], []
    for shift in (0, 1):
        band = bands.of(np.maximum(size, 1)) + shift
        active = size > 0
        d, f = doc, feature
        for turn in range(ROUNDS):
            n = np.where(active, bands.parts[band], 0)
            base = np.concatenate([[0], np.cumsum(n)])
            x = mix(f + _U(0x51ED2701 * (turn + 1)))
            part = (((x >> _U(32)) * n[d].astype(_U)) >> _U(32)).astype(np.int64)
            total = np.zeros(base[-1], _U)
            np.add.at(total, base[:-1][d] + part, mix(x))
            owner = np.repeat(np.arange(n_docs), n)
            part = np.arange(base[-1]) - base[:-1][owner]
            full = total != 0
            tag = mix((band[owner] * ROUNDS + turn).astype(_U) << _U(40) | part.astype(_U))
            out_doc.append(owner[full])
            out_sig.append(mix(total[full] + tag[full]))
            active = active & (n - np.bincount(owner[full], minlength=n_docs) > bands.spare[band])
            if not active.any():
                break
            if turn == ROUNDS - 1:
                rest = np.flatnonzero(active)
                out_doc.append(rest)
                out_sig.append(mix(mix(band[rest].astype(_U)) + _U(0xE)))
            on = active[d]
            d, f = d[on], f[on]
    return np.concatenate(out_doc), np.concatenate(out_sig)


def _set_hashes(doc: np.ndarray, feature: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each set, the same for equal sets."""
    hi, lo = np.zeros(n_docs, _U), np.zeros(n_docs, _U)
    if len(doc):
        heads = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        hi[doc[heads]] = np.add.reduceat(mix(feature + _U(0xA11CE)), heads)
        lo[doc[heads]] = np.add.reduceat(mix(mix(feature) + _U(0xB0B)), heads)
    return hi, lo


def _map(size: int, num: int, n_buckets: int):
    """Texts -> packed signatures by bucket, and packed facts of documents."""
    def run(batches):
        bands, seen, spread = Bands(num), set(), 0
        for b in batches:
            ids = b.column(0)
            known = np.asarray(ids.is_valid())
            doc_id = np.asarray(ids.fill_null(0))
            for lo, hi, doc, feature in feature_sets(b.column(1), size):
                n = hi - lo
                h1, h2 = _set_hashes(doc, feature, n)
                count = np.bincount(doc, minlength=n)
                spread = (spread * 31 + int(h1[0] >> _U(8)) + 1) % n_buckets
                yield spread, pack(doc_id[lo:hi], known[lo:hi], count.astype(np.int32), h1, h2, parity_sketches(doc, feature, n)), 1
                first = np.zeros(n, bool)
                for i in np.flatnonzero((count > 0) & known[lo:hi]):
                    key = (int(h1[i]), int(h2[i]))
                    if key not in seen:
                        seen.add(key)
                        first[i] = True
                if not first.any():
                    continue
                place = np.cumsum(first) - 1
                on = first[doc]
                own, sig = signatures(bands, place[doc[on]], feature[on], int(first.sum()))
                c1, c2 = h1[first], h2[first]
                bucket = ((sig >> _U(40)) % _U(n_buckets)).astype(np.int64)
                for k, at in by_bucket(bucket, n_buckets):
                    mine, local = np.unique(own[at], return_inverse=True)
                    yield k, pack(c1[mine], c2[mine], local.astype(np.uint16), five_bytes(sig[at])), 0

    def to_batches(batches):
        for k, payload, kind in run(batches):
            yield pa.record_batch([pa.array([k], pa.int32()), pa.array([kind], pa.int32()), pa.array([payload], pa.binary())],
                                  names=["bucket", "kind", "payload"])
    return to_batches


_STAGE = "kind int, doc_id long, known boolean, n int, h1 long, h2 long, p1 long, p2 long, sketch binary"


def _reduce(table: pa.Table) -> pa.Table:
    """One bucket: facts of documents as they are, and a star of edges for each
    signature that several sets share."""
    kind = table.column("kind").to_pylist()
    payload = table.column("payload")
    cols: dict[str, list] = {k: [] for k in ("kind", "doc_id", "known", "n", "h1", "h2", "p1", "p2")}

    sketches: list = []

    def put(sketch=None, **arrays):
        size = len(arrays["h1"])
        sketches.extend([None] * size if sketch is None else [x.tobytes() for x in sketch])
        for k in cols:
            cols[k].append(arrays[k] if k in arrays else np.zeros(size, np.int64))

    c1, c2, own, sig, base = [], [], [], [], 0
    for i, k in enumerate(kind):
        blob = payload[i].as_buffer()
        if k:
            doc_id, known, n, h1, h2, sketch = unpack(blob, np.int64, bool, np.int32, _U, _U, _U)
            put(sketch=sketch.reshape(-1, SKETCH_WORDS), kind=np.ones(len(h1), np.int64), doc_id=doc_id, known=known, n=n, h1=h1.view(np.int64), h2=h2.view(np.int64))
        else:
            a, b, local, s = unpack(blob, _U, _U, np.uint16, np.uint8)
            c1.append(a)
            c2.append(b)
            own.append(local.astype(np.int64) + base)
            sig.append(from_five_bytes(s))
            base += len(a)
    if sig:
        c1, c2, own, sig = map(np.concatenate, (c1, c2, own, sig))
        order = np.argsort(sig, kind="stable")
        sig, own = sig[order], own[order]
        head = np.concatenate([[True], sig[1:] != sig[:-1]])
        group = np.cumsum(head) - 1
        shared = np.bincount(group)[group] > 1
        own, group = own[shared], group[shared]
        if len(own):
            a, b = c1[own], c2[own]
            order = np.lexsort((b, a, group))
            a, b, group = a[order], b[order], group[order]
            head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            size = np.diff(np.append(head, len(group)))
            p, q = np.repeat(a[head], size), np.repeat(b[head], size)
            other = (a != p) | (b != q)
            e = np.unique(np.stack([a[other], b[other], p[other], q[other]], axis=1).view(np.int64), axis=0)
            put(h1=e[:, 0], h2=e[:, 1], p1=e[:, 2], p2=e[:, 3])
    kinds = {"kind": np.int32, "known": bool, "n": np.int32}
    out = {k: pa.array(np.concatenate(v).astype(kinds.get(k, np.int64)) if v else np.zeros(0, kinds.get(k, np.int64)))
           for k, v in cols.items()}
    return pa.table(out | {"sketch": pa.array(sketches, pa.binary())})


def _tasks(table: pa.Table):
    """(rows, crossed) of each task (block, i, j) in a bucket; crossed: chunk i meets another chunk."""
    block, i, j, member = (np.asarray(table.column(c)) for c in ("block", "i", "j", "member"))
    order = np.lexsort((member, j, i, block))
    key = np.stack([block, i, j], axis=1)[order]
    heads = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])) if len(order) else []
    for a, b in zip(heads, [*heads[1:], len(order)], strict=True):
        if b - a > 1:
            yield order[a:b], bool(i[order[a]] != j[order[a]])


def _sieve(num: int):
    """Blocks of sketches -> (block, member) of the sets that may have a partner."""
    def run(table: pa.Table) -> pa.Table:
        block, member, side, size = (np.asarray(table.column(c)) for c in ("block", "member", "chunk", "n"))
        size = size.astype(np.int64)
        blobs = table.column("sketch").to_pylist()
        kept = []
        for rows, crossed in _tasks(table):
            s = np.frombuffer(b"".join([blobs[r] for r in rows]), _U).reshape(len(rows), -1)
            n, chunk = size[rows], side[rows]
            may = np.zeros(len(rows), bool)
            for x in range(len(rows)):
                apart = np.bitwise_count(s ^ s[x]).sum(axis=1, dtype=np.int64)
                near = ((100 + num) * apart <= (100 - num) * (n + n[x])) & (100 * np.minimum(n, n[x]) >= num * np.maximum(n, n[x]))
                near[x] = False
                if crossed:
                    near &= chunk != chunk[x]
                may[x] = near.any()
            kept.append(rows[may])
        kept = np.concatenate([*kept, np.zeros(0, np.int64)])
        return pa.table({"block": pa.array(block[kept], pa.int64()), "member": pa.array(member[kept], pa.int64())})
    return run

def _compare(num: int):
    """Blocks of sets -> links, a forest over each block's linked sets."""
    def links(ids: np.ndarray, side: np.ndarray, sets: list[np.ndarray], crossed: bool) -> list[tuple[int, int]]:
        m = len(ids)
        size = np.array([len(s) for s in sets])
        up = list(range(m))

        def root(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(m), size)
        order = np.argsort(flat, kind="stable")
        s = flat[order]
        head = np.concatenate([[True], s[1:] != s[:-1]])
        of = np.empty(len(flat), np.int64)
        of[order] = np.cumsum(head) - 1
        begin = np.append(np.flatnonzero(head), len(s))
        posting = owner[order]
        start = np.concatenate([[0], np.cumsum(size)])
        left = m - 1
        for x in range(m):
            if not left:
                break
            f = of[start[x]: start[x + 1]]
            n = begin[f + 1] - begin[f]
            at = np.repeat(begin[f] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            both = np.bincount(posting[at], minlength=m)
            near = 100 * both >= num * (size + size[x] - both)
            near[: x + 1] = False
            if crossed:
                near &= side != side[x]
            for y in np.flatnonzero(near):
                a, b = root(x), root(int(y))
                if a != b:
                    up[max(a, b)] = min(a, b)
                    left -= 1
        return [(int(ids[i]), int(ids[root(i)])) for i in range(m) if root(i) != i]

    def run(table: pa.Table) -> pa.Table:
        member, side = np.asarray(table.column("member")), np.asarray(table.column("chunk"))
        blobs = table.column("features")
        out = []
        for rows, crossed in _tasks(table):
            sets = [np.frombuffer(blobs[int(r)].as_buffer(), _U) for r in rows]
            out += links(member[rows], side[rows], sets, crossed)
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})
    return run


def _sets_of(size: int):
    def run(batches):
        for b in batches:
            for lo, hi, doc, feature in feature_sets(b.column(1), size):
                ends = np.searchsorted(doc, np.arange(hi - lo + 1))
                blobs = [feature[ends[k]: ends[k + 1]].tobytes() for k in range(hi - lo)]
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo), pa.array(blobs, pa.binary())],
                                      names=["member", "targets", "features"])
    return run


def _dealt(members: DataFrame) -> DataFrame:
    """(block, member) with g, the chunks of the block, and the member's chunk."""
    chunks = members.groupBy("block").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("int").alias("g")).where("g > 1")
    return (members.join(chunks, "block", "left").na.fill(1, ["g"])
            .withColumn("chunk", F.pmod(F.xxhash64("member"), F.col("g")).cast("int")))


def _met(rows: DataFrame, n: int) -> DataFrame:
    """Rows of dealt members, once for each pair of chunks (i, j) that they
    belong to, grouped by buckets of such tasks."""
    other = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    tasks = other.withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other")).drop("other", "g")
    return tasks.withColumn("bucket", F.pmod(F.xxhash64("block", "i", "j"), F.lit(n)).cast("int")).groupBy("bucket")


def marked_rows(rows: DataFrame, key: str, ids: DataFrame, bits: int | None = None) -> DataFrame:
    """The rows whose ``key`` (a long) may be one of ``ids``, told by a broadcast bitmap of
    hashes: those of ids all stay, and of the others about one in MARK_BITS.  So that rows
    which no join wants are not shuffled for it.  At most 32 MB are broadcast."""
    if bits is None:
        bits = min(max((MARK_BITS * ids.count()).bit_length(), 15), 28)

    def at(col: str):
        return F.pmod(F.xxhash64(col), F.lit(1 << bits))

    marks = (ids.select(at(ids.columns[0]).alias("__at")).groupBy(F.shiftright("__at", 15).alias("__page"))
             .agg(F.bitmap_construct_agg(F.col("__at") % (1 << 15)).alias("__marks")))
    byte = F.expr("cast(conv(hex(substring(__marks, cast(shiftright(__at % 32768, 3) as int) + 1, 1)), 16, 10) as int)")
    bit = F.expr("cast(shiftleft(1, cast(__at % 8 as int)) as int)")
    placed = rows.withColumn("__at", at(key)).withColumn("__page", F.shiftright("__at", 15))
    return placed.join(F.broadcast(marks), "__page").where(byte.bitwiseAND(bit) != 0).select(*rows.columns)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, percent: int = 85) -> DataFrame:
    """One row per input row: doc_id, n_shingles and component_id.

    Two documents link when 100 * |A and B| >= percent * |A or B| for their
    sets of distinct shingles of ``words`` words (fewer words: the whole
    sequence as one).  component_id is the smallest id reachable by links, the
    document's own included.  A null, empty or blank text has an empty set and
    links with nothing.  A row with a null id links with nothing and has a null
    component_id.  Rows that share an id share their smallest component.
    Other columns are not read.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    buckets = text_buckets(docs, "text")
    stage = (docs.mapInArrow(light(_map(words, percent, buckets)), "bucket int, kind int, payload binary")
             .groupBy("bucket").applyInArrow(light(_reduce), _STAGE))
    stage = saved(stage, spark)
    facts = stage.where("kind = 1").select("doc_id", "known", "n", "h1", "h2")
    classes = saved(stage.where("kind = 1 and known and n > 0").groupBy("h1", "h2")
                    .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), spark)
    edges = stage.where("kind = 0").select("h1", "h2", "p1", "p2").distinct()
    reps = classes.select("h1", "h2", "rep")
    pairs = (edges.join(reps, ["h1", "h2"])
             .join(reps.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("rep").alias("block")), ["p1", "p2"])
             .select("block", F.col("rep").alias("member")))
    members = saved(pairs.union(pairs.select("block", F.col("block").alias("member"))).distinct(), spark)
    sketched = _dealt(members).join(classes.select(F.col("rep").alias("member"), "n", "sketch"), "member")
    members = saved(_met(sketched, buckets).applyInArrow(light(_sieve(percent)), "block long, member long").distinct(), spark)
    targets = _dealt(members).groupBy("member").agg(F.collect_list(F.struct("block", "g", "chunk")).alias("targets"))
    kind = dict(targets.dtypes)["targets"]
    # the same join at every size: the targets grow with the documents
    wanted = marked_rows(docs, "doc_id", members.select("member").distinct()).join(targets.withColumnRenamed("member", "doc_id").hint("merge"), "doc_id").select("doc_id", "text", "targets")
    sets = (wanted.mapInArrow(light(_sets_of(words)), f"member long, targets {kind}, features binary")
            .select("member", F.explode("targets").alias("t"), "features").select("member", "t.*", "features"))
    links = _met(sets, buckets).applyInArrow(light(_compare(percent)), "a long, b long")
    roots = components(links, spark)
    named = reps.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "h1", "h2", F.coalesce("root", "rep").alias("root"))
    own = F.when(F.col("known"), F.coalesce("root", "doc_id"))
    return (facts.join(named, (facts.h1 == named.h1) & (facts.h2 == named.h2) & facts.known & (facts.n > 0), "left")
            .select(F.when(F.col("known"), F.col("doc_id")).alias(id_col), F.col("n").cast("long").alias("n_shingles"),
                    own.alias("component_id")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without those whose document links, over any number of
    links, with one of a smaller id (ties: by a hash of the text, then the other columns).

    Rows are told apart by a number of their own: rows that share an id but not
    the text are documents of their own.  Of rows without words that agree in id
    and text one stays.  Rows with a null id all stay.
    """
    spark, columns = docs.sparkSession, docs.columns
    rest = [c for c in columns if c not in (id_col, text_col)]
    rows = saved(docs.withColumn("__row", F.monotonically_increasing_id()), spark)
    named = rows.where(F.col(id_col).isNotNull())
    groups = near_groups(named, id_col="__row", text_col=text_col, words=words, percent=percent)
    blank = F.coalesce(text_col, F.lit("")).rlike(r"\A[\t-\r ]*\z")  # no shingles: copies are equal rows
    keys = named.select("__row", F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), *rest, "__row").alias("__order"),
                        F.when(blank, F.col(id_col)).alias("__id"), F.when(blank, F.col(text_col)).alias("__blank"))
    keys = saved(keys.join(groups.select("__row", F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("__group")), "__row"), spark)
    first = keys.groupBy("__group", "__id", "__blank").agg(F.min("__order").alias("__order")).select("__order.__row")
    others = keys.select("__row").join(first, "__row", "left_anti")
    return rows.join(others, "__row", "left_anti").select(*columns)
