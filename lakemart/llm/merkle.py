"""Merkle manifest of a dataset, with a witness for every row, built by appends.

Rows become leaves (SHA-256 of their fields); the leaves of a group, in order,
form a tree of three children a node, and the roots of the groups, in order,
form one more tree above them.

Trees grow by incremental witnesses: nodes are appended in order to a stack of
open subtrees; a subtree carries the partial witnesses of the leaves below it,
and whenever its later siblings complete a run of three, each of these
witnesses is extended by the siblings.  One task appends one aligned block of
3**levels nodes at most; the roots of the blocks are then appended in the same way,
in blocks of blocks, until each group has one node.  A block's witness, made at
the end, comes back to its leaves as the last extension of theirs.  So a group
of any size is spread over many tasks, none of which holds more than a block.

Only hashes are shuffled and stored; texts are read once, by the leaf hashes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lakemart.llm.memory import light
from lakemart.llm.packed import saved

#: Children of a node, and levels of a block unless given.
ARITY, LEVELS = 3, 6

#: Columns of node tables: group, place in it, hash (32 bytes), nodes of the group.
_NODE = "g string, pos long, h binary, n long"


def combine(hashes: Sequence[bytes]) -> bytes:
    """SHA-256 over the hexadecimal texts of the hashes, one after the other."""
    return sha256("".join([h.hex() for h in hashes]).encode()).digest()


def levels_of(n: int, levels: int = LEVELS) -> int:
    """Levels that a block of a group of n nodes is folded by: up to one node, or
    ``levels`` when the group has further blocks."""
    k, top = 0, 1
    while top < n and k < levels:
        k, top = k + 1, top * ARITY
    return k


class Tree:
    """A block that grows by appends.

    ``open[k]`` holds the finished subtrees of height k that still wait for
    siblings: (hash, first leaf, past leaf).  A witness is a string of steps, from
    the leaf upwards: a byte (place in the run + 3 * siblings), then the siblings'
    hashes from left to right.
    """

    def __init__(self, height: int, witnesses: bool = True):
        self.height, self.size, self.root, self.witnesses = height, 0, b"", witnesses
        self.open: list[list[tuple[bytes, int, int]]] = [[] for _ in range(height + 1)]
        self.witness: list[bytearray] = []

    def append(self, leaf: bytes) -> None:
        if self.witnesses:
            self.witness.append(bytearray())
        self._put(0, (leaf, self.size, self.size + 1))
        self.size += 1

    def _put(self, k: int, node: tuple[bytes, int, int]) -> None:
        self.open[k].append(node)
        if k < self.height and len(self.open[k]) == ARITY:
            self._complete(k)

    def _complete(self, k: int) -> None:
        """Join a run: extend the witnesses below each member by its siblings."""
        run, self.open[k] = self.open[k], []
        for place, (_, lo, hi) in enumerate(run):
            step = bytes([place + ARITY * (len(run) - 1)]) + b"".join([r[0] for j, r in enumerate(run) if j != place])
            for w in self.witness[lo:hi]:
                w += step
        self._put(k + 1, (combine([r[0] for r in run]), run[0][1], run[-1][2]))

    def close(self) -> None:
        """No more leaves: a last run of fewer nodes, even of one, is complete."""
        for k in range(self.height):
            if self.open[k]:
                self._complete(k)
        self.root = self.open[self.height][0][0]


def steps(witness: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """(place in the run, siblings) of each step."""
    at = 0
    while at < len(witness):
        place, count = witness[at] % ARITY, witness[at] // ARITY
        yield place, [witness[at + 1 + 32 * j: at + 33 + 32 * j] for j in range(count)]
        at += 1 + 32 * count


def fold(leaf: bytes, witness: bytes) -> bytes:
    """The root recomputed from a leaf and its siblings."""
    for place, siblings in steps(witness):
        leaf = combine([*siblings[:place], leaf, *siblings[place:]])
    return leaf


def proof_digest(witness: bytes) -> bytes:
    """SHA-256 over the siblings of all steps (hexadecimal), upwards and from left to right."""
    return combine([s for _, siblings in steps(witness) for s in siblings])


def _blocks(batches, columns: tuple[str, ...]):
    """Runs of rows of one block, in order, as (g, block, {column: values})."""
    key, held = None, None
    for b in batches:
        got = [b.column(c).to_pylist() for c in columns]
        for row in zip(*got, strict=True):
            mine = (row[0], row[1])
            if mine != key:
                if held is not None:
                    yield key, held
                key, held = mine, []
            held.append(row[2:])
    if held is not None:
        yield key, held


def _by_block(nodes: DataFrame) -> DataFrame:
    """Whole blocks side by side in a partition, in order; a block is at most ARITY**levels rows and one head."""
    return nodes.repartition("g", "block").sortWithinPartitions("g", "block", "pos")


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096):
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _grown(rows: list[tuple], levels: int, witnesses: bool = True) -> Tree:
    """The closed tree of one block's rows (hash, n, ...)."""
    tree = Tree(levels_of(rows[0][1], levels), witnesses)
    for r in rows:
        tree.append(r[0])
    tree.close()
    return tree


_ROOTS = pa.schema([("g", pa.string()), ("pos", pa.int64()), ("h", pa.binary()), ("n", pa.int64())])


def block_roots(nodes: DataFrame, levels: int) -> DataFrame:
    """The nodes (g, pos, h, n) that the blocks of ``nodes`` become."""
    size = ARITY**levels

    def run(batches):
        def rows():
            for (g, block), held in _blocks(batches, ("g", "block", "h", "n")):
                yield g, block, _grown(held, levels, witnesses=False).root, -(-held[0][1] // size)
        yield from _batched(rows(), _ROOTS)

    cut = nodes.select("g", F.expr(f"pos div {size}").alias("block"), "pos", "h", "n")
    return _by_block(cut).mapInArrow(light(run), _NODE)


def extended(nodes: DataFrame, heads: DataFrame, levels: int, spec: str, finish) -> DataFrame:
    """Witnesses of ``nodes`` (g, pos, h, n and more columns): within their blocks,
    then extended by those of the blocks in ``heads`` (g, block, up, root).
    ``finish(g, row, witness, root)`` makes one row of the DDL schema ``spec``."""
    more = [c for c in nodes.columns if c not in ("g", "pos", "h", "n")]
    body = nodes.select("g", F.expr(f"pos div {ARITY**levels}").alias("block"), "pos", "h", "n", *more)
    types = dict(nodes.dtypes)
    # a block's head row stands before its nodes: its witness as h, the root in "root"
    top = heads.select("g", "block", F.lit(-1).cast("long").alias("pos"), F.col("up").alias("h"), F.lit(0).cast("long").alias("n"),
                       *[F.lit(None).cast(types[c]).alias(c) for c in more], "root")
    both = top.unionByName(body.withColumn("root", F.lit(None).cast("binary")))
    names = ("g", "block", "h", "n", "root", "pos", *more)
    arrow = to_arrow_schema(StructType.fromDDL(spec))

    def run(batches):
        def rows():
            for (g, _), held in _blocks(batches, names):
                up, root, held = held[0][0], held[0][2], held[1:]
                tree = _grown(held, levels)
                for r, w in zip(held, tree.witness, strict=True):
                    yield finish(g, r, bytes(w) + up, root)
        yield from _batched(rows(), arrow)

    return _by_block(both).mapInArrow(light(run), spec)


def _heads(nodes: DataFrame, levels: int, spark: SparkSession) -> DataFrame:
    """(g, block, up, root): each block's root, its witness up to the group's one
    node, and that node.  Further levels are appended as long as a group has more
    than one block."""
    roots = saved(block_roots(nodes, levels), spark)
    if (roots.agg(F.max("n")).first()[0] or 1) <= 1:
        return roots.select("g", F.col("pos").alias("block"), F.lit(b"").alias("up"), F.col("h").alias("root"))
    spec = "g string, block long, up binary, root binary"
    return saved(extended(roots, _heads(roots, levels, spark), levels, spec, lambda g, r, w, root: (g, r[3], w, root)), spark)


def placed(rows: DataFrame, order: Sequence[str], spark: SparkSession) -> DataFrame:
    """``rows`` (g and more) with pos, their place from 0 within g by the columns
    ``order``, and n, the rows of g.

    The rows are range-partitioned by (g, *order) and written so; a place is the
    place within the part plus the rows of g in the parts before.  Ties must not
    matter.  Nothing goes through one task but one row a part and group.
    """
    number = F.monotonically_increasing_id()
    ranged = rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    ranged = saved(ranged.withColumns({"__part": F.spark_partition_id(), "__at": number}), spark)
    parts = ranged.groupBy("g", "__part").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    group = Window.partitionBy("g")
    before = group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("g", "__part", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
                         F.sum("__n").over(group).alias("n"))
    at = F.col("__at") - F.col("__first") + F.col("__before")
    return ranged.join(parts, ["g", "__part"]).withColumn("pos", at.cast("long")).drop("__part", "__at", "__first", "__before")


def field(c: Column) -> Column:
    """A field of a leaf: '-' for null, else the UTF-8 byte count, ':' and the value."""
    text = c.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(columns: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group_col: str = "source", id_col: str = "doc_id",
             checked: dict[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per document: id_col, leaf, subroot, root, proof_sha256 (lowercase
    hex), folded_root and verified.

    ``checked`` replaces fields by expressions for the copy to be verified: its
    leaf is folded with the siblings of the stored rows, giving folded_root;
    verified says whether that is the root.  Without it the rows themselves are
    verified.

    Leaves are ordered by id (null first, equal ids by leaf hash; rows equal in
    all fields are interchangeable), groups by name (null first, then by UTF-8
    bytes).  A null field, an empty text and an empty group name are three
    different things.  Repeated rows are leaves of their own; an empty table has
    no rows.  Other columns are not read.  Texts may be of any length: each is
    hashed whole where it is read.
    """
    spark = docs.sparkSession
    have = [F.col(f) for f in fields]
    # g sorts null first, then by bytes: the empty string, or "s" and the name
    group = F.coalesce(F.concat(F.lit("s"), F.col(group_col).cast("string")), F.lit(""))
    leaves = docs.select(group.alias("g"), F.col(id_col).alias("__id"), leaf_hash(have).alias("h"),
                         leaf_hash([(checked or {}).get(f, F.col(f)) for f in fields]).alias("__seen"))
    # read once; the row number spreads equal rows over parts
    leaves = saved(leaves.withColumn("__row", F.monotonically_increasing_id()), spark)
    leaves = saved(placed(leaves, ("__id", "h", "__row"), spark).drop("__row"), spark)
    nodes = leaves.select("g", "pos", "h", "n")
    heads = _heads(nodes, levels, spark)
    tops = saved(heads.where("block = 0").select(F.col("g").alias("__name"), F.lit("").alias("g"), F.col("root").alias("h")), spark)
    tops = saved(placed(tops, ("__name",), spark), spark)
    spec = "g string, above binary, manifest_root binary"
    above = extended(tops, _heads(tops.select("g", "pos", "h", "n"), levels, spark), levels, spec, lambda g, r, w, root: (r[4], w, root))
    # the witness goes on above the group's root; both roots go along in one value
    heads = heads.join(above, "g").select("g", "block", F.concat("up", "above").alias("up"), F.concat("root", "manifest_root").alias("root"))
    id_type = dict(docs.dtypes)[id_col]
    out = (f"`{id_col}` {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")

    def finish(g, row, witness, roots):
        leaf, _, _, _, doc, seen = row
        subroot, root = roots[:32], roots[32:]
        folded = fold(seen, witness)
        return doc, leaf.hex(), subroot.hex(), root.hex(), proof_digest(witness).hex(), folded.hex(), folded == root

    return extended(leaves.select("g", "pos", "h", "n", "__id", "__seen"), heads, levels, out, finish)
