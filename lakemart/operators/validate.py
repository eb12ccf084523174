"""Validate-and-quarantine: ordered rejection rules and foreign-key checks.

A row is classified once into ``rejected_reason`` (NULL = valid); the first
failing rule wins.  Valid and rejected rows are two filters over that one
classified plan, so nothing can fall between them (a NULL value fails the
``null_<col>`` rule under the default policy instead of vanishing).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.operators.joins import bounded, flag_hashes, hash_sets
from lakemart.session import ensure_checkpoint_dir

REASON = "rejected_reason"
#: Most keys that a parent lacks which are broadcast; above FEW_KEYS by their hashes.
MAX_KEYS, FEW_KEYS = 2_000_000, 100_000


@dataclass(frozen=True)
class Rule:
    reason: str
    fails: Column  # TRUE -> the row is rejected with ``reason``


def first_failure(rules: Sequence[Rule]) -> Column:
    """CASE WHEN r1 THEN 'r1' WHEN r2 THEN 'r2' ... END (NULL if none fails)."""
    if not rules:
        return F.lit(None).cast("string")
    expr = F.when(rules[0].fails, F.lit(rules[0].reason))
    for r in rules[1:]:
        expr = expr.when(r.fails, F.lit(r.reason))
    return expr


def positive(col: str, reason: str, null_policy: str = "reject") -> list[Rule]:
    """``col > 0`` is valid.  ``null_policy="reject"`` quarantines NULLs with
    reason ``null_<col>``; ``"drop"`` lets them fall out of both outputs."""
    rules = []
    if null_policy == "reject":
        rules.append(Rule(f"null_{col}", F.col(col).isNull()))
    rules.append(Rule(reason, F.col(col) <= 0))
    return rules


def classify(df: DataFrame, rules: Sequence[Rule], drop_null_cols: Sequence[str] = ()) -> DataFrame:
    out = df.withColumn(REASON, first_failure(rules))
    for c in drop_null_cols:
        out = out.filter(F.col(c).isNotNull())
    return out


def valid_rows(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col(REASON).isNull()).drop(REASON)


def rejected_rows(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col(REASON).isNotNull())


def split(df: DataFrame, rules: Sequence[Rule], drop_null_cols: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    c = classify(df, rules, drop_null_cols)
    return valid_rows(c), rejected_rows(c)


def drop_cols_for(null_policy: str, *cols: str) -> tuple[str, ...]:
    return cols if null_policy == "drop" else ()


# ---------------------------------------------------------------------------
# Foreign keys
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Absent:
    """In place of a parent: the distinct keys of a child that the parent lacks (column
    ``key``), few enough to broadcast.  Holds for children with no other keys only."""
    keys: DataFrame
    key: str
    #: Their number, and sets of their hashes (``joins.hash_sets``) where no key of the parent has one of these.
    n: int = 0
    hashes: DataFrame | None = None
    #: The keys are those that the parent has.
    present: bool = False


def absent(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None,
           max_keys: int = MAX_KEYS, few_keys: int = FEW_KEYS,
           max_present: int = 0) -> Absent | DataFrame:
    """The child's keys that ``parent`` lacks, or the parent itself when they are more
    than ``max_keys``.

    A first job shuffles the distinct keys of both sides alone.  A check against what
    it found then moves no row of the child, so one evaluation can feed each output.
    More than ``few_keys`` of them are checked by 64-bit hashes, a tenth of their size.
    The check stays exact: a second pass over the parent sees that none of its keys has
    such a hash; if one does, the keys themselves are kept.  Where too many are lacking and the
    parent has ``max_present`` rows at most, it is checked by the hashes of its own keys, likewise exactly.
    """
    ensure_checkpoint_dir(child.sparkSession)
    keys = child.select(F.col(key).alias(key)).where(F.col(key).isNotNull()).distinct()
    there = parent.select(F.col(parent_key or key).alias("__pk"))
    rows = parent.count()
    lacking = keys.join(bounded(there, rows), F.col(key) == F.col("__pk"), "left_anti")
    gone = lacking.limit(max_keys + 1).checkpoint(eager=True)
    n = gone.count()
    if n > max_keys:
        if rows > max_present:
            return parent
        own = there.where("__pk IS NOT NULL").distinct().checkpoint(eager=True)
        hashes = hash_sets(own.select(F.xxhash64("__pk").alias("__h")), rows)
        unlike = flag_hashes(lacking, F.xxhash64(key), hashes, rows, "__like").where("__like").isEmpty()
        return Absent(own, "__pk", rows, hashes, present=True) if unlike else parent
    if n > few_keys:
        hashes = hash_sets(gone.select(F.xxhash64(key).alias("__h")), n)
        if flag_hashes(there, F.xxhash64("__pk"), hashes, n, "__like").where("__like AND __pk IS NOT NULL").isEmpty():
            return Absent(gone, key, n, hashes)
    return Absent(gone, key, n)


def fk_valid(child: DataFrame, parent: DataFrame | Absent, key: str, parent_key: str | None = None) -> DataFrame:
    """Children whose key exists in the parent (left semi; NULL never matches)."""
    if isinstance(parent, Absent):
        return with_parent(child, parent, key, "__there").filter("__there").drop("__there")
    pk = parent_key or key
    p = parent.select(F.col(pk).alias("__pk"))
    return child.join(p, F.col(key) == F.col("__pk"), "left_semi")


def fk_invalid(child: DataFrame, parent: DataFrame | Absent, key: str, parent_key: str | None = None) -> DataFrame:
    """Children whose key is missing from the parent (left anti; NULL key is a violation)."""
    if isinstance(parent, Absent):
        return with_parent(child, parent, key, "__there").filter(missing("__there")).drop("__there")
    pk = parent_key or key
    p = parent.select(F.col(pk).alias("__pk"))
    return child.join(p, F.col(key) == F.col("__pk"), "left_anti")


def parent_keys(parent: DataFrame, key: str, flag: str, parent_key: str | None = None) -> DataFrame:
    """Distinct parent keys (as ``__pk``) with a TRUE ``flag``: a left join to
    it never multiplies child rows, whatever the parent's duplicates.  The
    distinct is a partial (map-side) aggregate."""
    pk = parent_key or key
    return parent.select(F.col(pk).alias("__pk")).distinct().withColumn(flag, F.lit(True))


def with_parent(child: DataFrame, parent: DataFrame | Absent, key: str, flag: str,
                carry: Sequence[str] = (), parent_key: str | None = None, unique: bool = False) -> DataFrame:
    """Add ``flag`` (the parent row exists) and the parent columns ``carry``.

    Without ``carry`` the parent is reduced to its distinct keys first, unless
    it is ``unique`` on its key: then nothing stands between the shuffle and the
    join, so that a hot key of the child is split at run time.  With
    ``carry`` it is one left join to a parent that is unique on its key (a
    silver table): the same join validates the foreign key and brings along
    the parent attributes a later step needs, instead of a semi join now and
    an inner join later over the same shuffle keys.  NULL keys never match.
    With ``Absent`` in place of a parent there is nothing to carry.
    """
    if isinstance(parent, Absent) and parent.hashes is not None:
        known = flag_hashes(child, F.xxhash64(key), parent.hashes, parent.n, "__gone")
        there = F.col("__gone") if parent.present else ~F.col("__gone")
        return known.withColumn(flag, F.col(key).isNotNull() & there).drop("__gone")
    if isinstance(parent, Absent):
        gone = F.broadcast(parent.keys.select(F.col(parent.key).alias("__pk"), F.lit(True).alias("__gone")))
        there = F.col(key).isNotNull() & F.col("__gone").isNull()
        return child.join(gone, F.col(key) == F.col("__pk"), "left").withColumn(flag, there).drop("__pk", "__gone")
    pk = parent_key or key
    if not carry and not unique:
        p = parent_keys(parent, key, flag, pk)
        return child.join(p, F.col(key) == F.col("__pk"), "left").drop("__pk")
    p = parent.select(F.col(pk).alias("__pk"), *carry, F.lit(True).alias(flag))
    return child.join(p, F.col(key) == F.col("__pk"), "left").drop("__pk")


def missing(flag: str) -> Column:
    return ~F.coalesce(F.col(flag), F.lit(False))
