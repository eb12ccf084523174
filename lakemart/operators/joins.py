"""Dimension joins with a checked broadcast.

The planner judges a table by the size of its files, which says little of its rows:
9 MB of repetitive Parquet held 1.2 million dimension rows, a broadcast of 170 MB.
So what may grow is broadcast by its number of rows, or not at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only when its measured row count is at most this.  The
# driver builds each broadcast whole: a string key and a value take some 140 bytes.
MAX_BROADCAST_ROWS = 1_000_000
# Packed in sets, a number and its value take some 22 bytes.
MAX_PACKED_ROWS = 8_000_000
#: Most broadcasts, one after the other, in place of one that is too large.
MAX_PASSES = 16
#: Numbers of a set.
SET = 32


def bounded(df: DataFrame, rows: int, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """A side of a join that the planner may broadcast, unless it has more than ``max_rows`` rows."""
    return df if rows <= max_rows else df.hint("merge")


def maybe_broadcast(dim: DataFrame, dim_rows: int | None, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast behind a measured size and never beyond it (a sort-merge join, whose
    skew AQE splits); without one, leave the choice to the planner and AQE."""
    if dim_rows is not None and dim_rows <= max_rows:
        return F.broadcast(dim)
    return dim if dim_rows is None else bounded(dim, dim_rows, max_rows)


def lookup(fact: DataFrame, dim: DataFrame, natural_key: str, cols: Sequence[str],
           how: str = "inner", dim_rows: int | None = None) -> DataFrame:
    """Replace nothing, add ``cols`` of the dimension row matching ``natural_key``.
    The dimension is projected to the needed columns before the join."""
    d = dim.select(F.col(natural_key).alias("__nk"), *cols)
    d = maybe_broadcast(d, dim_rows)
    return fact.join(d, F.col(natural_key) == F.col("__nk"), how).drop("__nk")


def packable(dim: DataFrame, key: Column, rows: int, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """``dim`` has too many rows to be broadcast as they are, but few enough in sets, and
    ``key``, a long, tells them apart."""
    return max_rows < rows <= MAX_PACKED_ROWS and dim.groupBy(key.alias("__k")).count().where("count > 1").isEmpty()


def packed_lookup(fact: DataFrame, dim: DataFrame, key: Column, dim_key: Column, value: str, n: int) -> DataFrame:
    """Add ``value`` of the row of ``dim`` whose ``dim_key`` equals ``key``, and ``__found``;
    both are longs, and ``dim`` has about ``n`` rows, unique by its own (``packable``)."""
    pairs = dim.select(dim_key.alias("__k"), F.col(value).alias("__v")).where("__k IS NOT NULL")
    sets = (pairs.groupBy(_set(F.xxhash64("__k"), n).alias("__set")).agg(F.collect_list(F.struct("__k", "__v")).alias("__s"))
            .select("__set", F.col("__s.__k").alias("__keys"), F.col("__s.__v").alias("__values")))
    at = F.coalesce(F.array_position("__keys", key), F.lit(0).cast("long"))
    placed = fact.withColumn("__set", _set(F.xxhash64(key), n)).join(F.broadcast(sets), "__set", "left")
    return placed.withColumns({value: F.get("__values", (at - 1).cast("int")), "__found": at > 0}).drop("__set", "__keys", "__values")


def passes(rows: int, max_rows: int = MAX_PACKED_ROWS) -> int:
    """Broadcasts of ``max_rows`` that a table of ``rows`` takes; 1, too, where they
    were more than ``MAX_PASSES``: the join then moves both sides."""
    n = -(-rows * 21 // (max_rows * 20)) if rows > max_rows else 1  # no pass has a few more
    return n if n <= MAX_PASSES else 1


def nth(df: DataFrame, key: str, i: int, n: int) -> DataFrame:
    """The rows of pass ``i`` of ``n``: equal keys of one type are in the same."""
    return df.where(F.pmod(F.xxhash64(key), F.lit(n)) == i)


def _set(hashed: Column, n: int) -> Column:
    """By bits other than those that ``nth`` deals by."""
    return F.pmod(F.shiftright(hashed, 20), F.lit(max(1, n // SET)))


def hash_sets(hashes: DataFrame, n: int) -> DataFrame:
    """``n`` distinct 64-bit hashes (one column) in sets of some 32, to be broadcast:
    some 11 bytes a hash, where a row for each takes 64."""
    col = hashes.columns[0]
    return hashes.groupBy(_set(F.col(col), n).alias("__set")).agg(F.collect_list(col).alias("__hashes"))


def flag_hashes(df: DataFrame, hashed: Column, sets: DataFrame, n: int, flag: str) -> DataFrame:
    """Add ``flag``: ``hashed`` is among the ``n`` hashes of ``sets`` (of ``hash_sets``)."""
    placed = df.withColumn("__set", _set(hashed, n))
    found = F.coalesce(F.array_contains("__hashes", hashed), F.lit(False))
    return placed.join(F.broadcast(sets), "__set", "left").withColumn(flag, found).drop("__set", "__hashes")
