"""File skipping: range-clustered files and a stored table of their key ranges.

``ranged`` lays a table out so that each file of a partition value covers a
z-range of its own; ``file_ranges`` is the table of what each file holds (rows,
least and greatest value of each key); ``read_where`` picks files from it before
the scan and reads only those.  The table has one row per file, is filtered by
Spark, and only the names of the picked files come to the driver: beyond
``max_files`` of them, or without the table, the whole table is read and the
footers of its files do the skipping.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.layout import z_value

#: Rows of a file (about 128 MB of a sales fact).
FILE_ROWS = 2_000_000
#: Names of files that a query may bring to the driver.
MAX_FILES = 20_000


def ranged(df: DataFrame, cluster_cols: Mapping[str, int], partition_cols: Sequence[str] | Mapping[str, Column], rows: int, unique: str,
           file_rows: int = FILE_ROWS) -> DataFrame:
    """Rows range-partitioned by (partition columns, z of the cluster columns,
    ``unique``) and sorted so; write with ``partitionBy(*partition_cols)``.

    ``cluster_cols`` gives the largest value of each column (for dense keys, the
    rows of the dimension): keys are shifted to the same number of bits before
    their bits interleave, so that files are narrow in each of them.
    Partition columns given as expressions are added; they are computed again after the exchange.
    A range that crosses a partition value gives a file for each.  ``unique``, a
    column that tells rows apart, splits a pair of keys that holds many rows, or
    a partition value that holds most of them, over several files.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*partition_cols, "_z", unique]
    bits = {c: max(1, int(top).bit_length()) for c, top in cluster_cols.items()}
    wide = max(bits.values())
    z = z_value([F.shiftleft(F.col(c).cast("long"), wide - b) for c, b in bits.items()])
    # computed again after the exchange, which is cheaper than to shuffle it
    made = partition_cols if isinstance(partition_cols, Mapping) else {}
    parts = [made.get(c, F.col(c)) for c in partition_cols]
    ranges = df.repartitionByRange(max(least, -(-rows // file_rows)), *parts, z, F.col(unique))
    if made:
        ranges = ranges.withColumns(dict(made))
    return ranges.withColumn("_z", z).sortWithinPartitions(*order).drop("_z")


def file_ranges(table: DataFrame, keys: Sequence[str], partition_cols: Sequence[str] = ()) -> DataFrame:
    """One row per file of a stored table: file, the partition columns, row_count,
    and min_<key>, max_<key>.  One pass over the key columns alone; nulls are in no range."""
    bounds = [f(k).alias(f"{n}_{k}") for k in keys for n, f in (("min", F.min), ("max", F.max))]
    return (table.select(F.col("_metadata.file_path").alias("file"), *partition_cols, *keys)
            .groupBy("file", *partition_cols).agg(F.count(F.lit(1)).alias("row_count"), *bounds))


def _overlaps(ranges: DataFrame, where: Mapping[str, tuple]) -> Column:
    """Files that may hold a row with every column within its (low, high)."""
    tests = []
    for c, (lo, hi) in where.items():
        if f"min_{c}" in ranges.columns:
            tests.append((F.col(f"max_{c}") >= lo) & (F.col(f"min_{c}") <= hi))
        elif c in ranges.columns:
            tests.append(F.col(c).between(lo, hi))
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def pick(ranges: DataFrame, where: Mapping[str, tuple]) -> DataFrame:
    """The rows of ``file_ranges`` whose files ``where`` cannot rule out; columns
    it does not list rule out none."""
    return ranges.filter(_overlaps(ranges, where))


def read_where(spark: SparkSession, path: str, ranges: DataFrame, where: Mapping[str, tuple],
               max_files: int = MAX_FILES) -> DataFrame:
    """Rows of the table at ``path`` with every column of ``where`` within its
    (low, high), both included; reads only files that may hold some."""
    files = [r["file"] for r in pick(ranges, where).select("file").limit(max_files + 1).collect()]
    whole = spark.read.parquet(path)
    if not files:
        found = whole.limit(0)
    elif len(files) > max_files:
        found = whole
    else:
        found = spark.read.schema(whole.schema).option("basePath", path).parquet(*files)
    for c, (lo, hi) in where.items():
        found = found.filter(F.col(c).between(lo, hi))
    return found
