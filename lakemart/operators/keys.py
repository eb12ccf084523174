"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.session import ensure_checkpoint_dir


def hash_key(*cols: str) -> Column:
    """Stable 64-bit key of natural-key columns; independent of partitioning."""
    return F.xxhash64(*[F.col(c) for c in cols])


def with_dense_key(df: DataFrame, order_cols: str | Sequence[str], key_name: str,
                   partitions: int | None = None) -> DataFrame:
    """Add ``key_name`` = 1..n in ``order_cols`` order (row_number over the
    whole table) without funnelling the table through one task.

    Rows are range-partitioned and sorted within partitions and tagged with
    (partition id, position); each partition's row count gives its offset (a
    table with one row per partition, so the broadcast is bounded by the
    partition count); the key is offset + position.  The tagged rows are
    checkpointed (reliable, to the shared ``spark.checkpoint.dir``) so the
    counting pass and the numbering pass read the very same rows: without it,
    column pruning gives each pass its own range exchange, each with its own
    sampled bounds.  ``order_cols`` must be unique.  The key is a BIGINT.
    """
    order = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    ensure_checkpoint_dir(spark)
    tagged = tagged.checkpoint(eager=True)
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    key = (F.col("_off") + F.col("_mid") - F.col("_first") + 1).cast("long")
    return (tagged.join(F.broadcast(offsets), "_pid")
            .select(key.alias(key_name), *df.columns))


class KeyRegistry:
    """Lasting surrogate keys: a stored table (``natural_key``, ``key_name``, batch)
    that only grows.  A member keeps the key of the batch that first had it; members
    that are new are numbered after the largest key, in the order of ``natural_key``.

    Each batch (0, 1, 2, ...) writes a folder of its own, numbered against the batches
    before it, so a batch that failed is run again with the same members and gives the
    same keys.  Null members get no key; repeated ones get one.
    """

    def __init__(self, spark: SparkSession, path: str, natural_key: str, key_name: str):
        self.spark, self.path, self.natural_key, self.key_name = spark, path, natural_key, key_name

    def keys(self) -> DataFrame:
        """All keys given so far."""
        return self.spark.read.option("basePath", self.path).parquet(self.path)

    def extend(self, members: DataFrame, batch: int) -> DataFrame:
        """Register the members of a batch; returns all keys up to it."""
        fresh = members.select(self.natural_key).where(F.col(self.natural_key).isNotNull()).distinct()
        top = None
        if batch:
            known = self.keys().where(F.col("batch") < batch)
            fresh = fresh.join(known.select(self.natural_key), self.natural_key, "left_anti")
            top = known.agg(F.coalesce(F.max(self.key_name), F.lit(0))).first()[0]
        numbered = with_dense_key(fresh, self.natural_key, self.key_name)
        numbered = numbered.select(self.natural_key, (F.col(self.key_name) + F.lit(top or 0)).cast("long").alias(self.key_name))
        numbered.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        return self.keys().where(F.col("batch") <= batch)


def with_row_number_key(df: DataFrame, order_cols: str | Sequence[str], key_name: str) -> DataFrame:
    """Plain ``row_number() over (order by ...)``: one task, for tiny tables only."""
    order = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    return df.select(F.row_number().over(Window.orderBy(*order)).alias(key_name), *df.columns)
