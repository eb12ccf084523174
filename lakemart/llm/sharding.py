"""Sharding by a two-pass external shuffle, with DataFrame functions only.

Pass one scatters records uniformly into buckets of bounded size by a seeded
hash.  Pass two shuffles each bucket in memory (Spark's shuffle() swaps in the
manner of Fisher and Yates) and lays the buckets end to end.  A record's place
in that order gives its shard and slot, so shards differ by one record at most.
Whole records move once, each bucket to a task of its own, which also writes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Records and bytes of records in a bucket, on average.
BUCKET_ROWS = 20_000
BUCKET_BYTES = 16 << 20
#: Buckets whose sizes are summed in one task.
GROUP = 1024


#: Names of the results and of columns used on the way.
NAMES = frozenset(("shard", "slot", "__bucket", "__record", "__records", "__first", "__pos", "__at"))


def renamed(records: DataFrame) -> DataFrame:
    """``records`` with an underscore after each column name that is one of NAMES
    (in any case), or several where that name is taken too."""
    taken = {c.lower() for c in records.columns}
    out = []
    for c in records.columns:
        new = c
        while new.lower() in NAMES or (new != c and new.lower() in taken):
            new += "_"
        taken.add(new.lower())
        out.append(new)
    return records.toDF(*out)


def _sizes(records: DataFrame) -> tuple[int, int]:
    """Rows, and their bytes in memory: strings and binaries as they are, other columns as eight."""
    own = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) if t in ("string", "binary") else F.lit(0) for c, t in records.dtypes]
    row = sum((x.cast("long") for x in own), F.lit(8 * (len(own) + 1)).cast("long"))
    n, size = records.agg(F.count("*"), F.sum(row)).first()
    return n, size or 0


def shuffled_shards(records: DataFrame, id_col: str, n_shards: int, seed: int = 7, record_bytes: int | None = None) -> DataFrame:
    """The columns of ``records`` with shard (0 to n_shards - 1) and slot
    (gapless from 0 in each shard), in shuffled order; shard sizes differ by
    one at most.

    ``record_bytes`` is the expected size of a record in memory; unless given,
    the strings and binaries are measured.  Every row is
    a record of its own, whatever its id: null and repeated ids and equal rows
    are scattered like others.  The order follows from the seed, the rows and
    the layout of the input.  Empty tables give no rows.  Columns named like
    the results come back as ``renamed`` names them.
    """
    records = renamed(records)
    columns = records.columns
    n, size = _sizes(records) if record_bytes is None else (k := records.count(), k * record_bytes)
    buckets = max(1, -(-n // BUCKET_ROWS), -(-size // BUCKET_BYTES))
    # every column enters, so that the input is evaluated alike for the sizes and for the records
    at = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), F.monotonically_increasing_id(), *columns), F.lit(buckets)).cast("int")
    scattered = records.select(at.alias("__bucket"), F.struct(*columns).alias("__record"))
    # one bucket a task, so that no task holds more
    full = (scattered.repartitionById(buckets, "__bucket")
            .groupBy("__bucket").agg(F.sort_array(F.collect_list("__record")).alias("__records")))
    size = scattered.groupBy("__bucket").agg(F.count("*").alias("__size"))
    # places before each bucket: within a group of buckets, and of the groups before
    grouped = size.withColumn("__group", F.floor(F.col("__bucket") / GROUP))
    groups = grouped.groupBy("__group").agg(F.sum("__size").alias("__sum"))
    before = Window.orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("__group", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__first"))
    inside = Window.partitionBy("__group").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = (grouped.withColumn("__in", F.coalesce(F.sum("__size").over(inside), F.lit(0))).join(groups, "__group")
             .select("__bucket", (F.col("__in") + F.col("__first")).alias("__first")))
    mixed = full.select("__bucket", F.shuffle("__records", seed).alias("__records"))
    placed = (mixed.join(F.broadcast(first), "__bucket")  # a row for each bucket
              .select("__first", F.posexplode("__records").alias("__pos", "__record"))
              .select((F.col("__first") + F.col("__pos")).alias("__at"), "__record.*"))
    small, larger = divmod(n, n_shards)
    edge = larger * (small + 1)
    shard = F.when(F.col("__at") < edge, F.floor(F.col("__at") / (small + 1))).otherwise(
        larger + F.floor((F.col("__at") - edge) / max(small, 1)))
    start = F.least(F.col("shard"), F.lit(larger)) * (small + 1) + F.greatest(F.col("shard") - larger, F.lit(0)) * small
    return (placed.withColumn("shard", shard.cast("int"))
            .select(*columns, "shard", (F.col("__at") - start).cast("long").alias("slot")))


def write_shards(records: DataFrame, path: str, id_col: str, n_shards: int, seed: int = 7, record_bytes: int | None = None) -> None:
    """Write whole records as Parquet with their slots, one folder per shard.
    Each file has the shard's records of one bucket in slot order, and the
    files follow each other by name."""
    (shuffled_shards(records, id_col, n_shards, seed, record_bytes)
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
