"""Keep the newest row per business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.session import ensure_checkpoint_dir

BRONZE_ORDER = ("ingestion_timestamp", "batch_id")
#: Most repeated hashes that are broadcast.
MAX_REPEATED = 2_000_000


def _as_list(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def dedupe_latest(df: DataFrame, keys: str | Sequence[str],
                  order_cols: Sequence[str] = BRONZE_ORDER) -> DataFrame:
    """One row per key: the largest ``order_cols`` wins, ties broken by every
    remaining column (descending, NULL smallest), so the result is fully
    deterministic even when copies share one ingestion timestamp.

    It is ``groupBy(keys).agg(max(struct))``: the partial aggregate collapses
    copies map-side, so a key holding a third of all rows still sends one row
    per map partition through the shuffle.
    """
    keys = _as_list(keys)
    order = [c for c in order_cols if c in df.columns]
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = order + rest
    if not ranked:
        return df.dropDuplicates(keys)
    latest = F.max(F.struct(*ranked)).alias("_latest")
    return df.groupBy(*keys).agg(latest).select(*keys, "_latest.*").select(*df.columns)


def dedupe_stored(df: DataFrame, keys: str | Sequence[str], order_cols: Sequence[str] = BRONZE_ORDER,
                  max_repeated: int = MAX_REPEATED) -> DataFrame:
    """The rows of ``dedupe_latest``, for a stored table most of whose keys occur once.

    A first job counts the keys by a 48-bit hash, so that 6 bytes a row are shuffled
    instead of the row.  A row whose hash occurs once is the only one of its key and
    passes as it is; only rows whose hash repeats (the copies, and the odd collision)
    are compared by key.  With more than ``max_repeated`` repeated hashes the whole
    table is.  ``df`` is read up to three times and must give the same keys each time.
    """
    keys = _as_list(keys)
    ensure_checkpoint_dir(df.sparkSession)
    hashed = F.shiftrightunsigned(F.xxhash64(*keys), 16)
    counted = df.select(hashed.alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    again = counted.where("_n > 1").select("_h").limit(max_repeated + 1).checkpoint(eager=True)
    n = again.count()
    if n == 0:
        return df
    if n > max_repeated:
        return dedupe_latest(df, keys, order_cols)
    tagged, again = df.withColumn("_h", hashed), F.broadcast(again)
    copies = tagged.join(again, "_h", "left_semi").select(*df.columns)
    return tagged.join(again, "_h", "left_anti").select(*df.columns).union(dedupe_latest(copies, keys, order_cols))


def duplicate_excess(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """One row: sum over keys of (copies - 1); 0 on empty input."""
    keys = _as_list(keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("failed_records"))


def duplicate_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their number of occurrences."""
    keys = _as_list(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1))
