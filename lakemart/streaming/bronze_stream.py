"""Incremental bronze ingestion: a file-source stream over a landing folder.

New files are picked up exactly once (the stream checkpoint records them),
tagged like batch ingestion (``source_file`` is the real file name of each
row), and appended to the bronze folder.  ``trigger(availableNow=True)``
processes everything that has landed in bounded micro-batches and stops, so
the same code runs as a scheduled job or continuously.  Each micro-batch gets
its own ``batch_id`` partition, so a replayed micro-batch (after a failure)
rewrites only its own partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_landing(spark: SparkSession, landing_dir: str, fmt: str, schema: StructType,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        r = r.option("header", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(landing_dir)


def _append_batch(target_dir: str, batch_prefix: str):
    def write(batch: DataFrame, batch_no: int) -> None:
        # the query's id lives in its checkpoint: a new checkpoint counts from 0
        # again and must not replace the batches of an earlier query
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "query"
        bid = f"{batch_prefix}-{query[:8]}-{batch_no:06d}"
        tagged = batch.withColumns({
            "ingestion_timestamp": F.current_timestamp(),
            "source_file": F.col("_metadata.file_name"),
            "batch_id": F.lit(bid),
        })
        (tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(target_dir))
    return write


def ingest_stream(spark: SparkSession, landing_dir: str, fmt: str, schema: StructType, target_dir: str,
                  checkpoint_dir: str, batch_prefix: str = "stream",
                  max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the ingestion stream; with ``available_now`` it stops by itself
    once every landed file is in bronze (call ``awaitTermination``)."""
    src = read_landing(spark, landing_dir, fmt, schema, max_files_per_trigger)
    src = src.select("*", "_metadata")
    w = (src.writeStream.foreachBatch(_append_batch(target_dir, batch_prefix))
         .option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
