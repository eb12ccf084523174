"""Arrays of many small records as one binary value, and the scratch folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *[a.nbytes for a in arrays]], dtype=np.int64)
    return b"".join([head.tobytes(), *[np.ascontiguousarray(a).tobytes() for a in arrays]])


def unpack(blob: bytes, *dtypes) -> list[np.ndarray]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    sizes = np.frombuffer(blob, np.int64, n, 8).tolist()
    at, out = 8 * (n + 1), []
    for size, dtype in zip(sizes, dtypes, strict=True):
        dtype = np.dtype(dtype)
        out.append(np.frombuffer(blob, dtype, size // dtype.itemsize, at))
        at += size
    return out


def five_bytes(x: np.ndarray) -> np.ndarray:
    """The low 40 bits of 64-bit values, five bytes each."""
    return np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :5].reshape(-1)


def from_five_bytes(b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(b) // 5, 8), np.uint8)
    out[:, :5] = b.reshape(-1, 5)
    return out.view("<u8").reshape(-1)


def by_bucket(bucket: np.ndarray, n_buckets: int):
    """(bucket, positions) for each bucket that has any."""
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    for b in np.flatnonzero(np.diff(ends)):
        yield int(b), order[ends[b]: ends[b + 1]]


def text_buckets(docs: DataFrame, text_col: str, bytes_each: int = 1 << 23) -> int:
    """Number of buckets so that each has about ``bytes_each`` bytes of text,
    and at least as many as the session shuffles into."""
    total = docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("long"))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-total // bytes_each))


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir.  Only a local session without
    that setting gets a folder of this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not (spark.conf.get("spark.master", "") or "").startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "lakemart-checkpoints")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


_kept: list[str] | None = None


@contextlib.contextmanager
def noting(paths: list[str]):
    """Add the folders of tables that ``saved`` writes inside to ``paths``."""
    global _kept
    before, _kept = _kept, paths
    try:
        yield
    finally:
        _kept = before


def remove(paths: list[str], spark: SparkSession) -> None:
    """Delete scratch tables that nothing reads any more, on whatever store they are."""
    jvm = spark.sparkContext._jvm
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    paths.clear()


def saved(df: DataFrame, spark: SparkSession) -> DataFrame:
    """The rows written as a table in the scratch folder and read again."""
    path = scratch_folder(spark)
    if _kept is not None:
        _kept.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
