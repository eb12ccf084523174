"""Bronze ingestion: read a raw file set, tag every row, append.

Tagging adds ``ingestion_timestamp`` (one value per query), ``source_file``
and ``batch_id``.  Bronze tables are Parquet directories partitioned by
``batch_id``: appends never rewrite earlier batches, re-running the *same*
batch replaces only that batch (dynamic partition overwrite), and a batch
with extra columns is read back with ``mergeSchema``.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from lakemart.sources import schemas as S

METADATA = ["ingestion_timestamp", "source_file", "batch_id"]


def default_batch_id(now: datetime | None = None) -> str:
    """yyyyMMddHHmmss of the current UTC time (a driver-side literal)."""
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%d%H%M%S")


#: Bronze columns for what the declared types cannot hold.
CORRUPT, MALFORMED = "_corrupt_record", "_malformed_values"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def declared(df: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns in order and type, matched by name (absent ones
    NULL), then every other column as it is.  Values that a declared type
    cannot hold exactly stay as text in ``_malformed_values``, a JSON object by
    column (NULL when all values fit)."""
    have = {f.name.lower(): f for f in df.schema}
    cols, lost = [], []
    for f in schema:
        src = have.pop(f.name.lower(), None)
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        raw = F.col(_quoted(src.name))
        value = raw if src.dataType == f.dataType else raw.try_cast(f.dataType)
        cols.append(value.alias(f.name))
        if src.dataType != f.dataType:
            wide = raw.cast("string").try_cast("decimal(38,12)") if isinstance(f.dataType, DecimalType) else value
            lost.append(F.when(raw.isNotNull() & (value.isNull() | ~F.coalesce(wide == value, F.lit(False))),
                               raw.cast("string")).alias(f.name))
    cols += [F.col(_quoted(f.name)) for f in have.values()]
    if lost:
        cols.append(F.nullif(F.to_json(F.struct(*lost)), F.lit("{}")).alias(MALFORMED))
    return df.select(*cols)


def read_source(spark: SparkSession, path: str, fmt: str, schema: StructType | None = None,
                infer: bool = False) -> DataFrame:
    """CSV with a header, or Parquet with its own schema; a declared schema is
    matched by column name and loses nothing (see ``declared``).

    CSV columns beyond the declared ones arrive as strings, and a line whose
    number of fields differs from the header's is kept in ``_corrupt_record``.
    Files of one path whose headers differ raise an error: land them as
    separate batches.  ``infer`` (or no schema) takes Spark's inferred types.
    """
    if fmt != "csv":
        df = spark.read.option("mergeSchema", "true").format(fmt).load(path)
        return df if schema is None or infer else declared(df, schema)
    r = spark.read.option("header", "true")
    if schema is None or infer:
        return r.option("inferSchema", "true").csv(path)
    texts = r.csv(path).schema.add(CORRUPT, "string")
    r = r.option("enforceSchema", "false").option("columnNameOfCorruptRecord", CORRUPT)
    return declared(r.schema(texts).csv(path), schema)


def tag(df: DataFrame, source_file: str | None, batch_id: str, with_timestamp: bool = True) -> DataFrame:
    """Add the bronze metadata.  ``source_file=None`` takes the real file
    name of every row from the ``_metadata`` column."""
    src = F.lit(source_file) if source_file is not None else F.col("_metadata.file_name")
    cols = {"source_file": src, "batch_id": F.lit(batch_id)}
    if with_timestamp:
        cols = {"ingestion_timestamp": F.current_timestamp(), **cols}
    return df.withColumns(cols)


def append(df: DataFrame, target_dir: str) -> None:
    """Append one batch; only the written batch partition is replaced."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(target_dir))


def ingest_to_bronze(spark: SparkSession, source_path: str, fmt: str, target_dir: str, batch_id: str,
                     schema: StructType | None = None, infer: bool = False,
                     source_file: str | None = None):
    """Read, tag and append one source.  Returns an ``Observation`` whose
    ``get["rows"]`` is the ingested row count, counted while writing."""
    from pyspark.sql import Observation
    obs = Observation(f"bronze_{batch_id}")
    name = source_file if source_file is not None else source_path.rstrip("/").split("/")[-1]
    df = tag(read_source(spark, source_path, fmt, schema, infer), name, batch_id)
    append(df.observe(obs, F.count(F.lit(1)).alias("rows")), target_dir)
    return obs


def read_bronze(spark: SparkSession, bronze_dir: str) -> DataFrame:
    """All batches; columns added by later batches appear (NULL in older ones)."""
    return spark.read.option("mergeSchema", "true").parquet(bronze_dir)


def write_raw_files(raw: dict[str, DataFrame], landing_dir: str) -> dict[str, str]:
    """Land the raw tables as files (CSV for the three master-data sources,
    Parquet for the transactional ones).  Returns table -> path."""
    paths = {}
    for table, df in raw.items():
        fmt = S.FORMATS[table]
        path = f"{landing_dir.rstrip('/')}/{table}.{fmt}"
        w = df.write.mode("overwrite")
        (w.option("header", "true").csv(path) if fmt == "csv" else w.parquet(path))
        paths[table] = path
    return paths
