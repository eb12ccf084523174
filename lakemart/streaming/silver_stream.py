"""Silver and quarantine kept up to date by micro-batches.

State: for every table the latest bronze row of each key, in buckets by the hash
of the key.  A batch of new rows changes some buckets; only these are merged,
classified again and rewritten, into a folder of the batch's own, and a small
table of versions (one row per bucket) says which folder holds a bucket now.  So
nothing that a reader or a retry may need is overwritten: a batch that fails is
simply applied again.

A child's verdict depends on its parents.  The keys that became valid or stopped
being valid in a batch are compared with the foreign keys of the stored children,
and the buckets that hold such children are classified again too: orphans that
waited for their parent leave the quarantine, and children of a parent that is
now rejected enter it.  After any sequence of batches silver and quarantine are
those of one run over all bronze rows.
"""

from __future__ import annotations

import threading
from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakemart.operators import validate as V
from lakemart.operators.dedupe import dedupe_stored
from lakemart.operators.joins import MAX_PACKED_ROWS, bounded
from lakemart.plans import silver
from lakemart.plans.pipeline import STORED
from lakemart.plans.silver import SilverConfig
from lakemart.sources import schemas as S

#: Tables in the order of their dependencies, each with its parents: foreign key, table.
PARENTS: dict[str, tuple[tuple[str, str], ...]] = {
    "customers": (), "products": (), "stores": (),
    "orders": (("customer_id", "customers"),),
    "order_items": (("order_id", "orders"), ("product_id", "products")),
    "payments": (("order_id", "orders"),),
}
LAYERS = ("state", "silver", "quarantine")
BUCKET = "_bucket"
_VERSIONS = "layer string, table_name string, bucket int, batch long"


class IncrementalSilver:
    """Silver and quarantine under ``root`` (a shared folder), by batches of bronze rows.

    ``buckets`` bounds how finely a batch can touch a table, and the size of the
    table of versions (three rows a table and bucket).  Choose it so that a bucket
    is a few files' worth of rows.  One writer at a time; readers see whole batches.
    """

    def __init__(self, spark: SparkSession, root: str, cfg: SilverConfig = SilverConfig(), buckets: int = 64):
        self.spark, self.root, self.cfg, self.buckets = spark, root.rstrip("/"), cfg, buckets
        self._once = replace(cfg, deduplicated=True)  # state holds one row per key
        self._lock = threading.Lock()
        self.applied: int | None = None
        self.versions: dict[tuple[str, str, int], int] = {}

    # ----- stored tables ------------------------------------------------------

    def _folder(self, layer: str, table: str, batch: int) -> str:
        return f"{self.root}/{layer}/{table}/batch={batch:09d}"

    def _read(self, layer: str, table: str, buckets: set[int] | None = None) -> DataFrame | None:
        """The current rows of some (or all) buckets; None if there are none."""
        parts: dict[int, list[int]] = {}
        for (lay, t, b), batch in self.versions.items():
            if (lay, t) == (layer, table) and (buckets is None or b in buckets):
                parts.setdefault(batch, []).append(b)
        out = None
        for batch, mine in sorted(parts.items()):
            df = self.spark.read.parquet(self._folder(layer, table, batch)).filter(F.col(BUCKET).isin(sorted(mine)))
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
        return out

    def table(self, layer: str, table: str) -> DataFrame:
        """``layer`` is state, silver or quarantine."""
        df = self._read(layer, table)
        if df is None:
            raise LookupError(f"{layer}.{table} has no rows yet")
        return df.drop(BUCKET)

    def silver(self, table: str) -> DataFrame:
        return self.table("silver", table)

    def rejected(self, table: str) -> DataFrame:
        return self.table("quarantine", table)

    def restore(self) -> int | None:
        """Take up the versions of the last batch that was applied whole; its number, or None."""
        log = self.spark.read.schema("applied long, " + _VERSIONS).parquet(f"{self.root}/versions")
        self.applied = log.agg(F.max("applied")).first()[0]
        if self.applied is not None:
            rows = log.where((F.col("applied") == self.applied) & F.col("layer").isNotNull()).collect()  # three for each table and bucket
            self.versions = {(r.layer, r.table_name, r.bucket): r.batch for r in rows}
        return self.applied

    # ----- one batch ----------------------------------------------------------

    def _bucketed(self, df: DataFrame, table: str) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(S.KEYS[table]), F.lit(self.buckets)).cast("int"))

    def _write(self, df: DataFrame, layer: str, table: str, batch: int, changed: set[int]) -> None:
        """Rewrite the changed buckets; buckets without rows have no version."""
        path = self._folder(layer, table, batch)
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").options(**STORED).partitionBy(BUCKET).parquet(path)
        there = {r[0] for r in self.spark.read.schema(df.schema).parquet(path).select(BUCKET).distinct().collect()}
        for b in changed:
            if b in there:
                self.versions[layer, table, b] = batch
            else:
                self.versions.pop((layer, table, b), None)

    def _classify(self, table: str, latest: DataFrame) -> DataFrame:
        return self._classified(table, latest)[0]

    def _classified(self, table: str, latest: DataFrame) -> tuple[DataFrame, bool]:
        """The classified rows, and whether no row moves for it."""
        if table in ("customers", "products", "stores"):
            return getattr(silver, table)(latest, self._once), True
        # stored rows are checked against the keys that a parent lacks, or has, and only move where both are many
        parents, still = [], True
        for fk, parent in PARENTS[table]:
            keys = self._keys(parent)
            if self._read("silver", parent) is not None:
                keys = V.absent(latest, keys, fk, max_present=MAX_PACKED_ROWS)
                if not isinstance(keys, V.Absent):
                    keys, still = bounded(keys, keys.count()), False
            parents.append(keys)
        if table == "orders":
            return silver.orders(latest, *parents, self._once), still
        return getattr(silver, table)(latest, *parents, self._once), still

    def _keys(self, table: str, buckets: set[int] | None = None) -> DataFrame:
        """The valid keys of a table."""
        key = S.KEYS[table]
        df = self._read("silver", table, buckets)
        # known to be empty when it is planned: what is joined to it does not move
        return df.select(key) if df is not None else self.spark.range(0).where(F.lit(False)).select(F.lit(None).cast("string").alias(key))

    def _waiting(self, table: str, moved: Mapping[str, DataFrame]) -> set[int]:
        """Buckets with stored rows whose parent became valid or stopped being so."""
        found: set[int] = set()
        state = self._read("state", table)
        if state is None:
            return found
        for fk, parent in PARENTS[table]:
            if parent in moved:
                keys = moved[parent].select(F.col(S.KEYS[parent]).alias("_moved"))
                hit = state.join(keys, F.col(fk) == F.col("_moved"), "left_semi")
                found |= {r[0] for r in hit.select(BUCKET).distinct().collect()}  # at most ``buckets`` numbers
        return found

    def apply(self, batch: Mapping[str, DataFrame], number: int) -> bool:
        """Take in one batch of bronze rows by table; False if that number was
        applied before (a replay)."""
        with self._lock:
            if self.applied is not None and number <= self.applied:
                return False
            before, moved = dict(self.versions), {}
            try:
                for table in PARENTS:
                    self._apply_table(table, batch.get(table), number, moved)
            except BaseException:
                self.versions = before
                raise
            rows = [(number, *k, v) for k, v in sorted(self.versions.items())] or [(number, None, None, None, None)]
            (self.spark.createDataFrame(rows, "applied long, " + _VERSIONS).coalesce(1)
             .write.mode("append").parquet(f"{self.root}/versions"))
            self.applied = number
            return True

    def _apply_table(self, table: str, new: DataFrame | None, number: int, moved: dict[str, DataFrame]) -> None:
        own: set[int] = set()
        if new is not None:
            new = self._bucketed(new, table)
            own = {r[0] for r in new.select(BUCKET).distinct().collect()}
        changed = own | self._waiting(table, moved)
        if not changed:
            return
        old_keys = self._keys(table, changed)
        latest = self._read("state", table, changed)
        if own:
            latest = new if latest is None else latest.unionByName(new, allowMissingColumns=True)
            latest = dedupe_stored(latest.drop(BUCKET), S.KEYS[table], self.cfg.order_cols)
            self._write(self._bucketed(latest, table), "state", table, number, changed)
            latest = self._read("state", table, changed)
        latest = latest.drop(BUCKET)
        classified, still = self._classified(table, latest)
        if not still:
            work = f"{self.root}/work/{table}/batch={number:09d}"
            classified.write.mode("overwrite").options(**STORED).parquet(work)  # one evaluation of the joins feeds both outputs
            classified = self.spark.read.schema(classified.schema).parquet(work)
        self._write(self._bucketed(silver.silver_view(classified, table), table), "silver", table, number, changed)
        if table not in ("customers", "stores"):
            self._write(self._bucketed(V.rejected_rows(classified).select(*latest.columns, V.REASON), table), "quarantine", table, number, changed)
        if any(table == parent for ps in PARENTS.values() for _, parent in ps):
            now = self._keys(table, changed)
            both = old_keys.withColumn("_was", F.lit(1)).join(now.withColumn("_is", F.lit(1)), S.KEYS[table], "full")
            keys = both.where("_was IS NULL OR _is IS NULL").select(S.KEYS[table])
            path = f"{self.root}/moved/{table}/batch={number:09d}"
            keys.write.mode("overwrite").options(**STORED).parquet(path)
            moved[table] = self.spark.read.schema(keys.schema).parquet(path)


def silver_stream(inc: IncrementalSilver, bronze: Mapping[str, DataFrame], checkpoint_dir: str) -> list[StreamingQuery]:
    """Run the streaming bronze tables (``spark.readStream`` frames) through
    ``inc`` until everything that has arrived is taken in, one table after the
    other, parents first.  Numbers of batches go on from the last one applied;
    a batch that Spark repeats after a failure merges the same rows again, which
    changes nothing."""
    def take(table: str):
        def run(rows: DataFrame, _: int) -> None:
            inc.apply({table: rows}, 0 if inc.applied is None else inc.applied + 1)
        return run

    done = []
    for table in PARENTS:
        if table in bronze:
            q = (bronze[table].writeStream.foreachBatch(take(table)).option("checkpointLocation", f"{checkpoint_dir.rstrip('/')}/{table}")
                 .trigger(availableNow=True).start())
            q.awaitTermination()
            done.append(q)
    return done
