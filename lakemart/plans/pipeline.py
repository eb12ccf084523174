"""The pipeline runner: bronze -> silver (+ quarantine) -> gold, written to
storage.  This is the only module that writes.

Every layer is read back from storage before the next one uses it, so a later
layer never recomputes an earlier one and a lost executor only redoes the
current step.  The steps know the tables that they read (``Build``): ``run`` takes all of
them, and the fixture lakes only those that a table asked for is made from.  Foreign keys are checked against the keys that a parent lacks, so a
classification moves no rows and is evaluated for silver and for quarantine; where
too many keys are lacking it joins the parent, and is first written once to the
lake's ``work`` folder (inside the shared ``spark.checkpoint.dir`` for the
fixture lakes) and read back.  Dimension row counts are observed while
writing and drive the broadcast decision of the fact joins.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakemart.operators import skipping
from lakemart.operators import validate as V
from lakemart.operators.dedupe import dedupe_stored
from lakemart.operators.joins import bounded, nth, passes
from lakemart.plans import gold, silver
from lakemart.plans.model import FIXTURE_CONFIG, Tables
from lakemart.plans.silver import SilverConfig
from lakemart.session import ensure_checkpoint_dir, scratch_root
from lakemart.sources import schemas as S
from lakemart.sources import testdata

SOURCES = tuple(S.SOURCES)
#: Keys by which the fact's files are clustered, and whose ranges are stored.
FACT_CLUSTER = ("store_key", "product_key")
REJECTING = ("products", "orders", "order_items", "payments")
#: The silver table that each dimension is made from.
DIMENSIONS = {"dim_customer": "customers", "dim_product": "products", "dim_store": "stores", "dim_date": "orders"}


@dataclass
class Lake:
    """Folder layout of one lakehouse: <root>/<layer>/<table>."""
    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"


import logging
import time

LOG = logging.getLogger("lakemart.pipeline")
#: Ids and keys are stored as differences.
STORED = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}


def _write(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), count: bool = False) -> int | None:
    t0 = time.perf_counter()
    obs = None
    if count:
        obs = Observation(f"rows_{hashlib.md5(path.encode()).hexdigest()[:10]}")
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    # a full replace: partitions that the new rows lack go too
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static").options(**STORED)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    LOG.info("wrote %s in %.2fs", path, time.perf_counter() - t0)
    return int(obs.get["rows"]) if obs is not None else None


@dataclass
class StoredModel:
    """The layers of a written lake, read back from storage.  Exposes the same
    attributes as ``model.Model`` so every query runs on either."""
    spark: SparkSession
    lake: Lake
    dim_rows: dict[str, int] = field(default_factory=dict)
    #: The steps that write the tables, each run before its first read (None: all are written).
    build: Build | None = field(default=None, repr=False)
    _frames: dict[tuple[str, str], DataFrame] = field(default_factory=dict, repr=False)

    def _read(self, layer: str, table: str) -> DataFrame:
        """One resolved DataFrame per stored table (file listing and footer
        schema are read once, not on every use).  Tables are written once per
        run, before their first read."""
        if self.build is not None:
            self.build.need(f"{layer}/{table}")
        key = (layer, table)
        if key not in self._frames:
            self._frames[key] = self.spark.read.parquet(self.lake.path(layer, table))
        return self._frames[key]

    @property
    def bronze(self) -> Mapping[str, DataFrame]:
        return Tables(SOURCES, lambda t: self._read("bronze", t))

    def silver(self, table: str) -> DataFrame:
        return self._read("silver", table)

    def rejected(self, table: str) -> DataFrame:
        return self._read("quarantine", table)

    def fact_where(self, **ranges) -> DataFrame:
        """Fact rows with each column within its (low, high); reads only files
        whose stored key ranges overlap."""
        found = skipping.read_where(self.spark, self.lake.path("gold", "fact_sales"), self._read("stats", "fact_sales"), ranges)
        return found.select(*gold.FACT_COLUMNS)

    def __getattr__(self, name: str):
        if name.startswith("silver_") and name[7:] in S.SOURCES:
            return self.silver(name[7:])
        if name in ("dim_customer", "dim_product", "dim_store", "dim_date"):
            dim = self._read("gold", name)
            return bounded(dim, self.dim_rows.get(name, 0))
        if name == "fact_sales":
            return self._read("gold", "fact_sales").select(*gold.FACT_COLUMNS)
        raise AttributeError(name)


def ingest_landing(spark: SparkSession, landing: dict[str, str], lake: Lake, batch_id: str | None = None,
                   infer_csv: bool = False) -> dict[str, int]:
    """Bronze step of the file path: read each landed source (CSV with header
    and declared schema, or Parquet), tag it and append it as one batch.
    Returns the ingested row count per table (counted while writing)."""
    from lakemart.sources import bronze as B
    bid = batch_id or B.default_batch_id()
    counts = {}
    for t, path in landing.items():
        obs = B.ingest_to_bronze(spark, path, S.FORMATS[t], lake.path("bronze", t), bid,
                                 schema=S.SOURCES[t], infer=infer_csv and S.FORMATS[t] == "csv",
                                 source_file=f"{t}.{S.FORMATS[t]}")
        counts[t] = int(obs.get["rows"])
    return counts


def read_bronze_lake(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """All batches of every bronze table (schema drift merged)."""
    from lakemart.sources import bronze as B
    return {t: B.read_bronze(spark, lake.path("bronze", t)) for t in SOURCES}


def _parallel(*steps):
    """Run independent steps as concurrent Spark jobs (one driver thread each)
    and return their results in order; the first failure is re-raised."""
    if len(steps) == 1:
        return [steps[0]()]
    with ThreadPoolExecutor(max_workers=len(steps)) as ex:
        futures = [ex.submit(f) for f in steps]
        return [f.result() for f in futures]


class Build:
    """The steps that write a lake, named ``<layer>/<table>``.  A step runs once, after
    the steps whose tables it reads, so a single table costs its own layers alone;
    threads that need one step wait for one run of it.  A step that failed runs again
    (each replaces what it writes).  Quarantine is written with silver, the file ranges
    with the fact.

    ``bronze`` gives the raw tables; without ``write_bronze``, those of the lake."""

    def __init__(self, spark: SparkSession, bronze: Mapping[str, DataFrame], lake: Lake, cfg: SilverConfig,
                 write_bronze: bool = True, cluster_fact: bool = True):
        ensure_checkpoint_dir(spark)
        self.spark, self.raw, self.lake = spark, bronze, lake
        self.cfg, self.once = cfg, replace(cfg, deduplicated=True)
        self.write_bronze, self.cluster_fact = write_bronze, cluster_fact
        self.model = StoredModel(spark, lake, build=self)
        self.steps = {f"bronze/{t}": partial(self._bronze, t) for t in SOURCES}
        self.steps |= {f"silver/{t}": getattr(self, f"_silver_{t}") for t in SOURCES}
        self.steps |= {f"gold/{n}": partial(self._dim, n) for n in DIMENSIONS}
        self.steps |= {"gold/fact_sales": self._fact, "quality/data_quality_results": self._quality}
        #: Tables that another one's step writes.
        self.beside = {f"quarantine/{t}": f"silver/{t}" for t in REJECTING} | {"stats/fact_sales": "gold/fact_sales"}
        self.done: set[str] = set()
        self._locks = {s: threading.Lock() for s in self.steps}

    def need(self, *tables: str) -> None:
        """Write those tables that are not written yet, as concurrent jobs."""
        steps = {self.beside.get(t, t) for t in tables}
        waiting = sorted(s for s in steps if s in self.steps and s not in self.done)
        if waiting:
            _parallel(*[partial(self._once, s) for s in waiting])

    def _once(self, step: str) -> None:
        with self._locks[step]:
            if step not in self.done:
                self.steps[step]()
                self.done.add(step)

    def all(self, quality: bool = True) -> StoredModel:
        """Every table.  Steps without a dependency between them (the six landings;
        customers, stores and products; the four dimensions; items and payments; the fact
        and the DQ result) run as concurrent jobs, so small tables do not leave the
        cluster idle while a large one finishes."""
        self.need(*[f"bronze/{t}" for t in SOURCES])
        self.need("silver/customers", "silver/stores", "silver/products")
        self.need("silver/orders")
        self.need(*[f"gold/{n}" for n in DIMENSIONS])
        self.need("silver/order_items", "silver/payments")
        self.need("gold/fact_sales", *(["quality/data_quality_results"] if quality else []))
        return self.model

    def _bronze(self, table: str) -> None:
        # Each task writes what it reads: no shuffle, and no task of a hot key.
        if self.write_bronze:
            _write(self.raw[table], self.lake.path("bronze", table))

    def _landed(self, table: str) -> DataFrame:
        return self.model.bronze[table] if self.write_bronze else self.raw[table]

    def _stage(self, table: str, df: DataFrame) -> DataFrame:
        """Cut lineage: write once to the lake's work folder, read back."""
        _write(df, self.lake.path("work", table))
        return self.spark.read.parquet(self.lake.path("work", table))

    def _land(self, table: str, build, *fks: tuple[DataFrame, str]) -> None:
        landed, path = self._landed(table), self.lake.path
        # one bronze row per key; only rows of repeated keys are shuffled for it
        one = dedupe_stored(landed, S.KEYS[table], self.cfg.order_cols)
        parents = [V.absent(landed, parent, key) for parent, key in fks]
        classified = build(one, *parents)
        if table in REJECTING:
            if not all(isinstance(p, V.Absent) for p in parents):
                classified = self._stage(table, classified)  # one evaluation of the joins feeds both outputs
            _parallel(lambda: _write(silver.rejected_view(classified, landed.columns), path("quarantine", table)),
                      lambda: _write(silver.silver_view(classified, table), path("silver", table)))
        else:
            _write(silver.silver_view(classified, table), path("silver", table))

    def _silver_customers(self) -> None:
        self._land("customers", lambda d: silver.customers(d, self.once))

    def _silver_stores(self) -> None:
        self._land("stores", lambda d: silver.stores(d, self.once))

    def _silver_products(self) -> None:
        self._land("products", lambda d: silver.products(d, self.once))

    def _silver_orders(self) -> None:
        st = self.model
        self.need("bronze/orders", "silver/customers", *(["silver/stores"] if self.cfg.validate_store else []))
        self._land("orders", lambda d, *parents: silver.orders(d, parents[0], self.once, *parents[1:]), (st.silver_customers, "customer_id"),
                   *([(st.silver_stores, "store_id")] if self.cfg.validate_store else []))

    def _silver_order_items(self) -> None:
        st = self.model
        self.need("bronze/order_items", "silver/orders", "silver/products")
        self._land("order_items", lambda d, o, p: silver.order_items(d, o, p, self.once),
                   (st.silver_orders, "order_id"), (st.silver_products, "product_id"))

    def _silver_payments(self) -> None:
        self.need("bronze/payments", "silver/orders")
        self._land("payments", lambda d, o: silver.payments(d, o, self.once), (self.model.silver_orders, "order_id"))

    def _dim(self, name: str) -> None:
        """Counted while written, before the item-grain work."""
        frame = getattr(gold, name)(self.model.silver(DIMENSIONS[name]))
        self.model.dim_rows[name] = _write(frame, self.lake.path("gold", name), count=True)

    def _fact(self) -> None:
        st, path = self.model, self.lake.path
        self.need("silver/order_items", *[f"gold/{n}" for n in DIMENSIONS])
        rows = st.dim_rows
        order_keys = gold.order_keys(st.silver_orders, st.dim_customer, st.dim_store, st.dim_date, rows)
        f = gold.fact_input(gold.keyed_items(self._product_items(rows["dim_product"]), order_keys))
        if self.cluster_fact:
            keys = dict(zip(FACT_CLUSTER, (rows["dim_store"], rows["dim_product"])))  # dense keys: the largest is the count
            # the row count comes from the footers of the silver table; the bounds of the
            # ranges and the ranges read one shuffle of the join
            f = skipping.ranged(f.select(*gold.FACT_INPUT), keys, gold.month_columns(), st.silver_order_items.count(), "order_item_id")
        # amounts are computed after the rows are laid out: fewer columns are shuffled
        _write(gold.fact_measures(f), path("gold", "fact_sales"), partition_by=("year", "month"))
        if self.cluster_fact:
            stored = self.spark.read.parquet(path("gold", "fact_sales"))
            _write(skipping.file_ranges(stored, FACT_CLUSTER, ("year", "month")).coalesce(1), path("stats", "fact_sales"))

    def _product_items(self, product_rows: int) -> DataFrame:
        """Items with the keys of their products.  Where these are too many for one broadcast in sets,
        in passes that move no item, each written to the lake's work folder."""
        items, products, n = self.model.silver_order_items, self.model.dim_product, passes(product_rows)
        if n == 1:
            return gold.product_items(items, products, product_rows)
        path = self.lake.path("work", "product_items")
        for i in range(n):
            _write(gold.product_items(nth(items, "product_id", i, n), nth(products, "product_id", i, n), product_rows // n), f"{path}/pass={i}")
        return self.spark.read.parquet(path).drop("pass")

    def _quality(self) -> None:
        from lakemart.plans import dq
        self.need(*[f"silver/{t}" for t in dq.TABLES])
        _write(dq.dq_summary(self.model).coalesce(1), self.lake.path("quality", "data_quality_results"))


def run(spark: SparkSession, bronze: Mapping[str, DataFrame], lake: Lake, cfg: SilverConfig = SilverConfig(),
        write_bronze: bool = True, cluster_fact: bool = True, quality: bool = True) -> StoredModel:
    """Run silver and gold over ``bronze`` frames; returns the stored model.
    With ``quality`` the 28-row DQ result (bronze vs silver) is written to
    ``<lake>/quality/data_quality_results``."""
    st = Build(spark, bronze, lake, cfg, write_bronze, cluster_fact).all(quality)
    st.build = None
    return st


# ----- materialised fixture lakes -------------------------------------------------

_LAKES: dict[tuple[str, str], StoredModel] = {}
_LAKES_LOCK = threading.Lock()
_DONE = "_LAKE_COMPLETE"


def _code_hash() -> str:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.md5()
    for d, _, files in sorted(os.walk(root)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(d, f), "rb") as fh:
                    h.update(fh.read())
    return h.hexdigest()[:12]


def _fingerprint(spark: SparkSession, sf_dir: str) -> tuple[str, bool]:
    """Key of a fixture lake: input files + library code.  Reusable across
    applications only on a local path; elsewhere the application id is added."""
    parts = [os.path.abspath(sf_dir), _code_hash()]
    local = "://" not in sf_dir and os.path.isdir(sf_dir)
    if local:
        for t in testdata.TPCH_TABLES:
            st_ = os.stat(os.path.join(sf_dir, f"{t}.parquet"))
            parts.append(f"{t}:{st_.st_size}:{int(st_.st_mtime)}")
    else:
        parts.append(spark.sparkContext.applicationId)
    return hashlib.md5("|".join(parts).encode()).hexdigest()[:16], local


def fixture_lake(spark: SparkSession, sf_dir: str, reuse: bool = True) -> StoredModel:
    """The lake of a test-data folder with all its tables, built by the pipeline in the
    shared scratch folder.  A finished build (marked complete) is reused by later calls
    and, on a local folder, by later applications; every build writes to its own folder,
    so concurrent builders never share files.  ``reuse=False`` always builds (the bench
    times a full pipeline run).  Thread-safe: concurrent callers wait for one build."""
    st = lake_on_demand(spark, sf_dir, reuse)
    with _LAKES_LOCK:
        if st.build is not None:
            st.build.all()
            st.build = None
            base = os.path.dirname(st.lake.root)
            if _fingerprint(spark, sf_dir)[1] and "://" not in base:
                with open(os.path.join(st.lake.root, _DONE), "w") as fh:
                    fh.write("\n".join(f"{k}={v}" for k, v in st.dim_rows.items()))
    return st


def lake_on_demand(spark: SparkSession, sf_dir: str, reuse: bool = True) -> StoredModel:
    """The lake of ``fixture_lake``, of which a table is written when it is first read,
    with the tables that it is made from: a question about one table does not build the
    others.  A finished lake is reused as it is; an unfinished one belongs to its
    application, whose calls share it."""
    key, reusable = _fingerprint(spark, sf_dir)
    # a model holds DataFrames: it lives as long as its session's application
    mine = (spark.sparkContext.applicationId, key)
    root = scratch_root(spark)
    # markers are plain files: cross-application reuse only on a local root
    reusable = reusable and "://" not in root
    base = f"{root}/{key}"
    with _LAKES_LOCK:
        if reuse and mine in _LAKES:
            return _LAKES[mine]
        if reuse and reusable and os.path.isdir(base):
            for build in sorted(os.listdir(base)):
                marker = os.path.join(base, build, _DONE)
                if os.path.exists(marker):
                    with open(marker) as fh:
                        rows = {k: int(v) for k, v in (ln.split("=") for ln in fh.read().split())}
                    _LAKES[mine] = StoredModel(spark, Lake(os.path.join(base, build)), rows)
                    return _LAKES[mine]
        lake = Lake(f"{base}/{os.getpid()}-{uuid.uuid4().hex[:8]}")
        raw = Tables(SOURCES, testdata.staged(spark, sf_dir, lake.path("work", "orders_base")))
        _LAKES[mine] = Build(spark, raw, lake, FIXTURE_CONFIG).model
        return _LAKES[mine]
