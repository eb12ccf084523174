"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on.  ANSI mode stays on (Spark 4 default); every
# ratio is guarded with try_divide / nullif instead.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Keep the driver's status store small for long sessions of many queries.
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
}


def build_session(master: str = "local[8]", app: str = "lakemart",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session used by tests and the bench.  On a cluster, pass the
    cluster's own session to the library functions instead."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None under Spark Connect (no driver-side context)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it; only when it is unset (local tests) do we use a folder
    under the local temp directory.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not d and sc is not None:
        d = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not d and not (spark.conf.get("spark.master", "") or "").startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: a cluster must name a folder that all executors share")
    if not d:
        # Unset (local runs and tests only): a stable folder under the local
        # temp directory.  On a cluster the session names a shared folder.
        d = os.path.join(tempfile.gettempdir(), "lakemart-checkpoints")
        os.makedirs(d, exist_ok=True)
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None:
        try:
            sc.setCheckpointDir(d)
        except Exception:  # noqa: BLE001
            pass
    return d


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables written to cut lineage."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, "lakemart-tables") if "://" not in base else base.rstrip("/") + "/lakemart-tables"
    return path
