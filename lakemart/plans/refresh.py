"""Sums of the sales fact kept by month and refreshed by partition.

``MonthSums`` stores the additive measures of the fact by day and store, one
partition for each month, together with the version of the fact's files that each
month was read from.  A refresh lists the fact's files, reads only the months whose
files are others than noted, and takes the sums of all other months as they are.

Versions come from names, sizes and times of files, so no row is read to find the
months that changed, and whoever wrote them need not report it.  They are one row
a month, which is all that comes to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH = ("year", "month")
#: What one stored row is for, beside its month.
GRAIN = ("date_key", "store_key")
#: Measures of the fact whose sums add up.
ADDITIVE = ("net_sales", "gross_sales", "discount_amount", "tax_amount", "cost_amount", "profit", "quantity")
#: Months that a refresh names one by one in a filter or a list of folders.
MAX_MONTHS = 10_000


def file_versions(spark: SparkSession, path: str) -> DataFrame:
    """One row per month of a table partitioned by year and month: files, and a
    version that changes when a file is added, removed or replaced.  Contents of
    files are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    one = F.xxhash64("path", "length", "modificationTime")
    return (files.groupBy(*[F.col(c).cast("int").alias(c) for c in MONTH])
            .agg(F.count(F.lit(1)).alias("files"), F.bit_xor(one).alias("version")))


@dataclass
class MonthSums:
    """Month sums of the fact at ``fact_path``, stored below ``root``.

    Each refresh is a generation: the sums of changed months in folders of its own,
    then, as the last write, a list of all months with the generation that holds
    each.  A list counts only when it has all the rows it says it has, so a refresh
    that failed leaves the state before it, and is run again.  One writer at a time.
    Null stores and measures are kept as they are; the fact's year and month are never
    null; other columns of the fact are not read.
    """

    spark: SparkSession
    fact_path: str
    root: str
    _seen: dict[int, DataFrame] = field(default_factory=dict, repr=False)

    @property
    def _sums(self) -> str:
        return f"{self.root.rstrip('/')}/sums"

    def _list(self, generation: int) -> str:
        return f"{self.root.rstrip('/')}/months/gen={generation}"

    def refresh(self, generation: int) -> list[tuple[int, int]]:
        """Bring the sums up to date as generation 0, 1, 2, ...; returns the months
        that were read.  Months that are gone from the fact go.  A generation that
        is complete is not run again."""
        if self._complete(generation):
            return [(r["year"], r["month"]) for r in self.months(generation).where(F.col("generation") == generation).collect()]
        now = file_versions(self.spark, self.fact_path)
        if generation:
            if not self._complete(generation - 1):
                raise ValueError(f"generation {generation - 1} is not complete")
            noted = self.months(generation - 1).select(*MONTH, F.col("version").alias("_noted"), F.col("generation").alias("_held"),
                                                        F.col("empty").alias("_empty"))
            now = now.join(noted, list(MONTH), "left")
        else:
            now = now.withColumns({"_noted": F.lit(None).cast("long"), "_held": F.lit(None).cast("int"), "_empty": F.lit(False)})
        same = F.coalesce(F.col("version") == F.col("_noted"), F.lit(False))
        now = now.withColumn("generation", F.when(same, F.col("_held")).otherwise(F.lit(generation)))
        # one row a month: versions are those from before the fact is read, so a month
        # that is replaced meanwhile is read again by the next refresh
        found = [tuple(r) for r in now.select(*MONTH, "files", "version", "generation", (same & F.col("_empty")).alias("empty")).collect()]
        changed = sorted((y, m) for y, m, _, _, g, _ in found if g == generation)
        empty: set[tuple[int, int]] = set()  # changed months whose files hold no row
        if changed:
            fact = self.spark.read.parquet(self.fact_path).where(_in_months(changed))
            sums = fact.groupBy(*MONTH, *GRAIN).agg(F.count(F.lit(1)).alias("items"), *[F.sum(c).alias(c) for c in ADDITIVE])
            folder = f"{self._sums}/gen={generation}"
            (sums.repartition(*MONTH, "store_key").write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
             .partitionBy(*MONTH).parquet(folder))
            written = self.spark.read.schema(sums.schema).parquet(folder).select(*MONTH).distinct()
            empty = set(changed) - {tuple(r) for r in written.collect()}
        schema = "year int, month int, files long, version long, generation int, empty boolean, n int"
        n = len(found) + 1
        rows = [(y, m, files, v, g, was_empty or (y, m) in empty, n) for y, m, files, v, g, was_empty in found]
        rows.append((None, None, 0, 0, generation, True, n))
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(self._list(generation))
        self._seen.pop(generation, None)
        return changed

    def _stored(self, generation: int) -> DataFrame | None:
        from pyspark.errors import AnalysisException

        if generation not in self._seen:
            try:
                self._seen[generation] = self.spark.read.parquet(self._list(generation))
            except AnalysisException:  # no such folder, or nothing committed in it
                return None
        return self._seen[generation]

    def _complete(self, generation: int) -> bool:
        rows = self._stored(generation)
        if rows is None:
            return False
        got = rows.agg(F.count(F.lit(1)).alias("have"), F.max("n").alias("n")).first()
        return got["have"] > 0 and got["have"] == got["n"]

    def months(self, generation: int) -> DataFrame:
        """Month, files, version, the generation that holds its sums, and whether
        its files hold no row at all."""
        rows = self._stored(generation)
        if rows is None:
            raise ValueError(f"generation {generation} is not complete")
        return rows.where(F.col("year").isNotNull()).drop("n")

    def sums(self, generation: int) -> DataFrame:
        """Sums of all months as of a generation: year, month, generation that read
        them, GRAIN, items and ADDITIVE.  Reads only the folders that it names."""
        held = [(r["generation"], r["year"], r["month"]) for r in self.months(generation).where(~F.col("empty")).limit(MAX_MONTHS + 1).collect()]
        if len(held) > MAX_MONTHS:
            raise ValueError(f"more than {MAX_MONTHS} months")
        folders = [f"{self._sums}/gen={g}/year={y}/month={m}" for g, y, m in held]
        if folders:
            rows = self.spark.read.option("basePath", self._sums).parquet(*folders)
        else:
            fact = self.spark.read.parquet(self.fact_path).limit(0).withColumn("gen", F.lit(generation))
            rows = fact.groupBy("gen", *MONTH, *GRAIN).agg(F.count(F.lit(1)).alias("items"), *[F.sum(c).alias(c) for c in ADDITIVE])
        return rows.select(*MONTH, F.col("gen").cast("int").alias("generation"), *GRAIN, "items", *ADDITIVE)


def _in_months(months: list[tuple[int, int]]):
    """Partition filter on year and month."""
    if len(months) > MAX_MONTHS:
        raise ValueError(f"more than {MAX_MONTHS} months")
    by_year: dict[int, list[int]] = {}
    for y, m in months:
        by_year.setdefault(y, []).append(m)
    return reduce(lambda a, b: a | b, [(F.col("year") == y) & F.col("month").isin(ms) for y, ms in by_year.items()])


@dataclass
class SumsModel:
    """Stands for a star model where only sums of the fact by month, day or store
    are asked for: ``metrics``, ``timeintel`` and ``star`` run on it unchanged."""

    fact_sales: DataFrame
    base: object

    def __getattr__(self, name: str):
        if name.startswith("dim_"):
            return getattr(self.base, name)
        raise AttributeError(name)


def replace_months(rows: DataFrame, fact_path: str, by_month: bool = False) -> None:
    """Replace, in the fact, the months that ``rows`` holds; other months stay.
    ``rows`` must not be read from the fact itself.  Adaptive execution splits a
    month of many rows over several files, whatever key is hot in it.  Rows that
    are read from files of one month each (``by_month``) are not shuffled: each
    task writes what it reads."""
    if not by_month:
        rows = rows.hint("rebalance", *MONTH)
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy(*MONTH).parquet(fact_path))
