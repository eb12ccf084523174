"""Month sums refreshed by partition."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemart.plans import refresh
from lakemart.plans.refresh import MonthSums


def _fact(spark, days=360, net=1):
    i = F.col("id")
    money = [F.lit(net).cast("decimal(18,2)").alias(c) for c in refresh.ADDITIVE[:-1]]
    month = (i % 12 + 1).cast("int")
    return spark.range(days * 20).select(
        (2000 + i % 3).cast("int").alias("year"), month.alias("month"), (20000000 + month * 100 + i % 28).cast("int").alias("date_key"),
        (i % 7).cast("int").alias("store_key"), (i % 11).cast("int").alias("product_key"), F.lit(2).alias("quantity"), *money)


def _store(spark, tmp_dir, rows=None):
    path = os.path.join(tmp_dir, "fact")
    (rows if rows is not None else _fact(spark)).write.partitionBy("year", "month").parquet(path)
    return MonthSums(spark, path, os.path.join(tmp_dir, "sums"))


def _plain(spark, path):
    fact = spark.read.parquet(path)
    rows = fact.groupBy("year", "month", "date_key", "store_key").agg(F.count("*"), *[F.sum(c) for c in refresh.ADDITIVE])
    return sorted(map(tuple, rows.collect()))


def _got(store, generation):
    return sorted(map(tuple, store.sums(generation).drop("generation").collect()))


def test_one_touched_month_is_the_only_one_read(spark, tmp_dir, monkeypatch):
    store = _store(spark, tmp_dir)
    first = store.refresh(0)
    assert len(first) == 12 and _got(store, 0) == _plain(spark, store.fact_path)
    assert store.refresh(1) == []  # nothing changed: nothing is read
    touched = spark.read.parquet(store.fact_path).where("year = 2001 AND month = 2").withColumn("net_sales", F.lit(Decimal("5.00")))
    rows = spark.createDataFrame(touched.collect(), touched.schema)
    refresh.replace_months(rows, store.fact_path)
    read = []
    plain = refresh._in_months
    monkeypatch.setattr(refresh, "_in_months", lambda months: read.append(months) or plain(months))
    assert store.refresh(2) == [(2001, 2)] and read == [[(2001, 2)]]
    assert _got(store, 2) == _plain(spark, store.fact_path)
    held = {(r.year, r.month): r.generation for r in store.months(2).collect()}
    assert held[2001, 2] == 2 and set(held.values()) == {0, 2} and list(held.values()).count(2) == 1
    # sums of another generation stay as they were
    assert _got(store, 1) == _got(store, 0) != _got(store, 2)


def test_only_files_of_changed_months_are_scanned(spark, tmp_dir):
    store = _store(spark, tmp_dir)
    scan = spark.read.parquet(store.fact_path).where(refresh._in_months([(2001, 2)]))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "PushedFilters: []" in plan
    used = {r.file for r in scan.select(F.col("_metadata.file_path").alias("file")).distinct().collect()}
    assert used and all("year=2001/month=2/" in f for f in used)
    versions = refresh.file_versions(spark, store.fact_path)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in versions.split("ReadSchema:")[1].split("\n")[0]


def test_new_and_gone_months(spark, tmp_dir):
    store = _store(spark, tmp_dir)
    store.refresh(0)
    late = _fact(spark, days=30).where("year = 2001 AND month = 2").withColumns({"year": F.lit(2003), "month": F.lit(1)})
    late.write.mode("append").partitionBy("year", "month").parquet(store.fact_path)
    # rows appended to a month change it as well
    _fact(spark, days=30).where("year = 2002 AND month = 3").write.mode("append").partitionBy("year", "month").parquet(store.fact_path)
    assert store.refresh(1) == [(2002, 3), (2003, 1)]
    assert _got(store, 1) == _plain(spark, store.fact_path)
    fewer = spark.createDataFrame(spark.read.parquet(store.fact_path).where("year = 2000").collect(), spark.read.parquet(store.fact_path).schema)
    fewer.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("year", "month").parquet(store.fact_path)
    store.refresh(2)
    assert {r.year for r in store.sums(2).select("year").distinct().collect()} == {2000}
    assert _got(store, 2) == _plain(spark, store.fact_path)


def test_a_refresh_that_failed_leaves_the_state_before_it(spark, tmp_dir, monkeypatch):
    store = _store(spark, tmp_dir)
    store.refresh(0)
    before = _got(store, 0)
    refresh.replace_months(_fact(spark, net=3).where("year = 2001 AND month = 2"), store.fact_path)
    whole = MonthSums._list

    def stop(self, generation):
        # called once to see whether the generation is there, then to write its list
        stop.calls += 1
        if stop.calls > 1 and generation == 1:
            raise OSError("lost")
        return whole(self, generation)

    stop.calls = 0
    monkeypatch.setattr(MonthSums, "_list", stop)
    with pytest.raises(OSError):
        store.refresh(1)
    monkeypatch.setattr(MonthSums, "_list", whole)
    again = MonthSums(spark, store.fact_path, store.root)
    assert _got(again, 0) == before
    with pytest.raises(ValueError):
        again.refresh(2)
    assert again.refresh(1) == [(2001, 2)] == again.refresh(1)  # a complete one is not run again
    assert _got(again, 1) == _plain(spark, store.fact_path)


def test_nulls_hot_store_and_empty_fact(spark, tmp_dir):
    hot = _fact(spark).withColumns({"store_key": F.when(F.col("product_key") < 8, F.lit(1)).otherwise(F.col("store_key")),
                                    "net_sales": F.when(F.col("product_key") > 2, F.col("net_sales"))})
    store = _store(spark, os.path.join(tmp_dir, "hot"), hot)
    store.refresh(0)
    none = lambda rows: sorted([tuple((x is None, x or 0) for x in r) for r in rows])
    assert none(_got(store, 0)) == none(_plain(spark, store.fact_path))
    # an empty table written in partitions holds no file at all: no month
    empty = MonthSums(spark, store.fact_path, os.path.join(tmp_dir, "empty-sums"))
    gone = os.path.join(tmp_dir, "unpartitioned")
    _fact(spark).limit(0).write.parquet(gone + "/year=2000/month=1")
    empty.fact_path = gone
    empty.refresh(0)
    assert empty.sums(0).count() == 0
