"""Range-clustered files and the table of their key ranges."""

import os

from pyspark.sql import functions as F

from lakemart.operators import skipping

KEYS, PARTS = ("store_key", "product_key"), ("year", "month")
LARGEST = {"store_key": 63, "product_key": 511}


def _rows(spark, hot=False):
    i = F.col("id")
    store = (i * 7919 % 64).cast("int") if not hot else F.when(i % 3 > 0, F.lit(5)).otherwise((i * 7919 % 64).cast("int"))
    product = (i * 104729 % 512).cast("int") if not hot else F.when(i % 3 > 0, F.lit(9)).otherwise((i * 104729 % 512).cast("int"))
    return spark.range(64_000).select((i % 2 + 2000).cast("int").alias("year"), (i % 4 + 1).cast("int").alias("month"),
                                      store.alias("store_key"), product.alias("product_key"), i.alias("sale"))


def _write(spark, path, df, file_rows=1000):
    skipping.ranged(df, LARGEST, PARTS, df.count(), "sale", file_rows).write.partitionBy(*PARTS).parquet(path)
    return skipping.file_ranges(spark.read.parquet(path), KEYS, PARTS)


def test_one_store_and_product_reads_few_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "fact")
    ranges = _write(spark, path, _rows(spark)).cache()
    total = ranges.count()
    assert total >= 60 and ranges.agg(F.sum("row_count")).first()[0] == 64_000
    where = {"store_key": (7, 7), "product_key": (100, 100), "year": (2001, 2001)}
    got = skipping.read_where(spark, path, ranges, where)
    assert 0 < len(got.inputFiles()) <= total // 10
    want = _rows(spark).where("store_key = 7 AND product_key = 100 AND year = 2001")
    assert sorted(map(tuple, got.select("sale", *KEYS, *PARTS).collect())) == sorted(map(tuple, want.select("sale", *KEYS, *PARTS).collect()))
    # a filter on one key alone skips as well, which a sort by the other key alone would not
    for one in ({"store_key": (7, 7)}, {"product_key": (100, 100)}):
        assert skipping.pick(ranges, one).count() <= total // 2


def test_files_of_a_partition_cover_disjoint_ranges_of_z(spark, tmp_dir):
    from lakemart.operators.layout import z_value
    path = os.path.join(tmp_dir, "fact")
    _write(spark, path, _rows(spark))
    z = z_value([F.shiftleft(F.col("store_key").cast("long"), 3), F.col("product_key")])
    t = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("f"))
    spans = t.groupBy("year", "month", "f").agg(F.min(z).alias("lo"), F.max(z).alias("hi")).collect()
    for part in {(r.year, r.month) for r in spans}:
        mine = sorted((r.lo, r.hi) for r in spans if (r.year, r.month) == part)
        assert len(mine) > 10 and all(a[1] <= b[0] for a, b in zip(mine, mine[1:]))


def test_a_hot_pair_of_keys_is_spread_over_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "fact")
    ranges = _write(spark, path, _rows(spark, hot=True))
    assert ranges.agg(F.max("row_count")).first()[0] < 4000  # two thirds of all rows share one pair
    got = skipping.read_where(spark, path, ranges, {"store_key": (5, 5), "product_key": (9, 9)})
    assert got.count() == _rows(spark, hot=True).where("store_key = 5 AND product_key = 9").count()


def test_no_file_many_files_and_nulls(spark, tmp_dir):
    path = os.path.join(tmp_dir, "fact")
    df = _rows(spark).limit(500).withColumn("store_key", F.when(F.col("sale") % 10 > 0, F.col("store_key")))
    skipping.ranged(df.na.fill(0, ["store_key"]), LARGEST, PARTS, 500, "sale", 50).select(
        F.when(F.col("store_key") > 0, F.col("store_key")).alias("store_key"), "product_key", "sale", *PARTS).write.partitionBy(*PARTS).parquet(path)
    ranges = skipping.file_ranges(spark.read.parquet(path), KEYS, PARTS)
    none = skipping.read_where(spark, path, ranges, {"store_key": (1000, 2000)})
    assert none.count() == 0 and "sale" in none.columns
    where = {"store_key": (1, 40)}
    few = skipping.read_where(spark, path, ranges, where)
    whole = skipping.read_where(spark, path, ranges, where, max_files=1)
    assert few.count() == whole.count() > 0


def test_the_pipeline_stores_ranges_and_reads_by_them(spark):
    from conftest import SF0001

    from lakemart.plans.pipeline import fixture_lake
    lake = fixture_lake(spark, SF0001)
    stats = lake._read("stats", "fact_sales")
    assert stats.agg(F.sum("row_count")).first()[0] == lake.fact_sales.count()
    got = lake.fact_where(store_key=(3, 3), year=(1997, 1997))
    assert len(got.inputFiles()) < len(lake.fact_sales.inputFiles())
    assert got.count() == lake.fact_sales.where("store_key = 3 AND year = 1997").count() > 0
