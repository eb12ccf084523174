"""Layout operators: partitioned rebalanced writes and z-order clustering."""

import os

from pyspark.sql import functions as F

from lakemart.operators.layout import clustered, write_partitioned


def _rows(spark):
    return spark.range(20000).select((F.col("id") % 3 + 2000).alias("year"), (F.col("id") % 12 + 1).alias("month"),
                                     (F.col("id") * 7 % 500).alias("store_key"),
                                     (F.col("id") * 13 % 900).alias("product_key"), "id")


def test_write_partitioned_is_whole(spark, tmp_dir):
    path = os.path.join(tmp_dir, "fact")
    write_partitioned(_rows(spark), path, ["year", "month"])
    back = spark.read.parquet(path)
    assert back.count() == 20000 and len(os.listdir(path)) >= 3
    assert back.filter("year = 2001 AND month = 5").count() == _rows(spark).filter("year = 2001 AND month = 5").count()


def test_range_clustering_gives_disjoint_z_ranges(spark):
    from lakemart.operators.layout import z_value
    df = clustered(_rows(spark), ["store_key", "product_key"], mode="range", files=4)
    z = df.select(F.spark_partition_id().alias("p"), z_value(["store_key", "product_key"]).alias("z"))
    spans = sorted((r.lo, r.hi) for r in z.groupBy("p").agg(F.min("z").alias("lo"), F.max("z").alias("hi")).collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # each file covers its own z-range
    assert df.count() == 20000
    # rebalance mode keeps every row and sorts by z inside each partition value
    assert clustered(_rows(spark), ["store_key", "product_key"], ["year"]).count() == 20000


def test_z_value_uses_all_bits_and_refuses_larger_keys(spark):
    import pytest
    from lakemart.operators.layout import z_value
    df = spark.createDataFrame([(0, 0), (65536, 0), (0, 900001), (2**31 - 1, 2**31 - 1), (None, 1)], "a long, b long")
    got = [r.z for r in df.select(z_value(["a", "b"]).alias("z")).collect()]
    assert got[0] == 0 and got[1] == 1 << 32 and got[4] is None and len(set(got)) == 5
    assert got[2] == sum(((900001 >> i) & 1) << (2 * i + 1) for i in range(31)) and got[3] == 2**62 - 1
    for bad in (2**31, -1):
        with pytest.raises(Exception, match="z_value"):
            spark.createDataFrame([(bad, 0)], "a long, b long").select(z_value(["a", "b"])).collect()


def test_full_replace_drops_partitions_that_are_gone(spark, tmp_dir):
    path = os.path.join(tmp_dir, "fact")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_partitioned(_rows(spark), path, ["year", "month"])
        write_partitioned(_rows(spark).where("year = 2001"), path, ["year", "month"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r.year for r in spark.read.parquet(path).select("year").distinct().collect()] == [2001]
