"""Months that are copied from files of one month each."""

from lakemart.plans import refresh


def test_months_read_from_files_of_one_month_are_written_without_a_shuffle(spark, tmp_dir, monkeypatch):
    spark.range(300).selectExpr("id", "2001 year", "cast(1 + id % 3 as int) month").write.partitionBy("year", "month").parquet(f"{tmp_dir}/f")
    rows = spark.read.parquet(f"{tmp_dir}/f")
    monkeypatch.setattr(type(rows), "hint", lambda *a: (_ for _ in ()).throw(AssertionError("shuffled")))
    refresh.replace_months(rows, f"{tmp_dir}/copy", by_month=True)
    refresh.replace_months(rows.where("month = 2 AND id < 100"), f"{tmp_dir}/copy", by_month=True)
    got = spark.read.parquet(f"{tmp_dir}/copy").groupBy("month").count().collect()
    assert {r["month"]: r["count"] for r in got} == {1: 100, 2: 33, 3: 100}
