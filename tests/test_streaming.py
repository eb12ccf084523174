"""availableNow file-source ingestion: each landed file is ingested once."""

import os

from lakemart.sources import bronze, schemas as S, testdata
from lakemart.streaming.bronze_stream import ingest_stream

from conftest import SF0001


def test_stream_ingests_each_file_once(spark, tmp_dir):
    raw = testdata.raw(spark, SF0001).as_dict()["customers"].drop("seq")
    landing, target, ckpt = (os.path.join(tmp_dir, d) for d in ("landing", "bronze", "ckpt"))
    raw.filter("customer_id < 'CUST0000100'").coalesce(1).write.option("header", "true").csv(landing + "/a")
    q = ingest_stream(spark, landing + "/*", "csv", S.CUSTOMERS, target, ckpt)
    q.awaitTermination(120)
    first = bronze.read_bronze(spark, target)
    n1 = first.count()
    assert n1 == raw.filter("customer_id < 'CUST0000100'").count()
    assert first.filter("source_file NOT LIKE 'part-%'").count() == 0
    raw.filter("customer_id >= 'CUST0000100'").coalesce(1).write.option("header", "true").csv(landing + "/b")
    q = ingest_stream(spark, landing + "/*", "csv", S.CUSTOMERS, target, ckpt)
    q.awaitTermination(120)
    both = bronze.read_bronze(spark, target)
    assert both.count() == raw.count()                      # nothing ingested twice
    assert both.select("batch_id").distinct().count() == 2  # one partition per micro-batch
