"""Stored state of the incremental silver layer."""

from lakemart.plans.model import FIXTURE_CONFIG
from lakemart.streaming.silver_stream import IncrementalSilver


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_state_is_not_deduplicated_again(spark, tmp_dir):
    inc = IncrementalSilver(spark, tmp_dir, FIXTURE_CONFIG, buckets=2)
    rows = spark.createDataFrame([("S1", "a", "x", "y", "r", "Mall", None, "m", 0)],
                                 "store_id string, store_name string, city string, state string, region string, "
                                 "store_type string, opening_date date, manager_id string, seq int")
    assert "Aggregate" not in _plan(inc._classify("stores", rows))
