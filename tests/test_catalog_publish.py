"""SQL entry point over a written lake, dynamic partition pruning, export,
reload and reconciliation."""

import os

import pytest
from pyspark.sql import functions as F

from lakemart.plans import catalog, metrics, star
from lakemart.plans.pipeline import fixture_lake
from lakemart.sources import publish

from conftest import SF001


@pytest.fixture(scope="module")
def lake(spark):
    return fixture_lake(spark, SF001)


def test_sql_text_equals_dataframe(spark, lake):
    catalog.create_database(spark, "lakemart_test", lake.lake)
    got = {r.category: r.total_revenue for r in catalog.run_sql(spark, "revenue_by_category", "lakemart_test").collect()}
    want = {r.category: r.total_revenue for r in metrics.revenue_by_category(lake).collect()}
    assert got == want
    a = catalog.run_sql(spark, "total_revenue", "lakemart_test").first()[0]
    assert a == metrics.total_revenue(lake).first()[0]
    catalog.register_views(spark, lake.lake, prefix="v_")
    assert spark.table("v_fact_sales").count() == 57949


def test_calendar_filter_prunes_fact_partitions(lake):
    q = star.date_slice(lake, year=[1998], quarter=[1])
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression" in plan.lower() or "PartitionFilters: [isnotnull(year" in plan
    n = q.count()
    assert n == lake.fact_sales.filter((F.col("year") == 1998) & F.col("month").isin(1, 2, 3)).count()


def test_export_reload_reconcile(spark, lake, tmp_dir):
    fact = lake.fact_sales
    path = os.path.join(tmp_dir, "export", "fact_sales")
    publish.export_table(fact, path)
    back = spark.read.parquet(path)
    assert publish.schema_matches(fact, back)
    rec = publish.reconcile([("fact_sales", fact, back, "net_sales")]).first()
    assert rec.matched and rec.source_rows == rec.target_rows == 57949
    assert publish.deep_diff(fact, back).count() == 0
    small = os.path.join(tmp_dir, "export", "dim_store")
    publish.export_table(lake.dim_store, small, single_file=True)
    assert len([f for f in os.listdir(small) if f.endswith(".parquet")]) == 1
    t = publish.reload_as_table(spark, small, "reloaded_dim_store")
    assert t.count() == 100
    bad = publish.reconcile([("dim_store", lake.dim_store, t.limit(99), None)]).first()
    assert not bad.matched


def test_sql_on_dataframes_equals_metrics(spark, lake):
    got = catalog.run_sql_on(spark, "monthly_net_sales", lake).collect()
    want = metrics.monthly_net_sales(lake).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_completed_lake_is_reused_from_its_marker(spark, lake):
    from lakemart.plans import pipeline
    saved = dict(pipeline._LAKES)
    try:
        pipeline._LAKES.clear()
        again = pipeline.fixture_lake(spark, SF001)
        assert again.lake.root == lake.lake.root          # no rebuild
        assert again.dim_rows == lake.dim_rows            # measured sizes kept
    finally:
        pipeline._LAKES.clear()
        pipeline._LAKES.update(saved)


def test_check_texts_equal_the_checks(spark, lake):
    from lakemart.plans import dq

    bronze = dq.bronze_tables(lake)
    same = {"check_missing_category": dq.missing_category, "check_negative_quantity": dq.negative_quantities,
            "check_prices": dq.invalid_prices, "check_null_city": dq.null_city_pct, "check_order_statuses": dq.invalid_order_statuses,
            "check_payments_of_unknown_orders": dq.fk_payments_orders, "check_repeated_customers": dq.duplicate_customer_ids}
    for name, check in same.items():
        assert sorted(map(tuple, catalog.run_sql_on(spark, name, lake).collect())) == sorted(map(tuple, check(bronze).collect()))
    assert len(catalog.CHECKS) == 12
