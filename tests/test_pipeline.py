"""Layer invariants on the fixture lake, expected counts, and plan shapes."""

import pytest
from pyspark.sql import functions as F

from lakemart.plans import dq, metrics
from lakemart.plans.model import Model
from lakemart.plans.silver import rejection_summary
from lakemart.plans.pipeline import fixture_lake
from lakemart.operators.dedupe import dedupe_latest
from lakemart.sources import schemas as S

from conftest import SF001, SF0001


@pytest.fixture(scope="module")
def lake(spark):
    return fixture_lake(spark, SF001)


def test_expected_counts_sf001(lake):
    silver = {t: lake.silver(t).count() for t in S.SOURCES}
    assert silver == {"customers": 1500, "products": 1980, "stores": 100, "orders": 14850,
                      "order_items": 57949, "payments": 14447}
    rej = {(r.table_name, r.rejected_reason): r.rejected_rows for r in
           rejection_summary({t: lake.rejected(t) for t in ("products", "orders", "order_items", "payments")}).collect()}
    assert rej == {("products", "invalid_selling_price"): 20, ("orders", "invalid_customer_fk"): 150,
                   ("order_items", "negative_quantity"): 293, ("order_items", "invalid_order_fk"): 594,
                   ("order_items", "invalid_product_fk"): 1164, ("payments", "invalid_payment_amount"): 147,
                   ("payments", "invalid_order_fk"): 149, ("payments", "null_payment_amount"): 257}
    f = lake.fact_sales.agg(F.count(F.lit(1)).alias("n"), F.sum("net_sales").alias("net"),
                            F.sum("profit").alias("profit"), F.count_distinct("order_id").alias("o")).first()
    assert f.n == 57949 and str(f.net) == "1328859960.485000" and str(f.profit) == "349801738.875000"
    assert f.o == 14563 and lake.dim_date.count() == 2405


def test_conservation_silver_plus_rejected_equals_deduped(lake):
    for t in S.SOURCES:
        deduped = dedupe_latest(lake.bronze[t], S.KEYS[t], ("seq",)).count()
        rejected = lake.rejected(t).count() if t in ("products", "orders", "order_items", "payments") else 0
        assert lake.silver(t).count() + rejected == deduped, t


def test_silver_dq_all_pass_bronze_fails(lake):
    rows = dq.dq_summary(lake).collect()
    assert len(rows) == 28
    silver = [r for r in rows if r.layer == "silver"]
    assert all(r.failed_records == 0 and r.status == "PASS" for r in silver)
    bronze = {r.check_name + "|" + r.table_name: r.failed_records for r in rows if r.layer == "bronze"}
    assert bronze["Null city|customers"] == 30 and bronze["Duplicate customer_id|customers"] == 15
    assert bronze["Null category|products"] == 40 and bronze["Invalid selling_price|products"] == 20
    assert bronze["Duplicate order_id|orders"] == 75 and bronze["Invalid customer_id FK|orders"] == 150
    assert bronze["Negative quantity|order_items"] == 293 and bronze["Invalid product_id FK|order_items"] == 585
    assert bronze["Duplicate payment_id|payments"] == 150 and bronze["Invalid payment_amount|payments"] == 147


def test_fact_has_no_join_loss_and_totals_agree(lake):
    from lakemart.plans.gold import join_audit
    assert join_audit(lake.silver_order_items, lake.fact_sales).count() == 0
    total = metrics.total_revenue(lake).first().total_revenue
    for by in (metrics.revenue_by_category, metrics.revenue_by_segment, metrics.revenue_by_store):
        assert abs(sum(r.total_revenue for r in by(lake).collect()) - total) < 1e-3


def test_lazy_model_equals_stored_lake(spark, lake):
    lazy = Model.from_testdata(spark, SF001)
    a = metrics.revenue_by_category(lazy).collect()
    b = metrics.revenue_by_category(lake).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_partition_pruning_on_stored_fact(lake):
    plan = metrics.month_slice_kpis(lake, 1998, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(year" in plan and "= 1998" in plan


def test_dims_broadcast_with_measured_size(lake):
    assert lake.dim_rows["dim_store"] == 100 and lake.dim_rows["dim_date"] == 2405


def test_dedupe_plan_is_partial_aggregate(lake):
    plan = dedupe_latest(lake.bronze["orders"], "order_id", ("seq",))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "SinglePartition" not in plan


def test_entry_smoke(spark):
    import __spark_entry__ as E
    out = E.entry(spark).collect()
    assert len(out) == 7 and {r.category for r in out} >= {"Economy", "Unknown"}
    assert set(E._q.REGISTRY) - set(E.oracle_sql()) == set()
    assert set(E.oracle_sql()) <= set(E.queries())
