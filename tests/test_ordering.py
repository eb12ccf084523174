"""Ordered results come back in order (a hash check of rows cannot see it)."""

from lakemart.operators.keys import with_dense_key
from lakemart.plans import queries as Q
from tests.conftest import SF0001

ORDERS = {  # query: sort key of a row
    "bm02_monthly_growth": lambda r: (r.year, r.month),
    "bm04_top_months": lambda r: (-r.monthly_revenue, r.year, r.month),
    "bm05_revenue_by_category": lambda r: (-r.total_revenue, r.category),
    "bm07_declining_products": lambda r: (r.product_id, r.year, r.month),
    "bm08_revenue_by_store": lambda r: (-r.total_revenue, r.store_id),
    "bm10_region_revenue_per_store": lambda r: (r.revenue_per_store, r.region),
    "bm11_revenue_by_segment": lambda r: (-r.total_revenue, r.customer_segment),
    "bm16_payment_failure_rate": lambda r: (-r.failure_rate_pct, r.payment_method),
    "monthly_net_sales": lambda r: (r.year, r.month),
    "revenue_profit_by_category": lambda r: (-r.total_net_sales, r.category),
    "dq_summary": lambda r: (r.table_name, r.check_name, r.layer),
    "top10_products": lambda r: (-r.total_sales, r.product_id),
    "bottom10_products": lambda r: (r.total_sales, r.product_id),
}


def test_results_are_ordered(spark):
    for name, key in ORDERS.items():
        rows = Q.run(name, spark, SF0001).collect()
        assert rows and rows == sorted(rows, key=key), name


def test_dense_key_is_a_bigint(spark):
    keyed = with_dense_key(spark.range(100), "id", "k")
    assert dict(keyed.dtypes)["k"] == "bigint" and keyed.where("k <> id + 1").count() == 0
