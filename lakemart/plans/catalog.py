"""Expose a written lake to SQL users: a database of external Parquet tables
(or session views), so the business questions can be asked as SQL text and
compile to the same plans as the DataFrame functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lakemart.plans.pipeline import Lake
from lakemart.sources import schemas as S

GOLD = ("dim_customer", "dim_product", "dim_store", "dim_date", "fact_sales")
REJECTING = ("products", "orders", "order_items", "payments")


def tables_of(lake: Lake) -> dict[str, str]:
    """SQL table name -> storage path."""
    out = {f"bronze_{t}": lake.path("bronze", t) for t in S.SOURCES}
    out.update({f"silver_{t}": lake.path("silver", t) for t in S.SOURCES})
    out.update({f"{t}_rejected": lake.path("quarantine", t) for t in REJECTING})
    out.update({t: lake.path("gold", t) for t in GOLD})
    return out


def create_database(spark: SparkSession, database: str, lake: Lake) -> list[str]:
    """``CREATE DATABASE IF NOT EXISTS`` + one external Parquet table per lake
    table (partitions of partitioned tables registered with ``MSCK REPAIR``)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for name, path in tables_of(lake).items():
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.catalog.createTable(f"{database}.{name}", path=path, source="parquet")
        if any(c.isPartition for c in spark.catalog.listColumns(name, database)):
            spark.sql(f"MSCK REPAIR TABLE {database}.{name}")
        names.append(f"{database}.{name}")
    return names


def register_views(spark: SparkSession, lake: Lake, prefix: str = "") -> list[str]:
    """Session temp views over the lake tables (no catalog needed)."""
    names = []
    for name, path in tables_of(lake).items():
        spark.read.parquet(path).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


# Business questions as Spark SQL text over the registered names.
SQL = {
    "total_revenue": "SELECT CAST(SUM(net_sales) AS DOUBLE) AS total_revenue FROM {db}fact_sales",
    "revenue_by_category": (
        "SELECT p.category, CAST(SUM(f.net_sales) AS DOUBLE) AS total_revenue FROM {db}fact_sales f "
        "JOIN {db}dim_product p ON f.product_key = p.product_key GROUP BY p.category"),
    "monthly_net_sales": (
        "SELECT d.month_name, d.year, d.month, CAST(SUM(f.net_sales) AS DOUBLE) AS monthly_net_sales "
        "FROM {db}fact_sales f JOIN {db}dim_date d "
        "ON f.date_key = d.date_key AND f.year = d.year AND f.month = d.month "
        "GROUP BY d.year, d.month, d.month_name"),
    "cancellation_rate": (
        "SELECT ROUND(100.0 * COUNT_IF(order_status = 'Cancelled') / NULLIF(COUNT(*), 0), 2) "
        "AS cancellation_rate_pct FROM {db}silver_orders"),
}


def _failing(table: str, condition: str) -> str:
    return f"SELECT COUNT(*) AS total_records, COUNT_IF({condition}) AS failed_records FROM {{db}}bronze_{table}"


def _orphans(child: str, parent: str, key: str) -> str:
    return (f"SELECT COUNT(*) AS invalid_fk_count FROM {{db}}bronze_{child} AS child "
            f"LEFT ANTI JOIN {{db}}bronze_{parent} AS parent ON child.{key} = parent.{key}")


def _one_of(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


#: The stand-alone checks of the bronze layer as Spark SQL text.
CHECKS = {
    "check_null_city": (
        "SELECT total_records, failed_records, CAST(ROUND(CAST(failed_records * 100 AS DECIMAL(38, 0)) / total_records, 2) AS DOUBLE) AS failed_pct "
        "FROM (" + _failing("customers", "city IS NULL") + ")"),
    "check_repeated_customers": (
        "SELECT customer_id, COUNT(*) AS occurrences FROM {db}bronze_customers GROUP BY customer_id HAVING COUNT(*) > 1"),
    "check_missing_category": _failing("products", "category IS NULL"),
    "check_negative_quantity": _failing("order_items", "quantity < 0"),
    "check_prices": _failing("products", "selling_price <= 0"),
    "check_payment_amounts": _failing("payments", "payment_amount <= 0"),
    "check_orders_of_unknown_customers": _orphans("orders", "customers", "customer_id"),
    "check_items_of_unknown_products": _orphans("order_items", "products", "product_id"),
    "check_payments_of_unknown_orders": _orphans("payments", "orders", "order_id"),
    "check_order_dates": _failing("orders", "order_date IS NULL OR order_date > CURRENT_DATE"),
    "check_order_statuses": _failing("orders", f"order_status NOT IN {_one_of(S.ORDER_STATUSES)}"),
    "check_payment_statuses": _failing("payments", f"payment_status NOT IN {_one_of(S.PAYMENT_STATUSES)}"),
}
SQL |= CHECKS


def run_sql(spark: SparkSession, name: str, database: str | None = None):
    return spark.sql(SQL[name].format(db=f"{database}." if database else ""))


def run_sql_on(spark: SparkSession, name: str, model) -> "DataFrame":
    """The same SQL text over a model's DataFrames, passed as named
    parameters of ``spark.sql`` (no catalog, no session-wide views)."""
    import re
    text = SQL[name].replace("{db}", "")
    names = sorted(set(re.findall(r"\b(fact_sales|dim_\w+|silver_\w+|bronze_\w+)\b", text)))
    for n in names:
        text = re.sub(rf"\b{n}\b", "{" + n + "}", text)
    return spark.sql(text, **{n: model.bronze[n[7:]] if n.startswith("bronze_") else getattr(model, n) for n in names})
