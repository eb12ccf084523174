"""Declared schemas and closed value domains of the six retail sources."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Closed domains used by silver standardisation and DQ checks.
# ---------------------------------------------------------------------------
CUSTOMER_STATUSES = ["Active", "Inactive"]
PRODUCT_STATUSES = ["Active", "Discontinued"]
ORDER_STATUSES = ["Completed", "Cancelled", "Returned", "Pending"]
PAYMENT_STATUSES = ["Successful", "Failed", "Refunded", "Pending"]
MISSING_REFERENCE = "MISSING_REFERENCE"
UNKNOWN = "Unknown"

_S, _D, _L, _DT, _TS = T.StringType(), T.DecimalType, T.LongType(), T.DateType(), T.TimestampNTZType()


def _f(name, dtype):
    return T.StructField(name, dtype, True)


CUSTOMERS = T.StructType([
    _f("customer_id", _S), _f("first_name", _S), _f("last_name", _S), _f("gender", _S),
    _f("date_of_birth", _DT), _f("city", _S), _f("state", _S), _f("country", _S),
    _f("signup_date", _DT), _f("customer_segment", _S), _f("email", _S), _f("customer_status", _S),
])
PRODUCTS = T.StructType([
    _f("product_id", _S), _f("product_name", _S), _f("category", _S), _f("subcategory", _S),
    _f("brand", _S), _f("supplier", _S), _f("unit_cost", _D(14, 4)), _f("selling_price", _D(12, 2)),
    _f("launch_date", _DT), _f("product_status", _S),
])
STORES = T.StructType([
    _f("store_id", _S), _f("store_name", _S), _f("city", _S), _f("state", _S), _f("region", _S),
    _f("store_type", _S), _f("opening_date", _DT), _f("manager_id", _S),
])
ORDERS = T.StructType([
    _f("order_id", _S), _f("customer_id", _S), _f("store_id", _S), _f("order_date", _DT),
    _f("order_timestamp", _TS), _f("order_status", _S), _f("payment_method", _S),
    _f("order_channel", _S), _f("shipping_city", _S), _f("total_amount", _D(18, 2)),
])
ORDER_ITEMS = T.StructType([
    _f("order_item_id", _S), _f("order_id", _S), _f("product_id", _S), _f("quantity", _L),
    _f("unit_price", _D(12, 2)), _f("discount_percentage", _D(5, 2)), _f("tax_percentage", _D(5, 2)),
    _f("line_amount", _D(18, 2)), _f("cost_amount", _D(18, 4)),
])
PAYMENTS = T.StructType([
    _f("payment_id", _S), _f("order_id", _S), _f("payment_date", _DT), _f("payment_method", _S),
    _f("payment_status", _S), _f("payment_amount", _D(18, 2)), _f("transaction_reference", _S),
])

SOURCES = {
    "customers": CUSTOMERS, "products": PRODUCTS, "stores": STORES,
    "orders": ORDERS, "order_items": ORDER_ITEMS, "payments": PAYMENTS,
}
KEYS = {
    "customers": "customer_id", "products": "product_id", "stores": "store_id",
    "orders": "order_id", "order_items": "order_item_id", "payments": "payment_id",
}
# Source file formats of the raw landing zone.
FORMATS = {
    "customers": "csv", "products": "csv", "stores": "csv",
    "orders": "parquet", "order_items": "parquet", "payments": "parquet",
}
