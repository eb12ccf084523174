"""Gold star schema: three dimensions with dense surrogate keys, a generated
calendar, and the order-item-grain sales fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import dates, money
from lakemart.operators.joins import lookup, packable, packed_lookup
from lakemart.operators.keys import hash_key, with_dense_key

DIM_COLUMNS = {
    # dim_customer drops email
    "dim_customer": ["customer_key", "customer_id", "first_name", "last_name", "gender", "date_of_birth",
                     "city", "state", "country", "signup_date", "customer_segment", "customer_status"],
    "dim_product": ["product_key", "product_id", "product_name", "category", "subcategory", "brand",
                    "supplier", "unit_cost", "selling_price", "launch_date", "product_status"],
    "dim_store": ["store_key", "store_id", "store_name", "city", "state", "region", "store_type",
                  "opening_date", "manager_id"],
}
DATE_COLUMNS = ["full_date", "date_key", "year", "quarter", "month", "month_name", "day",
                "day_of_week", "is_weekend"]
MONEY_COLUMNS = ["gross_sales", "discount_amount", "tax_amount", "net_sales", "cost_amount", "profit"]
#: Item columns that the fact is computed from.
FACT_INPUT = ["order_id", "order_item_id", "customer_key", "product_key", "store_key", "date_key", "quantity",
              "unit_price", "discount_percentage", "tax_percentage", "cost_amount", "order_status", "order_channel"]
FACT_COLUMNS = ["sales_key", "order_id", "order_item_id", "customer_key", "product_key", "store_key",
                "date_key", "quantity", *MONEY_COLUMNS, "profit_margin", "order_status", "order_channel",
                "year", "month"]


def _dim(silver: DataFrame, natural_key: str, key: str, name: str, keys: DataFrame | None = None) -> DataFrame:
    """``keys`` (natural key, surrogate key), of a ``KeyRegistry``, in place of new numbers."""
    cols = [c for c in DIM_COLUMNS[name] if c != key]
    # dimension keys are INT by contract; under ANSI the cast raises past 2^31 - 1 rows
    if keys is None:
        keyed = with_dense_key(silver.select(*cols), natural_key, key)
    else:
        keyed = silver.select(*cols).join(keys.select(natural_key, key), natural_key)
    return keyed.withColumn(key, F.col(key).cast("int")).select(*DIM_COLUMNS[name])


def dim_customer(silver_customers: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    return _dim(silver_customers, "customer_id", "customer_key", "dim_customer", keys)


def dim_product(silver_products: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    return _dim(silver_products, "product_id", "product_key", "dim_product", keys)


def dim_store(silver_stores: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    return _dim(silver_stores, "store_id", "store_key", "dim_store", keys)


def dim_date(silver_orders: DataFrame, date_col: str = "order_date") -> DataFrame:
    """Every day from the first to the last order date, empty days included.
    One lazy plan: the bounds never visit the driver; empty input -> 0 rows."""
    bounds = silver_orders.agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    days = bounds.select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return days.select("full_date", *[c.alias(n) for n, c in dates.calendar_columns("full_date").items()])


def order_keys(silver_orders: DataFrame, dim_c: DataFrame, dim_s: DataFrame, dim_d: DataFrame,
               dim_rows: dict[str, int] | None = None) -> DataFrame:
    """Surrogate keys of every silver order, looked up at order grain (several
    times fewer rows than items): customer_key, store_key, date_key, plus the
    degenerate dimensions.  Left lookups: an order whose store or customer has
    no dimension row keeps a NULL key (the fact drops such rows, as the star's
    inner joins do; ``join_audit`` lists them).  Unique on order_id."""
    rows = dim_rows or {}
    o = silver_orders.select("order_id", "customer_id", "store_id", "order_date", "order_status", "order_channel")
    o = lookup(o, dim_c, "customer_id", ["customer_key"], how="left", dim_rows=rows.get("dim_customer"))
    o = lookup(o, dim_s, "store_id", ["store_key"], how="left", dim_rows=rows.get("dim_store"))
    # dim_date spans min..max order date: bounded by the calendar, always broadcast
    days = F.broadcast(dim_d.select(F.col("date_key").alias("_dk")))
    o = o.withColumn("_k", dates.date_key("order_date"))
    o = o.join(days, F.col("_k") == F.col("_dk"), "left")
    return o.select("order_id", "customer_key", "store_key", F.col("_dk").alias("date_key"),
                    "order_status", "order_channel")


def product_items(silver_items: DataFrame, dim_p: DataFrame, product_rows: int | None = None) -> DataFrame:
    """What the fact is computed from, of stored silver items, with the key of their product.
    Many products are looked up by the 64-bit hash of their id, where it tells them apart:
    silver items have no other products."""
    cols = [c for c in FACT_INPUT if c in silver_items.columns]
    hashed = F.xxhash64("product_id")
    if packable(dim_p, hashed, product_rows or 0):
        known = F.when(F.col("product_id").isNotNull(), hashed)
        return packed_lookup(silver_items.select(*cols, "product_id"), dim_p, known, hashed, "product_key", product_rows).drop("product_id", "__found")
    return lookup(silver_items.select(*cols, "product_id"), dim_p, "product_id", ["product_key"], how="left",
                  dim_rows=product_rows).drop("product_id")


def keyed_items(items: DataFrame, keys: DataFrame) -> DataFrame:
    """``product_items`` with all their fact keys (``keys`` of ``order_keys``): the product
    is looked up before the items move to their orders, and only what the fact is
    computed from moves."""
    return lookup(items, keys, "order_id", [c for c in keys.columns if c != "order_id"], how="left")


def fact_input(items: DataFrame) -> DataFrame:
    """What the fact is computed from: ``FACT_INPUT`` and the month, of the valid
    items that carry all their keys (``silver.enriched_items`` over a classification
    whose parents were ``order_keys`` and ``dim_product``; or ``keyed_items``).  Rows with a missing key
    are dropped, as the star's inner joins would."""
    f = items.filter(F.col("customer_key").isNotNull() & F.col("store_key").isNotNull()
                     & F.col("product_key").isNotNull() & F.col("date_key").isNotNull())
    return f.select(*FACT_INPUT, *[c.alias(n) for n, c in month_columns().items()])


def month_columns() -> dict[str, Column]:
    """The partition columns of the fact, from its date key."""
    return {"year": dates.key_year("date_key"), "month": dates.key_month("date_key")}


def fact_sales(items: DataFrame, key_mode: str = "hash") -> DataFrame:
    """Order-item grain fact from valid items that already carry all their keys:
    no join at item grain."""
    return fact_measures(fact_input(items), key_mode)


def fact_measures(inputs: DataFrame, key_mode: str = "hash") -> DataFrame:
    """The fact of ``fact_input`` rows, in their order: a projection, so what is
    laid out by keys and month is laid out before its amounts are computed."""
    f = inputs.withColumn("gross_sales", money.gross_sales("quantity", "unit_price"))
    f = f.withColumn("discount_amount", money.discount_amount("gross_sales"))
    f = f.withColumn("net_sales", money.net_sales("gross_sales", "discount_amount"))
    f = f.withColumns({
        "tax_amount": money.tax_amount("net_sales"),
        "cost_amount": F.col("cost_amount").cast(money.COST),
        "profit": money.profit("net_sales"),
    })
    sales_key = hash_key("order_item_id") if key_mode == "hash" else F.monotonically_increasing_id()
    f = f.withColumns({
        "profit_margin": money.profit_margin("profit", "net_sales"),
        "sales_key": sales_key,
    })
    return f.select(*FACT_COLUMNS)


def join_audit(items: DataFrame, fact: DataFrame) -> DataFrame:
    """Items that did not reach the fact (an inner dimension join lost them)."""
    return items.select("order_item_id").join(fact.select("order_item_id"), "order_item_id", "left_anti")
