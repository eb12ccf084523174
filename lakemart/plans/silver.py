"""Silver layer: deduplicate, standardise, validate, quarantine.

Every builder returns a *classified* frame (bronze columns + the standardised
silver columns + ``rejected_reason``); ``silver_view`` and ``rejected_view``
project the two outputs from it, so valid + rejected always equals the
deduplicated input (under the default ``null_policy="reject"``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.text import in_domain_or, title_trim, title_trim_or
from lakemart.operators import validate as V
from lakemart.operators.dedupe import BRONZE_ORDER, dedupe_latest
from lakemart.sources import schemas as S

SILVER_COLUMNS = {
    "customers": ["customer_id", "first_name", "last_name", "gender", "date_of_birth", "city", "state",
                  "country", "signup_date", "customer_segment", "email", "customer_status"],
    "products": ["product_id", "product_name", "category", "subcategory", "brand", "supplier",
                 "unit_cost", "selling_price", "launch_date", "product_status"],
    "stores": ["store_id", "store_name", "city", "state", "region", "store_type", "opening_date", "manager_id"],
    "orders": ["order_id", "customer_id", "store_id", "order_date", "order_timestamp", "order_status",
               "payment_method", "order_channel", "shipping_city", "total_amount"],
    "order_items": ["order_item_id", "order_id", "product_id", "quantity", "unit_price",
                    "discount_percentage", "tax_percentage", "line_amount", "cost_amount"],
    "payments": ["payment_id", "order_id", "payment_date", "payment_method", "payment_status",
                 "payment_amount", "transaction_reference"],
}
# Order-grain attributes carried onto each valid item for the fact build
# (surrogate keys looked up once per order, degenerate dimensions).
ORDER_CARRY = ["customer_key", "store_key", "date_key", "order_status", "order_channel"]
PRODUCT_CARRY = ["product_key"]


@dataclass(frozen=True)
class SilverConfig:
    order_cols: tuple[str, ...] = BRONZE_ORDER  # newest-first ordering of bronze copies
    null_policy: str = "reject"                 # or "drop" (NULL amounts vanish)
    blank_as_null: bool = False                 # treat '' city/category as missing
    validate_store: bool = False                # extra store FK rule on orders
    deduplicated: bool = False                  # the bronze frames hold one row per key already


def _deduped(bronze: DataFrame, table: str, cfg: SilverConfig) -> DataFrame:
    return bronze if cfg.deduplicated else dedupe_latest(bronze, S.KEYS[table], cfg.order_cols)


def _to_date(df: DataFrame, col: str):
    """DATE column as is; text parsed with ``try_to_date`` (NULL, not an ANSI
    error, for dirty values such as 'xx')."""
    dtype = df.schema[col].dataType.typeName()
    if dtype == "date":
        return F.col(col)
    if dtype in ("timestamp", "timestamp_ntz"):
        return F.col(col).cast("date")
    return F.try_to_date(F.col(col).cast("string"))


def _to_timestamp(df: DataFrame, col: str):
    dtype = df.schema[col].dataType.typeName()
    if dtype in ("timestamp", "timestamp_ntz"):
        return F.col(col)
    return F.try_to_timestamp(F.col(col).cast("string"))


def customers(bronze: DataFrame, cfg: SilverConfig = SilverConfig()) -> DataFrame:
    """Never rejects: a missing city becomes 'Unknown'."""
    d = _deduped(bronze, "customers", cfg)
    return d.withColumns({
        "city": title_trim_or("city", blank_as_null=cfg.blank_as_null),
        "state": title_trim("state"),
        "date_of_birth": _to_date(d, "date_of_birth"),
        "signup_date": _to_date(d, "signup_date"),
        "customer_status": in_domain_or("customer_status", S.CUSTOMER_STATUSES),
        V.REASON: F.lit(None).cast("string"),
    })


def products(bronze: DataFrame, cfg: SilverConfig = SilverConfig()) -> DataFrame:
    d = _deduped(bronze, "products", cfg)
    c = V.classify(d, V.positive("selling_price", "invalid_selling_price", cfg.null_policy),
                   V.drop_cols_for(cfg.null_policy, "selling_price"))
    return c.withColumns({
        "category_std": title_trim_or("category", blank_as_null=cfg.blank_as_null),
        "subcategory_std": title_trim("subcategory"),
        "launch_date_std": _to_date(d, "launch_date"),
        "product_status_std": in_domain_or("product_status", S.PRODUCT_STATUSES),
    })


def stores(bronze: DataFrame, cfg: SilverConfig = SilverConfig()) -> DataFrame:
    d = _deduped(bronze, "stores", cfg)
    return d.withColumns({
        "city": title_trim("city"),
        "state": title_trim("state"),
        "opening_date": _to_date(d, "opening_date"),
        V.REASON: F.lit(None).cast("string"),
    })


def orders(bronze: DataFrame, silver_customers: DataFrame, cfg: SilverConfig = SilverConfig(),
           silver_stores: DataFrame | None = None) -> DataFrame:
    d = _deduped(bronze, "orders", cfg)
    d = V.with_parent(d, silver_customers, "customer_id", "_has_customer", unique=True)
    rules = [V.Rule("invalid_customer_fk", V.missing("_has_customer"))]
    if cfg.validate_store and silver_stores is not None:
        d = V.with_parent(d, silver_stores, "store_id", "_has_store", unique=True)
        rules.append(V.Rule("invalid_store_fk", V.missing("_has_store")))
    c = V.classify(d, rules).drop("_has_customer", "_has_store")
    return c.withColumns({
        "order_date_std": _to_date(d, "order_date"),
        "order_timestamp_std": _to_timestamp(d, "order_timestamp"),
        "order_status_std": in_domain_or("order_status", S.ORDER_STATUSES),
        "total_amount_std": F.coalesce(F.col("total_amount"), F.lit(0)),
    })


def order_items(bronze: DataFrame, orders_parent: DataFrame, products_parent: DataFrame,
                cfg: SilverConfig = SilverConfig(), order_carry=(), product_carry=()) -> DataFrame:
    """Ordered rules: quantity -> order FK -> product FK; the first failure wins.
    Parents are the *final* silver tables (or frames with exactly their keys),
    so children of rejected parents are quarantined too.

    The two validation joins also carry parent columns (prefixed ``o_`` /
    ``p_``): with ``gold.order_keys`` as the order parent and ``dim_product``
    as the product parent, every valid item leaves here with all of its fact
    keys, so the fact needs no further join at item grain.  Carrying parents
    must be unique on their key (they are: silver tables and dimensions).
    ``V.Absent`` in place of a parent validates without moving an item.
    """
    d = _deduped(bronze, "order_items", cfg)
    oc = orders_parent if isinstance(orders_parent, V.Absent) else orders_parent.select("order_id", *[F.col(c).alias(f"o_{c}") for c in order_carry])
    d = V.with_parent(d, oc, "order_id", "_has_order", carry=[f"o_{c}" for c in order_carry])
    pc = products_parent if isinstance(products_parent, V.Absent) else products_parent.select("product_id", *[F.col(c).alias(f"p_{c}") for c in product_carry])
    d = V.with_parent(d, pc, "product_id", "_has_product", carry=[f"p_{c}" for c in product_carry])
    rules = V.positive("quantity", "negative_quantity", cfg.null_policy) + [
        V.Rule("invalid_order_fk", V.missing("_has_order")),
        V.Rule("invalid_product_fk", V.missing("_has_product")),
    ]
    return V.classify(d, rules, V.drop_cols_for(cfg.null_policy, "quantity")).drop("_has_order", "_has_product")


def payments(bronze: DataFrame, silver_orders: DataFrame, cfg: SilverConfig = SilverConfig()) -> DataFrame:
    d = _deduped(bronze, "payments", cfg)
    d = V.with_parent(d, silver_orders, "order_id", "_has_order", unique=True)
    rules = V.positive("payment_amount", "invalid_payment_amount", cfg.null_policy) + [
        V.Rule("invalid_order_fk", V.missing("_has_order")),
    ]
    c = V.classify(d, rules, V.drop_cols_for(cfg.null_policy, "payment_amount")).drop("_has_order")
    return c.withColumns({
        "payment_date_std": _to_date(d, "payment_date"),
        "transaction_reference_std": F.coalesce(F.col("transaction_reference"), F.lit(S.MISSING_REFERENCE)),
        "payment_status_std": in_domain_or("payment_status", S.PAYMENT_STATUSES),
    })


def silver_view(classified: DataFrame, table: str) -> DataFrame:
    """Valid rows in the silver column order (standardised values)."""
    v = V.valid_rows(classified)
    cols = []
    for c in SILVER_COLUMNS[table]:
        cols.append(F.col(f"{c}_std").alias(c) if f"{c}_std" in v.columns else F.col(c))
    return v.select(*cols)


def rejected_view(classified: DataFrame, bronze_columns: list[str]) -> DataFrame:
    """Rejected rows: the deduplicated bronze columns + ``rejected_reason``."""
    return V.rejected_rows(classified).select(*bronze_columns, V.REASON)


def enriched_items(classified_items: DataFrame, order_carry=ORDER_CARRY, product_carry=PRODUCT_CARRY) -> DataFrame:
    """Valid items with the carried order and product columns (fact input)."""
    v = V.valid_rows(classified_items)
    return v.select(*SILVER_COLUMNS["order_items"], *[F.col(f"o_{c}").alias(c) for c in order_carry],
                    *[F.col(f"p_{c}").alias(c) for c in product_carry])


def rejection_summary(rejected: dict[str, DataFrame]) -> DataFrame:
    """Count of rejected rows by table and reason (one pass per quarantine table)."""
    parts = [df.groupBy(V.REASON).agg(F.count(F.lit(1)).alias("rejected_rows"))
             .select(F.lit(t).alias("table_name"), V.REASON, "rejected_rows")
             for t, df in rejected.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
