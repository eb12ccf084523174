"""Six retail source tables derived from the TPC-H-like test tables.

The test tables carry no natural defects, so defects are placed by modulus
rules on the integer keys.  The same expressions are written in the DuckDB
oracle, so both engines see identical rows.  Duplicated rows are appended once
more with ``seq = 1`` (originals ``seq = 0``); ``seq`` stands in for the
ingestion timestamp of a bronze table, so the later copy wins a dedupe.

Everything here is a lazy plan over the parquet files; nothing is collected.  Only
the rows of ``part`` are counted (from its footers), which says how it is joined.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions import money
from lakemart.functions.text import padded_id
from lakemart.operators.joins import maybe_broadcast, nth, packable, packed_lookup, passes
from lakemart.sources import schemas

TPCH_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# ---------------------------------------------------------------------------
# Defect placement rules (key modulus, remainder) and constants
# of the mapping.  customers: city NULL (50, 7), city lower-cased (33, 5),
# duplicate (100, 3); products: category NULL (50, 13), negative price
# (100, 11); orders: unknown customer (100, 17), duplicate (200, 9);
# order items: negative quantity on orderkey+partkey (200, 21), unknown
# product on orderkey+suppkey (100, 33); payments: negative amount (100, 41),
# NULL reference (50, 43), duplicate (100, 57).
# ---------------------------------------------------------------------------
COUNTRY = "India"
UNIT_COST_FACTOR = "0.70"
DOB_BASE, DOB_SPAN = "1950-01-01", 18000
SIGNUP_BASE, SIGNUP_SPAN = "2015-01-01", 3000
LAUNCH_BASE, LAUNCH_SPAN = "2018-01-01", 1500
OPENING_BASE, OPENING_SPAN = "2010-01-01", 3650
#: More parts than that are held for one query at a time.
MANY_PARTS = 2_000_000
PRIORITY_TO_METHOD = {"1": "Credit Card", "2": "Debit Card", "3": "UPI", "4": "Cash", "5": "Wallet"}


def _mod(col: Column, m: int, r: int) -> Column:
    return (col % m) == r


def _days_after(base: str, offset: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), offset.cast("int"))


@dataclass
class RawTables:
    customers: DataFrame
    products: DataFrame
    stores: DataFrame
    orders: DataFrame
    order_items: DataFrame
    payments: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {k: getattr(self, k) for k in schemas.SOURCES}


def read_tpch(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in TPCH_TABLES}


def _with_duplicates(df: DataFrame, is_dup: Column) -> DataFrame:
    """Originals get seq 0; rows matching is_dup appear once more with seq 1.
    One pass: each row explodes into its list of copies (no self-union)."""
    copies = F.when(is_dup, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("seq", F.explode(copies))


def customers(t: dict[str, DataFrame]) -> DataFrame:
    geo = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    c = t["customer"].join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey")
    out = c.select(
        padded_id("CUST", k, 7).alias("customer_id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        F.when(k % 2 == 0, "F").otherwise("M").alias("gender"),
        _days_after(DOB_BASE, k % DOB_SPAN).alias("date_of_birth"),
        F.when(_mod(k, 50, 7), F.lit(None).cast("string"))
         .when(_mod(k, 33, 5), F.lower("n_name"))
         .otherwise(F.col("n_name")).alias("city"),
        F.col("r_name").alias("state"),
        F.lit(COUNTRY).alias("country"),
        _days_after(SIGNUP_BASE, k % SIGNUP_SPAN).alias("signup_date"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.concat(F.lit("customer"), k.cast("string"), F.lit("@example.com")).alias("email"),
        F.when(F.col("c_acctbal") < 0, "Inactive").otherwise("Active").alias("customer_status"),
        k.alias("_k"),
    )
    return _with_duplicates(out, _mod(F.col("_k"), 100, 3)).drop("_k")


def products(t: dict[str, DataFrame]) -> DataFrame:
    k = F.col("p_partkey")
    price = F.col("p_retailprice").cast(money.PRICE)
    return t["part"].select(
        padded_id("PROD", k, 6).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(_mod(k, 50, 13), F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("category"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)).alias("subcategory"),
        F.col("p_brand").alias("brand"),
        F.concat(F.lit("Supplier "), F.chr(F.lit(65) + k % 20)).alias("supplier"),
        (price * F.lit(UNIT_COST_FACTOR).cast("decimal(2,2)")).cast("decimal(14,4)").alias("unit_cost"),
        F.when(_mod(k, 100, 11), -price).otherwise(price).alias("selling_price"),
        _days_after(LAUNCH_BASE, k % LAUNCH_SPAN).alias("launch_date"),
        F.when(F.col("p_size") <= 45, "Active").otherwise("Discontinued").alias("product_status"),
        F.lit(0).alias("seq"),
    )


def stores(t: dict[str, DataFrame]) -> DataFrame:
    geo = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    s = t["supplier"].join(F.broadcast(geo), F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.col("s_suppkey")
    stype = F.when(k % 4 == 0, "Mall").when(k % 4 == 1, "High Street").when(k % 4 == 2, "Supermarket").otherwise("Outlet")
    return s.select(
        padded_id("STORE", k, 4).alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("n_name").alias("city"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("region"),
        stype.alias("store_type"),
        _days_after(OPENING_BASE, k % OPENING_SPAN).alias("opening_date"),
        padded_id("MGR", k, 5).alias("manager_id"),
        F.lit(0).alias("seq"),
    )


def _item_lines(t: dict[str, DataFrame], part_rows: int | None = None) -> DataFrame:
    """lineitem joined to part: unsigned quantity, prices, line amounts."""
    part_rows = t["part"].count() if part_rows is None else part_rows
    prices, key = t["part"].select("p_partkey", "p_retailprice"), F.col("p_partkey").cast("long")
    if packable(prices, key, part_rows):
        li = packed_lookup(t["lineitem"], prices, F.col("l_partkey").cast("long"), key, "p_retailprice", part_rows).where("__found")
    else:
        li = t["lineitem"].join(maybe_broadcast(prices, part_rows), F.col("l_partkey") == F.col("p_partkey"))
    price = F.col("p_retailprice").cast(money.PRICE)
    qty = F.col("l_quantity").cast("bigint")
    disc = (F.col("l_discount").cast(money.PCT) * 100).cast(money.PCT)
    tax = (F.col("l_tax").cast(money.PCT) * 100).cast(money.PCT)
    return li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        qty.alias("qty"), price.alias("unit_price"),
        disc.alias("discount_percentage"), tax.alias("tax_percentage"),
        money.line_amount(qty, price, disc, tax).alias("line_amount"),
        (qty.cast(money.QTY) * price * F.lit(UNIT_COST_FACTOR).cast("decimal(2,2)")).cast(money.COST).alias("cost_amount"),
    )


def order_totals(t: dict[str, DataFrame], lines: DataFrame | None = None) -> DataFrame:
    """Rollup of line amounts per order (partial aggregation before the shuffle)."""
    return ((lines if lines is not None else _item_lines(t)).groupBy("l_orderkey")
            .agg(F.round(F.sum("line_amount"), 2).cast(money.LINE).alias("total_amount")))


def _orders_base(t: dict[str, DataFrame], lines: DataFrame | None = None) -> DataFrame:
    """Clean orders (no defects) with the columns payments also need."""
    o = t["orders"]
    k = F.col("o_orderkey")
    n_stores = t["supplier"].agg(F.count(F.lit(1))).scalar()
    ship = (t["customer"].select("c_custkey", "c_nationkey")
            .join(F.broadcast(t["nation"].select("n_nationkey", "n_name")), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_custkey"), F.col("n_name").alias("shipping_city")))
    totals = order_totals(t, lines)
    pm = F.substring(F.col("o_orderpriority"), 1, 1)
    method = F.lit(PRIORITY_TO_METHOD["5"])
    for digit in ("4", "3", "2", "1"):
        method = F.when(pm == digit, PRIORITY_TO_METHOD[digit]).otherwise(method)
    status = (F.when(F.col("o_orderstatus") == "F", "Completed")
              .when(F.col("o_orderstatus") == "O", "Pending")
              .when(k % 2 == 0, "Cancelled").otherwise("Returned"))
    channel = F.when(k % 3 == 0, "Store").when(k % 3 == 1, "Website").otherwise("Mobile App")
    return (o.join(ship, F.col("o_custkey") == F.col("c_custkey"), "left")
            .join(totals, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select(
                k.alias("_k"), F.col("o_custkey").alias("_c"),
                padded_id("ORD", k, 8).alias("order_id"),
                padded_id("STORE", k % n_stores, 4).alias("store_id"),
                F.col("o_orderdate").cast("date").alias("order_date"),
                (F.col("o_orderdate") + F.make_dt_interval(secs=(k % 86400).cast("int"))).alias("order_timestamp"),
                status.alias("order_status"),
                method.alias("payment_method"),
                channel.alias("order_channel"),
                F.col("shipping_city"),
                F.col("total_amount"),
            ))


def orders(t: dict[str, DataFrame], base: DataFrame | None = None) -> DataFrame:
    b = base if base is not None else _orders_base(t)
    k = F.col("_k")
    cust = F.when(_mod(k, 100, 17), padded_id("NOCUST", k, 6)).otherwise(padded_id("CUST", F.col("_c"), 7))
    out = b.select(
        "_k", "order_id", cust.alias("customer_id"), "store_id", "order_date", "order_timestamp",
        "order_status", "payment_method", "order_channel", "shipping_city", "total_amount",
    )
    return _with_duplicates(out, _mod(k, 200, 9)).drop("_k")


def order_items(t: dict[str, DataFrame], lines: DataFrame | None = None) -> DataFrame:
    li = lines if lines is not None else _item_lines(t)
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    item_id = F.concat_ws("-", padded_id("OI", ok, 8), F.col("l_linenumber").cast("string"),
                          pk.cast("string"), sk.cast("string"))
    product = F.when(_mod(ok + sk, 100, 33), padded_id("NOPROD", pk, 5)).otherwise(padded_id("PROD", pk, 6))
    qty = F.when(_mod(ok + pk, 200, 21), -F.col("qty")).otherwise(F.col("qty"))
    return li.select(
        item_id.alias("order_item_id"),
        padded_id("ORD", ok, 8).alias("order_id"),
        product.alias("product_id"),
        qty.alias("quantity"),
        "unit_price", "discount_percentage", "tax_percentage", "line_amount", "cost_amount",
        F.lit(0).alias("seq"),
    )


def payments(t: dict[str, DataFrame], base: DataFrame | None = None) -> DataFrame:
    b = base if base is not None else _orders_base(t)
    k = F.col("_k")
    status = (F.when(_mod(k, 20, 0), "Failed").when(_mod(k, 33, 1), "Refunded")
              .when(_mod(k, 50, 2), "Pending").otherwise("Successful"))
    out = b.select(
        "_k",
        padded_id("PAY", k, 8).alias("payment_id"),
        "order_id",
        F.date_add("order_date", (k % 3).cast("int")).alias("payment_date"),
        "payment_method",
        status.alias("payment_status"),
        F.when(_mod(k, 100, 41), -F.col("total_amount")).otherwise(F.col("total_amount")).alias("payment_amount"),
        F.when(_mod(k, 50, 43), F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("TXN"), k.cast("string"))).alias("transaction_reference"),
    )
    return _with_duplicates(out, _mod(k, 100, 57)).drop("_k")


def raw(spark: SparkSession, sf_dir: str) -> RawTables:
    """The six raw retail tables (with ``seq``) as lazy DataFrames."""
    t = read_tpch(spark, sf_dir)
    base = _orders_base(t)
    return RawTables(
        customers=customers(t), products=products(t), stores=stores(t),
        orders=orders(t, base), order_items=order_items(t), payments=payments(t, base),
    )


def staged(spark: SparkSession, sf_dir: str, staging_dir: str) -> Callable[[str], DataFrame]:
    """The raw tables by name.  The clean-orders base, which rolls up all line items
    and feeds both orders and payments, is written to ``staging_dir`` when one of them
    is first asked for, and read back.

    With more than ``MANY_PARTS`` the priced line items, too, are written once, beside
    ``staging_dir``: base and order items would broadcast the prices at the same time.  Where
    ``part`` is too large for one broadcast in sets, they are priced in passes, each with a
    part of it, which move no line item."""
    t = read_tpch(spark, sf_dir)
    found: list[DataFrame] = []
    priced: list[DataFrame | None] = []
    lock, lines_lock = threading.Lock(), threading.Lock()

    def lines() -> DataFrame | None:
        with lines_lock:
            if not priced:
                rows = t["part"].count()
                n, path = passes(rows), f"{staging_dir.rstrip('/')}_lines"
                many = rows > MANY_PARTS or n > 1
                for i in range(n if many else 0):
                    part = t if n == 1 else t | {"part": nth(t["part"], "p_partkey", i, n), "lineitem": nth(t["lineitem"], "l_partkey", i, n)}
                    _item_lines(part, rows // n).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/pass={i}")
                priced.append(spark.read.parquet(path).drop("pass") if many else None)
            return priced[0]

    def base() -> DataFrame:
        with lock:
            if not found:
                _orders_base(t, lines()).write.mode("overwrite").option("compression", "zstd").parquet(staging_dir)
                found.append(spark.read.parquet(staging_dir))
            return found[0]

    makers = {"customers": lambda: customers(t), "products": lambda: products(t), "stores": lambda: stores(t),
              "orders": lambda: orders(t, base()), "order_items": lambda: order_items(t, lines()), "payments": lambda: payments(t, base())}
    return lambda name: makers[name]()
