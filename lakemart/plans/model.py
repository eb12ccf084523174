"""Lazy layer model: bronze frames in, every silver/gold frame out on demand.

``Model`` builds the whole chain as one lazy plan (no writes); it exposes the
same attributes as ``pipeline.StoredModel`` (the written lake), so every
metric, measure and DQ function runs on either, and tests check that both
give the same answers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lakemart.plans import gold, silver
from lakemart.plans.silver import SilverConfig
from lakemart.sources import testdata

FIXTURE_CONFIG = SilverConfig(order_cols=("seq",))


class Tables(Mapping):
    """Tables by name, each read when it is first asked for."""

    def __init__(self, names: Iterable[str], read: Callable[[str], DataFrame]):
        self._names, self._read = tuple(names), read

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        return self._read(name)

    def __contains__(self, name) -> bool:
        return name in self._names

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class Model:
    def __init__(self, bronze: dict[str, DataFrame], cfg: SilverConfig = SilverConfig(),
                 dim_rows: dict[str, int] | None = None):
        self.bronze = bronze
        self.cfg = cfg
        self.dim_rows = dim_rows

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, cfg: SilverConfig = FIXTURE_CONFIG) -> "Model":
        return cls(testdata.raw(spark, sf_dir).as_dict(), cfg)

    # ----- classified silver frames --------------------------------------
    @cached_property
    def customers_c(self) -> DataFrame:
        return silver.customers(self.bronze["customers"], self.cfg)

    @cached_property
    def products_c(self) -> DataFrame:
        return silver.products(self.bronze["products"], self.cfg)

    @cached_property
    def stores_c(self) -> DataFrame:
        return silver.stores(self.bronze["stores"], self.cfg)

    @cached_property
    def orders_c(self) -> DataFrame:
        return silver.orders(self.bronze["orders"], self.silver_customers, self.cfg, self.silver_stores)

    @cached_property
    def order_keys(self) -> DataFrame:
        return gold.order_keys(self.silver_orders, self.dim_customer, self.dim_store, self.dim_date, self.dim_rows)

    @cached_property
    def order_items_c(self) -> DataFrame:
        return silver.order_items(self.bronze["order_items"], self.order_keys, self.dim_product, self.cfg,
                                  silver.ORDER_CARRY, silver.PRODUCT_CARRY)

    @cached_property
    def payments_c(self) -> DataFrame:
        return silver.payments(self.bronze["payments"], self.silver_orders, self.cfg)

    def classified(self) -> dict[str, DataFrame]:
        return {"customers": self.customers_c, "products": self.products_c, "stores": self.stores_c,
                "orders": self.orders_c, "order_items": self.order_items_c, "payments": self.payments_c}

    # ----- silver and quarantine -----------------------------------------
    def silver(self, table: str) -> DataFrame:
        return silver.silver_view(getattr(self, f"{table}_c"), table)

    def rejected(self, table: str) -> DataFrame:
        return silver.rejected_view(getattr(self, f"{table}_c"), self.bronze[table].columns)

    silver_customers = cached_property(lambda self: self.silver("customers"))
    silver_products = cached_property(lambda self: self.silver("products"))
    silver_stores = cached_property(lambda self: self.silver("stores"))
    silver_orders = cached_property(lambda self: self.silver("orders"))
    silver_order_items = cached_property(lambda self: self.silver("order_items"))
    silver_payments = cached_property(lambda self: self.silver("payments"))

    @cached_property
    def items_enriched(self) -> DataFrame:
        return silver.enriched_items(self.order_items_c)

    # ----- gold ----------------------------------------------------------
    @cached_property
    def dim_customer(self) -> DataFrame:
        return gold.dim_customer(self.silver_customers)

    @cached_property
    def dim_product(self) -> DataFrame:
        return gold.dim_product(self.silver_products)

    @cached_property
    def dim_store(self) -> DataFrame:
        return gold.dim_store(self.silver_stores)

    @cached_property
    def dim_date(self) -> DataFrame:
        return gold.dim_date(self.silver_orders)

    @cached_property
    def fact_sales(self) -> DataFrame:
        return gold.fact_sales(self.items_enriched)
