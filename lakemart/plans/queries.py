"""Registry of the named queries (one per operator / question of the survey).

Each query is ``f(ctx) -> DataFrame``; ``ctx`` carries the session, the test
data folder and the lazily built layer model.  Outputs present exact decimals
as DOUBLE (``present``).
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from lakemart.functions.ratios import money_sum
from lakemart.operators import validate as V
from lakemart.operators.dedupe import dedupe_latest, dedupe_stored
from lakemart.operators.layout import z_value
from lakemart.plans import catalog, dq, metrics, star, timeintel
from lakemart.plans.silver import SILVER_COLUMNS
from lakemart.session import scratch_root
from lakemart.sources import bronze, publish, testdata
from lakemart.sources import schemas as S

# Fixed parameters of the registered queries.
SLICE_YEAR, SLICE_MONTH = 1998, 1
HISTOGRAM_WIDTH = 250_000
SLICERS = {"category": ["Economy", "Promo"], "customer_segment": ["BUILDING", "MACHINERY"]}
FACT_SLICE = {"store_key": (7, 7), "product_key": (100, 900), "year": (1996, 1999)}
DRIFT = {"changed": "77", "lost": "13", "doubled": "51"}
BATCH_ID = "20240101000000"


class Ctx:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def model(self):
        """The layers of the test folder, materialised by the pipeline once per
        application, each table when it is first asked for (see ``pipeline.lake_on_demand``)."""
        from lakemart.plans.pipeline import lake_on_demand
        return lake_on_demand(self.spark, self.sf_dir)

    @cached_property
    def tpch(self) -> dict[str, DataFrame]:
        return testdata.read_tpch(self.spark, self.sf_dir)


REGISTRY: dict[str, Callable[[Ctx], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def present(df: DataFrame) -> DataFrame:
    """Exact decimals -> DOUBLE in the outermost projection only."""
    cols = [F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


# ----- sources -------------------------------------------------------------

@register("scan_parquet")
def _scan(c: Ctx):
    li = c.tpch["lineitem"]
    return li.filter(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz")).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


@register("bronze_ingest")
def _bronze_ingest(c: Ctx):
    raw = c.model.bronze["customers"].drop("seq")
    return bronze.tag(raw, "customers.csv", BATCH_ID, with_timestamp=False)


@register("bronze_landing")
def _bronze_landing(c: Ctx):
    """All six sources through the real path: landed as files, ingested as one
    batch, read back; rows, keys and values that arrived."""
    from lakemart.plans import pipeline
    root = f"{scratch_root(c.spark)}/landing-{uuid.uuid4().hex}"
    raw = {t: df.drop("seq") for t, df in c.model.bronze.items()}
    lake = pipeline.Lake(f"{root}/lake")
    pipeline.ingest_landing(c.spark, bronze.write_raw_files(raw, f"{root}/files"), lake, BATCH_ID)
    parts = []
    for t, df in pipeline.read_bronze_lake(c.spark, lake).items():
        there = sum((F.count(F.nullif(F.col(f).cast("string"), F.lit(""))) for f in S.SOURCES[t].fieldNames()), F.lit(0))
        parts.append(df.groupBy("source_file", F.col("batch_id").cast("string").alias("batch_id"))
                     .agg(F.count("*").alias("row_count"), F.count_distinct(S.KEYS[t]).alias("key_count"),
                          there.cast("long").alias("value_count")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("row_count_audit")
def _row_count_audit(c: Ctx):
    m = c.model
    frames = [("bronze", t, m.bronze[t]) for t in m.bronze]
    frames += [("silver", t, m.silver(t)) for t in m.bronze]
    frames += [("quarantine", t, m.rejected(t)) for t in ("products", "orders", "order_items", "payments")]
    frames += [("gold", n, getattr(m, n)) for n in ("dim_customer", "dim_product", "dim_store", "dim_date",
                                                     "fact_sales")]
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(layer).alias("layer"), F.lit(t).alias("table_name"), "row_count") for layer, t, df in frames]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("handoff_reconcile")
def _handoff(c: Ctx):
    """Gold tables exported, read back from the export, and held against silver."""
    m, root = c.model, f"{scratch_root(c.spark)}/export-{uuid.uuid4().hex}"

    def handed(table: str) -> DataFrame:
        publish.export_table(getattr(m, table), f"{root}/{table}")
        back = c.spark.read.parquet(f"{root}/{table}")
        if not publish.schema_matches(getattr(m, table), back):
            raise ValueError(f"the export of {table} changed its schema")
        return back

    return publish.reconcile([
        ("fact_sales", m.silver_order_items, handed("fact_sales"), "quantity"),
        ("dim_customer", m.silver_customers, handed("dim_customer"), None),
        ("dim_product", m.silver_products, handed("dim_product"), "selling_price"),
        ("dim_store", m.silver_stores, handed("dim_store"), None),
    ])


@register("handoff_drift")
def _drift(c: Ctx):
    """An exported fact that lost, doubled and changed rows, held against its source by checksums."""
    fact, path = c.model.fact_sales, f"{scratch_root(c.spark)}/export-{uuid.uuid4().hex}"
    order = F.col("order_id")
    changed = F.when(order.endswith(DRIFT["changed"]), F.col("net_sales") + F.lit(1)).otherwise(F.col("net_sales"))
    sent = fact.where(~order.endswith(DRIFT["lost"])).withColumn("net_sales", changed.cast(fact.schema["net_sales"].dataType))
    publish.export_table(sent.unionByName(fact.where(order.endswith(DRIFT["doubled"]))), path)
    return publish.changed_rows(fact, c.spark.read.parquet(path), ["order_item_id"])


@register("dim_customer_lasting")
def _lasting(c: Ctx):
    """The customer dimension by a key registry that met some segments first, then all customers."""
    from lakemart.operators.keys import KeyRegistry
    from lakemart.plans import gold
    members = c.model.silver_customers
    registry = KeyRegistry(c.spark, f"{scratch_root(c.spark)}/keys-{uuid.uuid4().hex}", "customer_id", "customer_key")
    registry.extend(members.where(F.col("customer_segment").isin(*SLICERS["customer_segment"])), 0)
    return gold.dim_customer(members, registry.extend(members, 1))


@register("zorder_value")
def _zorder(c: Ctx):
    f = c.model.fact_sales
    return f.select("order_item_id", "store_key", "product_key",
                    z_value([F.col("store_key") - 1, F.col("product_key") - 1]).alias("z_value"))


# ----- silver, quarantine, joins --------------------------------------------

for _t in ("customers", "products", "stores", "orders", "order_items", "payments"):
    register(f"silver_{_t}")(lambda c, t=_t: c.model.silver(t))
for _t in ("products", "orders", "order_items", "payments"):
    register(f"{_t}_rejected")(lambda c, t=_t: c.model.rejected(t))


def incremental(c: Ctx):
    """Bronze of the test folder in three micro-batches, children before their
    parents: items and payments of a third of the orders arrive one batch early,
    customers of another third one batch late.  Built once per folder and application."""
    from lakemart.plans.model import FIXTURE_CONFIG
    from lakemart.streaming.silver_stream import IncrementalSilver
    key = (c.spark.sparkContext.applicationId, c.sf_dir)
    if key not in _INCREMENTAL:
        inc = IncrementalSilver(c.spark, f"{scratch_root(c.spark)}/incremental-{uuid.uuid4().hex}", FIXTURE_CONFIG, buckets=4)
        late = {"customers": ("customer_id", 1), "products": ("product_id", 1), "stores": ("store_id", 0), "orders": ("order_id", 1),
                "order_items": ("order_id", 0), "payments": ("order_id", 0)}

        def part(table: str, n: int) -> DataFrame:
            fk, shift = late[table]
            return c.model.bronze[table].filter(F.least(F.pmod(F.xxhash64(F.coalesce(fk, F.lit(""))), F.lit(3)) + shift, F.lit(2)) == n)

        for n in range(3):
            inc.apply({t: part(t, n) for t in late}, n)
        _INCREMENTAL[key] = inc
    return _INCREMENTAL[key]


_INCREMENTAL: dict = {}

for _t in ("orders", "order_items", "payments"):
    register(f"incremental_{_t}")(lambda c, t=_t: incremental(c).silver(t).select(*SILVER_COLUMNS[t]))


@register("incremental_rejections")
def _incremental_rejections(c: Ctx):
    from lakemart.plans.silver import rejection_summary
    return rejection_summary({t: incremental(c).rejected(t) for t in ("products", "orders", "order_items", "payments")})


@register("rejection_summary")
def _rej_summary(c: Ctx):
    from lakemart.plans.silver import rejection_summary
    m = c.model
    return rejection_summary({t: m.rejected(t) for t in ("products", "orders", "order_items", "payments")})


def _deduped_orders(c: Ctx):
    return dedupe_stored(c.model.bronze["orders"], "order_id", ("seq",))


def _orders_parent(c: Ctx):
    return V.absent(c.model.bronze["orders"], c.model.silver_customers, "customer_id")


@register("fk_valid_orders")
def _fk_valid(c: Ctx):
    return V.fk_valid(_deduped_orders(c), _orders_parent(c), "customer_id")


@register("fk_invalid_orders")
def _fk_invalid(c: Ctx):
    return V.fk_invalid(_deduped_orders(c), _orders_parent(c), "customer_id")


@register("dedupe_latest")
def _dedupe(c: Ctx):
    return dedupe_latest(c.tpch["lineitem"], ["l_orderkey", "l_linenumber"], ("l_shipdate",))


@register("orders_shipping_city")
def _ship(c: Ctx):
    return c.model.bronze["orders"].filter("seq = 0").select("order_id", "shipping_city")


@register("orders_total_rollup")
def _rollup(c: Ctx):
    t = testdata.order_totals(c.tpch)
    return t.select(F.format_string("ORD%08d", "l_orderkey").alias("order_id"), "total_amount")


# ----- gold ------------------------------------------------------------------

for _n in ("dim_customer", "dim_product", "dim_store", "dim_date"):
    register(_n)(lambda c, n=_n: getattr(c.model, n))


@register("fact_sales")
def _fact(c: Ctx):
    return c.model.fact_sales.drop("sales_key")


@register("fact_store_product")
def _fact_store_product(c: Ctx):
    """A store's sales of a range of products, from the files whose key ranges overlap."""
    return c.model.fact_where(**FACT_SLICE).drop("sales_key")


def month_sums(c: Ctx):
    """Month sums of the fact after two refreshes: the fact first lacks the rows of
    even stores in one month, which is then replaced whole."""
    from lakemart.plans import refresh
    key = (c.spark.sparkContext.applicationId, c.model.lake.root)
    with _MONTH_SUMS_LOCK:
        if key not in _MONTH_SUMS:
            root = f"{scratch_root(c.spark)}/refresh-{uuid.uuid4().hex[:12]}"
            late = (F.col("year") == SLICE_YEAR) & (F.col("month") == SLICE_MONTH) & (F.col("store_key") % 2 == 0)
            store = refresh.MonthSums(c.spark, f"{root}/fact", root)
            # the fact's files hold one month each
            refresh.replace_months(c.model.fact_sales.where(~late), store.fact_path, by_month=True)
            store.refresh(0)
            refresh.replace_months(c.model.fact_sales.where((F.col("year") == SLICE_YEAR) & (F.col("month") == SLICE_MONTH)), store.fact_path, by_month=True)
            store.refresh(1)
            _MONTH_SUMS[key] = store
        return _MONTH_SUMS[key]


_MONTH_SUMS: dict = {}
_MONTH_SUMS_LOCK = threading.Lock()


@register("refreshed_month_sums")
def _refreshed(c: Ctx):
    sums = month_sums(c).sums(1).groupBy("year", "month", "generation")
    return sums.agg(F.sum("items").alias("items"), money_sum("net_sales").alias("net_sales"), money_sum("profit").alias("profit"),
                    F.sum("quantity").cast("long").alias("quantity"))


def _on_sums(name: str, question):
    """A question answered from the refreshed month sums instead of the fact."""
    @register(name)
    def _answer(c: Ctx):
        from lakemart.plans.refresh import SumsModel
        return question(SumsModel(month_sums(c).sums(1), c.model))


_on_sums("refreshed_monthly_growth", metrics.monthly_growth)
_on_sums("refreshed_monthly_net_sales", metrics.monthly_net_sales)
_on_sums("refreshed_mom_growth", lambda m: timeintel.mom_growth(m.fact_sales))
_on_sums("refreshed_yoy_sales", lambda m: timeintel.yoy_sales(m.fact_sales))
_on_sums("refreshed_daily_trend", star.daily_sales_trend)


@register("fact_join_audit")
def _join_audit(c: Ctx):
    from lakemart.plans.gold import join_audit
    return join_audit(c.model.silver_order_items, c.model.fact_sales)


@register("fact_lost_items")
def _lost_items(c: Ctx):
    """Landed items that never reached the fact: rejected ones, and those of rejected orders."""
    from lakemart.plans import gold
    return gold.join_audit(c.model.bronze["order_items"], c.model.fact_sales)


@register("star_wide")
def _star_wide(c: Ctx):
    return star.star(c.model).drop("sales_key")


@register("month_slice")
def _month_slice(c: Ctx):
    return metrics.month_slice(c.model, SLICE_YEAR, SLICE_MONTH).drop("sales_key")


@register("distinct_orders_in_month")
def _dom(c: Ctx):
    return metrics.distinct_orders_in_month(c.model, SLICE_YEAR, SLICE_MONTH)


# ----- business metrics ------------------------------------------------------

register("bm01_total_revenue")(lambda c: metrics.total_revenue(c.model))
register("bm02_monthly_growth")(lambda c: metrics.monthly_growth(c.model))
register("bm03_avg_order_value")(lambda c: metrics.avg_order_value(c.model))
register("bm04_top_months")(lambda c: metrics.top_months(c.model))
register("bm05_revenue_by_category")(lambda c: metrics.revenue_by_category(c.model))
register("bm06_top_profit_products")(lambda c: metrics.top_profit_products(c.model))
register("bm07_declining_products")(lambda c: metrics.declining_products(c.model))
register("bm08_revenue_by_store")(lambda c: metrics.revenue_by_store(c.model))
register("bm09_top_margin_stores")(lambda c: metrics.top_margin_stores(c.model))
register("bm10_region_revenue_per_store")(lambda c: metrics.region_revenue_per_store(c.model))
register("bm11_revenue_by_segment")(lambda c: metrics.revenue_by_segment(c.model))
register("bm12_repeat_customer_rate")(lambda c: metrics.repeat_customer_rate(c.model))
register("bm13_avg_customer_value")(lambda c: metrics.avg_customer_value(c.model))
register("bm14_cancellation_rate")(lambda c: metrics.cancellation_rate(c.model))
register("bm15_return_rate")(lambda c: metrics.return_rate(c.model))
register("bm16_payment_failure_rate")(lambda c: metrics.payment_failure_rate(c.model))
register("month_slice_kpis")(lambda c: metrics.month_slice_kpis(c.model, SLICE_YEAR, SLICE_MONTH))
register("revenue_profit_by_category")(lambda c: metrics.revenue_profit_by_category(c.model))
register("monthly_net_sales")(lambda c: metrics.monthly_net_sales(c.model))
register("unknown_category_share")(lambda c: metrics.unknown_category_share(c.model))


# ----- the same questions as SQL text (compiled by Catalyst to the same plans) ----

for _n in ("total_revenue", "revenue_by_category", "monthly_net_sales", "cancellation_rate"):
    register(f"sql_{_n}")(lambda c, n=_n: catalog.run_sql_on(c.spark, n, c.model))

for _n in catalog.CHECKS:
    register(f"sql_{_n}")(lambda c, n=_n: catalog.run_sql_on(c.spark, n, c.model))


# ----- BI measures -------------------------------------------------------------

def _star(c: Ctx, *dims: str):
    return star.star(c.model, how="left", dims=list(dims))


KPI = ["total_sales", "total_profit", "total_orders", "avg_order_value", "profit_margin_pct"]

register("kpi_overview")(lambda c: star.measures(c.model.fact_sales, (), KPI + ["units_sold", "avg_selling_price"]))
register("repeat_customer_ratio")(lambda c: star.repeat_customer_ratio(c.model.fact_sales))
register("customer_count_by_segment")(lambda c: star.customer_count_by_segment(c.model))
register("kpi_by_subcategory")(lambda c: star.measures_by(c.model, "dim_product", ["subcategory"], KPI))
register("sales_by_region")(lambda c: star.measures_by(c.model, "dim_store", ["region"]))
register("sales_by_store")(lambda c: star.measures_by(c.model, "dim_store", ["store_id", "store_name"]))
register("daily_sales_trend")(lambda c: star.daily_sales_trend(c.model))
register("sales_sliced")(lambda c: star.measures(
    star.slice_(_star(c, "dim_product", "dim_customer", "dim_store"), **SLICERS), ["region"],
    ["total_sales", "total_orders"]))
register("profit_by_category")(lambda c: star.measures_by(c.model, "dim_product", ["category"],
                                                       ["total_sales", "total_profit"]))
register("sales_by_product")(lambda c: star.measures_by(c.model, "dim_product", ["product_id", "product_name"]))
register("sales_by_customer")(lambda c: star.measures_by(c.model, "dim_customer", ["customer_id"]))
register("store_performance")(lambda c: star.measures_by(c.model, "dim_store", ["store_id", "store_name"],
                                                      ["total_sales", "profit_margin_pct"]))
register("units_sold")(lambda c: star.measures(c.model.fact_sales, (), ["units_sold", "avg_selling_price"]))
register("revenue_by_channel")(lambda c: star.measures(c.model.fact_sales, ["order_channel"]))
register("orders_by_status")(lambda c: star.measures(c.model.fact_sales, ["order_status"],
                                                     ["total_orders", "total_sales"]))
register("product_margin")(lambda c: star.measures_by(c.model, "dim_product", ["product_id", "product_name"],
                                                   ["profit_margin_pct"]))
register("repeat_vs_new")(lambda c: star.repeat_vs_new(c.model))
register("customer_revenue_histogram")(lambda c: star.customer_revenue_histogram(c.model, HISTOGRAM_WIDTH))


def _ranked_products(c: Ctx, descending: bool, n: int = 10):
    # pick by the exact sum of each key, then measure the picked products only
    m = c.model
    per_key = m.fact_sales.groupBy("product_key").agg(F.sum("net_sales").alias("_exact"))
    ids = per_key.join(m.dim_product.select("product_key", "product_id"), "product_key")
    order = F.desc("_exact") if descending else F.asc("_exact")
    picked = ids.orderBy(order, "product_id").limit(n)
    s = star.measures_by(c.model, "dim_product", ["product_id", "product_name"])
    return s.join(F.broadcast(picked.select("product_id", "_exact")), "product_id").orderBy(order, "product_id").drop("_exact")


register("top10_products")(lambda c: _ranked_products(c, True))
register("bottom10_products")(lambda c: _ranked_products(c, False))
register("yoy_sales")(lambda c: timeintel.yoy_sales(c.model.fact_sales))
register("mom_growth_gap_aware")(lambda c: timeintel.mom_growth(c.model.fact_sales))


# ----- fault injection (over the clean silver tables) ------------------------------

@register("inject_duplicates")
def _inject_dups(c: Ctx):
    from lakemart.operators import faults
    return faults.strip_flags(faults.inject_duplicates(c.model.silver_customers, 0.01, "customer_id"))


@register("inject_nulls")
def _inject_nulls(c: Ctx):
    from lakemart.operators import faults
    return faults.strip_flags(faults.inject_nulls(c.model.silver_customers, "city", 0.02, "customer_id"))


@register("inject_inconsistent_case")
def _inject_case(c: Ctx):
    from lakemart.operators import faults
    return faults.strip_flags(faults.inject_inconsistent_case(c.model.silver_customers, "city", 0.03, "customer_id"))


@register("inject_invalid_numeric")
def _inject_numeric(c: Ctx):
    from lakemart.operators import faults
    return faults.strip_flags(faults.inject_invalid_numeric(c.model.silver_order_items, "quantity", 0.005, "order_item_id"))


@register("inject_invalid_fk")
def _inject_fk(c: Ctx):
    from lakemart.operators import faults
    return faults.strip_flags(faults.inject_invalid_fk(c.model.silver_orders, "customer_id", 0.01, "order_id", "CUST"))


def _register_issue_plan(table: str):
    """All rows of a table after its whole issue plan."""
    @register(f"injected_{table}")
    def _injected(c: Ctx):
        from lakemart.operators import faults
        return faults.strip_flags(faults.apply_issues(c.model.silver(table), S.KEYS[table], faults.ISSUE_PLANS[table]))


for _t in ("customers", "orders"):
    _register_issue_plan(_t)


@register("fault_injection_report")
def _fault_report(c: Ctx):
    from lakemart.operators import faults
    parts = []
    for table, issues in faults.ISSUE_PLANS.items():
        injected = faults.apply_issues(c.model.silver(table), S.KEYS[table], issues)
        parts.append(faults.issue_report(injected, table, issues))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ----- data quality --------------------------------------------------------------

register("dq_summary")(lambda c: dq.dq_summary(c.model))
register("dq_summary_bronze")(lambda c: dq.run_all_checks("bronze", dq.bronze_tables(c.model)))
register("dq_summary_silver")(lambda c: dq.run_all_checks("silver", dq.silver_tables(c.model)))
register("dq_summary_extended")(lambda c: dq.run_all_checks("bronze", dq.bronze_tables(c.model), extended=True)
                                .unionByName(dq.run_all_checks("silver", dq.silver_tables(c.model), extended=True)))


@register("dq_injected")
def _dq_injected(c: Ctx):
    """The suite over tables with known defects of every kind that it looks for."""
    from lakemart.operators import faults
    clean = dq.silver_tables(c.model)
    return dq.run_all_checks("injected", {t: faults.strip_flags(faults.apply_issues(clean[t], S.KEYS[t], faults.CHECK_PLANS[t]))
                                          for t in dq.TABLES})


def _dq_rows(check_name: str):
    def f(c: Ctx):
        return dq.dq_summary(c.model, only={check_name})
    return f


for _key, _check in {
    "dq_null_city": "Null city", "dq_null_category": "Null category",
    "dq_negative_quantity": "Negative quantity", "dq_invalid_price": "Invalid selling_price",
    "dq_invalid_payment": "Invalid payment_amount", "dq_invalid_dates": "Invalid order_date",
    "dq_invalid_status": "Invalid order_status", "dq_fk_orders_customers": "Invalid customer_id FK",
    "dq_fk_items_products": "Invalid product_id FK", "dq_fk_payments_orders": "Invalid order_id FK",
}.items():
    register(_key)(_dq_rows(_check))


@register("dq_duplicate_excess")
def _dup_excess(c: Ctx):
    return dq.dq_summary(c.model, only={"Duplicate customer_id", "Duplicate order_id", "Duplicate payment_id"})


def _bronze(c: Ctx):
    return dq.bronze_tables(c.model)


register("dq_duplicate_keys")(lambda c: dq.duplicate_customer_ids(_bronze(c)))
register("raw_validation")(lambda c: dq.raw_validation(_bronze(c)))
register("dqsql_01")(lambda c: dq.null_city_pct(_bronze(c)))
register("dqsql_02")(lambda c: dq.duplicate_customer_ids(_bronze(c)))
register("dqsql_03")(lambda c: dq.missing_category(_bronze(c)))
register("dqsql_04")(lambda c: dq.negative_quantities(_bronze(c)))
register("dqsql_05")(lambda c: dq.invalid_prices(_bronze(c)))
register("dqsql_06")(lambda c: dq.invalid_payment_amounts(_bronze(c)))
register("dqsql_07")(lambda c: dq.fk_orders_customers(_bronze(c)))
register("dqsql_07b")(lambda c: dq.fk_items_products(_bronze(c)))
register("dqsql_07c")(lambda c: dq.fk_payments_orders(_bronze(c)))
register("dqsql_08")(lambda c: dq.invalid_order_dates(_bronze(c)))
register("dqsql_09a")(lambda c: dq.invalid_order_statuses(_bronze(c)))
register("dqsql_09b")(lambda c: dq.invalid_payment_statuses(_bronze(c)))


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(REGISTRY[name](Ctx(spark, sf_dir)))
