"""Business metrics over the gold star schema (one function per question).

Each function takes a model exposing ``fact_sales``, the ``dim_*`` tables and
the silver ``orders``/``payments`` tables and returns a lazy DataFrame.
Aggregate before joining: the fact is reduced to the grouping key first and
only the (small) aggregate meets the dimension.  Money sums are exact decimals
presented as DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions.ratios import growth_pct, money_per, money_sum, pct_of_counts, safe_div

NET, PROFIT = "net_sales", "profit"


def _month_names(m) -> DataFrame:
    return m.dim_date.select("year", "month", "month_name").distinct()


def total_revenue(m) -> DataFrame:
    return m.fact_sales.agg(money_sum(NET).alias("total_revenue"))


def monthly_growth(m) -> DataFrame:
    """LAG over the existing months (a missing month compares with an older one;
    see ``timeintel.mom_growth`` for the calendar-aware form)."""
    monthly = m.fact_sales.groupBy("year", "month").agg(F.sum(NET).alias("_rev"))
    w = Window.orderBy("year", "month")  # one row per month: bounded single-task window
    prev = F.lag("_rev").over(w)
    return monthly.select(
        "year", "month", F.col("_rev").cast("double").alias("monthly_revenue"),
        prev.cast("double").alias("prev_month_revenue"),
        growth_pct(F.col("_rev"), prev).alias("mom_growth_pct"),
    ).orderBy("year", "month")


def avg_order_value(m) -> DataFrame:
    f = m.fact_sales
    return f.agg(money_per(F.sum(NET), F.count_distinct("order_id")).alias("avg_order_value"))


def top_months(m, n: int = 10) -> DataFrame:
    monthly = m.fact_sales.groupBy("year", "month").agg(F.sum(NET).alias("_rev"))
    order = [F.desc("_rev"), F.col("year"), F.col("month")]
    top = monthly.orderBy(*order).limit(n)
    return (top.join(_month_names(m), ["year", "month"]).orderBy(*order)
            .select("year", "month", "month_name", F.col("_rev").cast("double").alias("monthly_revenue")))


def _by_product(m, cols, measures) -> DataFrame:
    per_key = m.fact_sales.groupBy("product_key").agg(*measures)
    return per_key.join(m.dim_product.select("product_key", *cols), "product_key")


def revenue_by_category(m) -> DataFrame:
    return (_by_product(m, ["category"], [F.sum(NET).alias("_rev")])
            .groupBy("category").agg(F.sum("_rev").alias("_rev")).orderBy(F.desc("_rev"), "category")
            .select("category", F.col("_rev").cast("double").alias("total_revenue")))


def top_profit_products(m, n: int = 20) -> DataFrame:
    p = _by_product(m, ["product_id", "product_name"], [F.sum(PROFIT).alias("_profit")])
    return (p.orderBy(F.desc("_profit"), "product_id").limit(n)
            .select("product_id", "product_name", F.col("_profit").cast("double").alias("total_profit")))


def declining_products(m) -> DataFrame:
    """Product-months whose revenue fell against the product's previous
    active month.  The LAG runs per product key (1:1 with product_id) over the
    product-month aggregate -- at most one row per month per partition,
    whatever the product's sales volume -- and names are joined only to the
    declining rows."""
    pm = m.fact_sales.groupBy("product_key", "year", "month").agg(F.sum(NET).alias("_rev"))
    w = Window.partitionBy("product_key").orderBy("year", "month")
    pm = pm.withColumn("_prev", F.lag("_rev").over(w))
    down = pm.filter(F.col("_prev").isNotNull() & (F.col("_rev") < F.col("_prev")))
    down = down.join(m.dim_product.select("product_key", "product_id", "product_name"), "product_key")
    return down.select("product_id", "product_name", "year", "month",
                       F.col("_rev").cast("double").alias("revenue"),
                       F.col("_prev").cast("double").alias("prev_revenue"),
                       growth_pct(F.col("_rev"), F.col("_prev")).alias("mom_change_pct")
                       ).orderBy("product_id", "year", "month")


def _by_store(m, cols, measures) -> DataFrame:
    per_key = m.fact_sales.groupBy("store_key").agg(*measures)
    return per_key.join(m.dim_store.select("store_key", *cols), "store_key")


def revenue_by_store(m) -> DataFrame:
    s = _by_store(m, ["store_id", "store_name", "region"], [F.sum(NET).alias("_rev")])
    return (s.groupBy("store_id", "store_name", "region")
            .agg(F.sum("_rev").alias("_rev")).orderBy(F.desc("_rev"), "store_id")
            .select("store_id", "store_name", "region", F.col("_rev").cast("double").alias("total_revenue")))


def top_margin_stores(m, n: int = 20) -> DataFrame:
    s = _by_store(m, ["store_id", "store_name"], [F.sum(PROFIT).alias("_p"), F.sum(NET).alias("_n")])
    s = (s.groupBy("store_id", "store_name")
         .agg(safe_div(F.sum("_p"), F.sum("_n")).alias("profit_margin")))
    return s.orderBy(F.desc_nulls_last("profit_margin"), "store_id").limit(n)


def region_revenue_per_store(m) -> DataFrame:
    """Only stores with sales count towards a region's store_count."""
    s = _by_store(m, ["store_id", "region"], [F.sum(NET).alias("_rev")])
    r = s.groupBy("region").agg(F.count_distinct("store_id").alias("store_count"),
                                F.sum("_rev").alias("_rev"))
    return r.select("region", "store_count", F.col("_rev").cast("double").alias("total_revenue"),
                    safe_div(F.col("_rev"), F.col("store_count")).alias("revenue_per_store")
                    ).orderBy("revenue_per_store", "region")


def revenue_by_segment(m) -> DataFrame:
    per_c = m.fact_sales.groupBy("customer_key").agg(F.sum(NET).alias("_rev"))
    j = per_c.join(m.dim_customer.select("customer_key", "customer_segment"), "customer_key")
    return (j.groupBy("customer_segment").agg(F.sum("_rev").alias("_rev")).orderBy(F.desc("_rev"), "customer_segment")
            .select("customer_segment", F.col("_rev").cast("double").alias("total_revenue")))


def _orders_per_customer(fact: DataFrame) -> DataFrame:
    """Distinct orders per customer: dedupe (customer, order) pairs with a
    partial aggregate first, then count per customer."""
    pairs = fact.select("customer_key", "order_id").distinct()
    return pairs.groupBy("customer_key").agg(F.count(F.lit(1)).alias("order_count"))


def repeat_customer_rate(m) -> DataFrame:
    opc = _orders_per_customer(m.fact_sales)
    return opc.agg(pct_of_counts(F.count_if(F.col("order_count") > 1), F.count(F.lit(1)))
                   .alias("repeat_customer_rate_pct"))


def avg_customer_value(m) -> DataFrame:
    f = m.fact_sales
    return f.agg(money_per(F.sum(NET), F.count_distinct("customer_key")).alias("avg_customer_value"))


def _status_rate(m, status: str, name: str) -> DataFrame:
    o = m.silver_orders
    return o.agg(pct_of_counts(F.count_if(F.col("order_status") == status), F.count(F.lit(1))).alias(name))


def cancellation_rate(m) -> DataFrame:
    return _status_rate(m, "Cancelled", "cancellation_rate_pct")


def return_rate(m) -> DataFrame:
    return _status_rate(m, "Returned", "return_rate_pct")


def payment_failure_rate(m) -> DataFrame:
    p = m.silver_payments
    g = p.groupBy("payment_method").agg(F.count(F.lit(1)).alias("total_payments"),
                                        F.count_if(F.col("payment_status") == "Failed").alias("failed_payments"))
    return (g.withColumn("failure_rate_pct", pct_of_counts("failed_payments", "total_payments"))
            .orderBy(F.desc("failure_rate_pct"), "payment_method"))


def month_slice(m, year: int, month: int) -> DataFrame:
    """Fact rows of one month: a static partition filter on the stored fact."""
    return m.fact_sales.filter((F.col("year") == year) & (F.col("month") == month))


def month_slice_kpis(m, year: int, month: int) -> DataFrame:
    """Revenue, distinct orders and profit of one month in a single pass."""
    s = month_slice(m, year, month)
    return s.agg(money_sum(NET).alias("total_revenue"), F.count_distinct("order_id").alias("total_orders"),
                 money_sum(PROFIT).alias("total_profit"))


def distinct_orders_in_month(m, year: int, month: int) -> DataFrame:
    return month_slice(m, year, month).select("order_id").distinct()


def revenue_profit_by_category(m) -> DataFrame:
    p = _by_product(m, ["category"], [F.sum(NET).alias("_n"), F.sum(PROFIT).alias("_p")])
    c = p.groupBy("category").agg(F.sum("_n").alias("_n"), F.sum("_p").alias("_p"))
    return c.orderBy(F.desc("_n"), "category").select(
        "category", F.col("_n").cast("double").alias("total_net_sales"), F.col("_p").cast("double").alias("total_profit"))


def monthly_net_sales(m) -> DataFrame:
    monthly = m.fact_sales.groupBy("year", "month").agg(money_sum(NET).alias("monthly_net_sales"))
    return (monthly.join(_month_names(m), ["year", "month"])
            .select("month_name", "year", "month", "monthly_net_sales").orderBy("year", "month"))


def unknown_category_share(m) -> DataFrame:
    p = _by_product(m, ["category"], [F.sum(NET).alias("_n")])
    unknown = F.sum(F.when(F.col("category") == "Unknown", F.col("_n")))
    return p.agg(F.coalesce(unknown, F.lit(0)).cast("double").alias("unknown_revenue"),
                 money_sum("_n").alias("total_revenue"),
                 safe_div(F.coalesce(unknown, F.lit(0)), F.sum("_n")).alias("unknown_share"))
