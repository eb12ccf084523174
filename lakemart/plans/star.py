"""BI-style measures over the star: ``star()`` joins the dimensions,
``slice()`` applies dimension filters, ``measures()`` evaluates named
aggregates in any grouping context (the filter/group context of a report
visual becomes ``filter`` + ``groupBy``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.ratios import money_sum, safe_div

# Dimension attributes exposed on the wide star; city/state exist on two
# dimensions and are prefixed.
STAR_ATTRIBUTES = {
    "dim_customer": ("customer_key", {"customer_id": "customer_id", "customer_segment": "customer_segment",
                                      "city": "customer_city", "state": "customer_state", "gender": "gender",
                                      "customer_status": "customer_status"}),
    "dim_product": ("product_key", {"product_id": "product_id", "product_name": "product_name",
                                    "category": "category", "subcategory": "subcategory", "brand": "brand",
                                    "supplier": "supplier"}),
    "dim_store": ("store_key", {"store_id": "store_id", "store_name": "store_name", "city": "store_city",
                                "state": "store_state", "region": "region", "store_type": "store_type"}),
    "dim_date": ("date_key", {"full_date": "full_date", "quarter": "quarter", "month_name": "month_name",
                              "day_of_week": "day_of_week", "is_weekend": "is_weekend"}),
}


def star(m, how: str = "left", dims: Sequence[str] | None = None) -> DataFrame:
    """Fact with the attributes of its many-to-one dimensions.  Left joins keep
    a fact row whose key has no dimension row (blank member).  A dimension is
    broadcast when the model knows its (bounded) row count; ``dim_date`` is
    joined on (date_key, year, month) so a filter on calendar attributes
    prunes fact partitions dynamically."""
    return _with_dims(m.fact_sales, m, how, dims or STAR_ATTRIBUTES)


def _with_dims(f: DataFrame, m, how: str, dims: Sequence[str]) -> DataFrame:
    from lakemart.operators.joins import maybe_broadcast
    for name in dims:
        key, attrs = STAR_ATTRIBUTES[name]
        keys = [key, "year", "month"] if name == "dim_date" else [key]
        d = getattr(m, name).select(*keys, *[F.col(src).alias(dst) for src, dst in attrs.items()])
        rows = getattr(m, "dim_rows", None) or {}  # a lake on demand counts a dimension when it is first read
        f = f.join(maybe_broadcast(d, rows.get(name)), keys, how)
    return f


def date_slice(m, **calendar_filters) -> DataFrame:
    """Fact rows of the calendar days matching ``column=[values]`` filters on
    dim_date (e.g. ``year=[1998], quarter=[1]``): a semi join on
    (date_key, year, month), which Spark turns into partition pruning of the
    stored fact."""
    d = slice_(m.dim_date, **calendar_filters).select("date_key", "year", "month")
    return m.fact_sales.join(d, ["date_key", "year", "month"], "left_semi")


def slice_(df: DataFrame, **filters) -> DataFrame:
    """Dimension slicers: ``column=[values]`` becomes ``column IN (values)``."""
    for col, values in filters.items():
        vals = [values] if isinstance(values, (str, int, float)) else list(values)
        df = df.filter(F.col(col).isin(vals))
    return df


def _measure_columns() -> dict[str, Column]:
    return {
        "total_sales": money_sum("net_sales"),
        "total_profit": money_sum("profit"),
        "total_orders": F.count_distinct("order_id"),
        "avg_order_value": safe_div(F.sum("net_sales"), F.count_distinct("order_id")),
        "profit_margin_pct": safe_div(F.sum("profit"), F.sum("net_sales")),
        "units_sold": F.sum("quantity").cast("long"),
        "avg_selling_price": safe_div(F.sum("net_sales"), F.sum("quantity")),
        "total_customers": F.count_distinct("customer_key"),
    }


MEASURES = tuple(["total_sales", "total_profit", "total_orders", "avg_order_value", "profit_margin_pct",
                  "units_sold", "avg_selling_price", "total_customers"])


def measures(df: DataFrame, by: Sequence[str] = (), which: Sequence[str] = ("total_sales",)) -> DataFrame:
    cols = _measure_columns()
    aggs = [cols[w].alias(w) for w in which]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


#: Measures that sums per dimension key determine.
ADDITIVE = frozenset(("total_sales", "total_profit", "profit_margin_pct", "units_sold", "avg_selling_price"))


def measures_by(m, dim: str, by: Sequence[str], which: Sequence[str] = ("total_sales",)) -> DataFrame:
    """Measures by attributes of one dimension.  Additive measures reduce the
    fact to exact sums per surrogate key before the dimension is joined, so the
    join never runs at item grain; distinct counts need the item-grain join."""
    if not ADDITIVE.issuperset(which):
        return measures(star(m, dims=[dim]), by, which)
    key = STAR_ATTRIBUTES[dim][0]
    sums = m.fact_sales.groupBy(key).agg(*[F.sum(c).alias(c) for c in ("net_sales", "profit", "quantity")])
    return measures(_with_dims(sums, m, "left", [dim]), by, which)


def repeat_customer_ratio(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Customers with more than one distinct order / customers, per group
    (0..1, NULL on an empty group).  First level: distinct (group, customer,
    order) triples; second: orders per customer; third: the ratio."""
    by = list(by)
    triples = df.select(*by, "customer_key", "order_id").distinct()
    per_c = triples.groupBy(*by, "customer_key").agg(F.count(F.lit(1)).alias("_orders"))
    aggs = [safe_div(F.count_if(F.col("_orders") > 1), F.count(F.lit(1))).alias("repeat_customer_ratio")]
    return per_c.groupBy(*by).agg(*aggs) if by else per_c.agg(*aggs)


def customer_revenue(df: DataFrame) -> DataFrame:
    return df.groupBy("customer_key").agg(F.sum("net_sales").alias("_rev"),
                                          F.count_distinct("order_id").alias("_orders"))


def repeat_vs_new(m) -> DataFrame:
    c = customer_revenue(m.fact_sales)
    kind = F.when(F.col("_orders") > 1, "Repeat").otherwise("New")
    return (c.groupBy(kind.alias("customer_type"))
            .agg(F.count(F.lit(1)).alias("customers"), money_sum("_rev").alias("total_sales")))


def customer_revenue_histogram(m, width: int = 250_000) -> DataFrame:
    """Customers per revenue bucket [k*width, (k+1)*width)."""
    c = m.fact_sales.groupBy("customer_key").agg(F.sum("net_sales").alias("_rev"))
    bucket = F.floor(F.col("_rev") / F.lit(width)).cast("long")
    return (c.groupBy(bucket.alias("bucket"))
            .agg(F.count(F.lit(1)).alias("customers"))
            .withColumn("bucket_start", (F.col("bucket") * width).cast("double")))


def daily_sales_trend(m) -> DataFrame:
    """Every calendar day, empty days with 0 (left join from dim_date)."""
    daily = m.fact_sales.groupBy("date_key").agg(F.sum("net_sales").alias("_rev"))
    return (m.dim_date.select("full_date", "date_key").join(daily, "date_key", "left")
            .select("full_date", F.coalesce(F.col("_rev").cast("double"), F.lit(0.0)).alias("total_sales")))


def customer_count_by_segment(m) -> DataFrame:
    """Counts customers of the dimension, with or without orders."""
    return m.dim_customer.groupBy("customer_segment").agg(F.count_distinct("customer_id").alias("customer_count"))
