"""Hot keys: one key holds a third of all rows.  Results must stay whole and
exact; the plans must reduce the hot group map-side (partial aggregation)."""

from pyspark.sql import functions as F

from lakemart.operators import quality as Q
from lakemart.operators.dedupe import dedupe_latest
from lakemart.plans import silver
from lakemart.plans.silver import SilverConfig

N = 30_000


def _items(spark):
    i = F.col("id")
    hot = (i % 3 == 0)
    return spark.range(N).select(
        F.when(hot, F.lit("OI-HOT")).otherwise(F.format_string("OI-%06d", i)).alias("order_item_id"),
        F.when(i % 3 == 1, F.lit("ORD-HOT")).otherwise(F.format_string("ORD-%05d", i % 5000)).alias("order_id"),
        F.when(i % 3 == 2, F.lit("PROD-HOT")).otherwise(F.format_string("PROD-%04d", i % 700)).alias("product_id"),
        (i % 7 - 1).alias("quantity"),
        F.lit(10).cast("decimal(12,2)").alias("unit_price"),
        F.lit(5).cast("decimal(5,2)").alias("discount_percentage"),
        F.lit(12).cast("decimal(5,2)").alias("tax_percentage"),
        F.lit(1).cast("decimal(18,2)").alias("line_amount"),
        F.lit(1).cast("decimal(18,4)").alias("cost_amount"),
        (i % 11).cast("int").alias("seq"),
    ).repartition(6)


def test_hot_dedupe_key_is_reduced_map_side(spark):
    items = _items(spark)
    d = dedupe_latest(items, "order_item_id", ("seq",))
    assert d.count() == N - N // 3 + 1
    hot = d.filter("order_item_id = 'OI-HOT'").first()
    assert hot.seq == 10  # the latest copy wins
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_hot_foreign_keys_classify_exactly(spark):
    items = _items(spark)
    orders = spark.range(5000).select(F.format_string("ORD-%05d", "id").alias("order_id"))
    orders = orders.union(spark.createDataFrame([("ORD-HOT",)], "order_id string"))
    products = spark.range(700).select(F.format_string("PROD-%04d", "id").alias("product_id"))
    c = silver.order_items(items, orders, products, SilverConfig(order_cols=("seq",)))
    got = {r.rejected_reason: r.n for r in c.groupBy("rejected_reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    d = dedupe_latest(items, "order_item_id", ("seq",)).toPandas()
    want_neg = int((d.quantity <= 0).sum())
    want_prod = int(((d.quantity > 0) & (d.product_id == "PROD-HOT")).sum())
    assert got.get("negative_quantity") == want_neg
    assert got.get("invalid_product_fk", 0) == want_prod
    assert sum(got.values()) == len(d)  # whole: nothing dropped or duplicated


def test_hot_key_dq_counts(spark):
    items = _items(spark)
    products = spark.range(700).select(F.format_string("PROD-%04d", "id").alias("product_id"))
    out = Q.table_checks("bronze", "order_items", items, "order_item_id",
                         [Q.ScalarCheck("Negative quantity", Q.is_negative("quantity"))],
                         [Q.FkCheck("Invalid product_id FK", "product_id", products)])
    got = {r.check_name: r.failed_records for r in out.collect()}
    assert got["Duplicate order_item_id"] == N // 3 - 1
    assert got["Invalid product_id FK"] == N // 3
    assert got["Negative quantity"] == items.filter("quantity < 0").count()


def test_hot_key_of_a_unique_parent_is_split(spark):
    """Nothing stands between the shuffle and the join, so AQE splits the hot key."""
    from lakemart.operators import validate as V
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        child = spark.range(0, 400_000, 1, 8).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"))
        parent = spark.range(0, 50_000, 1, 4).select(F.col("id").cast("string").alias("k")).union(
            spark.createDataFrame([("HOT",)], "k string"))
        d = V.with_parent(child, parent, "k", "hit", unique=True)
        out = d.groupBy("hit").count()
        got = {r.hit: r["count"] for r in out.collect()}
        known = 133_334 + sum(1 for i in range(50_000) if i % 3)
        assert got == {True: known, None: 400_000 - known}
        d.collect()
        assert "skew=true" in d._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in confs:
            spark.conf.unset(k)
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_additive_measures_are_summed_before_the_join(spark):
    from lakemart.plans import star

    class M:
        fact_sales = spark.range(1000).select((F.col("id") % 7).alias("customer_key"),
                                              F.lit(2).cast("decimal(18,2)").alias("net_sales"),
                                              F.lit(1).cast("decimal(18,2)").alias("profit"), F.lit(3).alias("quantity"))
        dim_customer = spark.range(6).select(F.col("id").alias("customer_key"), *[
            F.concat(F.lit("x"), F.col("id") % 2).alias(c) for c in
            ("customer_id", "customer_segment", "city", "state", "gender", "customer_status")])

    out = star.measures_by(M, "dim_customer", ["customer_segment"], ["total_sales", "units_sold", "profit_margin_pct"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.rindex("Aggregate [customer_key")
    got = {r.customer_segment: (r.total_sales, r.units_sold, r.profit_margin_pct) for r in out.collect()}
    per = [sum(1 for i in range(1000) if i % 7 == k) for k in range(7)]
    want = {"x0": per[0] + per[2] + per[4], "x1": per[1] + per[3] + per[5], None: per[6]}
    assert got == {k: (2.0 * n, 3 * n, 0.5) for k, n in want.items()}
