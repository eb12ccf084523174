"""Silver by micro-batches equals one run over all rows, whatever the order of arrival."""

import os

import pytest
from pyspark.sql import functions as F

from lakemart.plans.model import Model
from lakemart.plans.silver import SilverConfig
from lakemart.streaming.silver_stream import IncrementalSilver, silver_stream

CFG = SilverConfig(order_cols=("seq",))


def _bronze(spark):
    """Six tables of a few rows with late parents, a rejected parent and newer versions."""
    c = spark.createDataFrame([(f"C{i}", "a", "b", "F", None, "x y" if i % 2 else None, "s", "US", None, "seg", "e", "Active", 0) for i in range(6)],
                              "customer_id string, first_name string, last_name string, gender string, date_of_birth date, city string, state string, "
                              "country string, signup_date date, customer_segment string, email string, customer_status string, seq int")
    p = spark.createDataFrame([(f"P{i}", "n", "cat", "sub", "b", "s", 1.0, price, None, "Active", seq)
                               for i, price, seq in [(0, 5.0, 0), (1, -1.0, 0), (1, 2.0, 1), (2, 3.0, 0), (2, 0.0, 1), (3, None, 0), (4, 1.0, 0)]],
                              "product_id string, product_name string, category string, subcategory string, brand string, supplier string, unit_cost double, "
                              "selling_price double, launch_date date, product_status string, seq int")
    s = spark.createDataFrame([("S1", "n", "c", "st", "r", "t", None, "m", 0)],
                              "store_id string, store_name string, city string, state string, region string, store_type string, opening_date date, manager_id string, seq int")
    o = spark.createDataFrame([(f"O{i}", f"C{i % 8}" if i % 5 else None, "S1", None, None, "Completed" if i % 3 else "odd", "Card", "Web", "c", float(i) if i % 4 else None, 0)
                               for i in range(20)] + [("O1", "C77", "S1", None, None, "Completed", "Card", "Web", "c", 1.0, 1), ("O6", "C0", "S1", None, None, "Completed", "Card", "Web", "c", 1.0, 1)],
                              "order_id string, customer_id string, store_id string, order_date date, order_timestamp timestamp, order_status string, payment_method string, "
                              "order_channel string, shipping_city string, total_amount double, seq int")
    i = spark.createDataFrame([(f"I{k}", f"O{k % 23}", f"P{k % 6}", k % 7 - 1 if k % 9 else None, 2.0, 0.0, 0.0, 1.0, 1.0, 0) for k in range(80)]
                              + [("I3", "O4", "P0", 5, 2.0, 0.0, 0.0, 1.0, 1.0, 1)],
                              "order_item_id string, order_id string, product_id string, quantity int, unit_price double, discount_percentage double, tax_percentage double, "
                              "line_amount double, cost_amount double, seq int")
    y = spark.createDataFrame([(f"Y{k}", f"O{k % 23}", None, "Card", "Paid", float(k % 5 - 1), None, 0) for k in range(40)],
                              "payment_id string, order_id string, payment_date date, payment_method string, payment_status string, payment_amount double, "
                              "transaction_reference string, seq int")
    return {"customers": c, "products": p, "stores": s, "orders": o, "order_items": i, "payments": y}


def _rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def _same(inc, model):
    for t in ("customers", "products", "stores", "orders", "order_items", "payments"):
        assert _rows(inc.silver(t)) == _rows(model.silver(t)), t
        if t not in ("customers", "stores"):
            assert _rows(inc.rejected(t)) == _rows(model.rejected(t)), t


@pytest.mark.parametrize("first", ["children", "parents"])
def test_three_batches_equal_one_run(spark, tmp_dir, first):
    bronze = _bronze(spark)
    inc = IncrementalSilver(spark, os.path.join(tmp_dir, "inc"), CFG, buckets=3)
    order = [["order_items", "payments"], ["orders", "stores"], ["customers", "products"]]
    order = order if first == "children" else order[::-1]
    for n, tables in enumerate(order):
        batch = {t: bronze[t].filter("seq = 0") for t in tables}
        if n == 2:  # newer versions of rows of all tables arrive last
            batch |= {t: (batch[t].unionByName(bronze[t].filter("seq = 1")) if t in batch else bronze[t].filter("seq = 1")) for t in bronze if t != "stores"}
        assert inc.apply(batch, n)
    _same(inc, Model(bronze, CFG))
    assert not inc.apply({"orders": bronze["orders"].filter("order_id = 'none'")}, 2)  # a replay


def test_a_failed_batch_leaves_the_last_one_and_is_applied_again(spark, tmp_dir):
    bronze = _bronze(spark)
    root = os.path.join(tmp_dir, "inc")
    inc = IncrementalSilver(spark, root, CFG, buckets=3)
    inc.apply({t: df.filter("seq = 0") for t, df in bronze.items() if t != "customers"}, 0)
    held = _rows(inc.rejected("orders"))
    broken = bronze["orders"].withColumn("total_amount", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        inc.apply({"customers": bronze["customers"], "orders": broken}, 1)
    assert _rows(inc.rejected("orders")) == held
    again = IncrementalSilver(spark, root, CFG, buckets=3)
    assert again.restore() == 0 and _rows(again.rejected("orders")) == held
    again.apply({t: df for t, df in bronze.items() if t == "customers"} | {t: df.filter("seq = 1") for t, df in bronze.items() if t != "customers"}, 1)
    _same(again, Model(bronze, CFG))


def test_only_changed_buckets_are_written(spark, tmp_dir):
    bronze = _bronze(spark)
    inc = IncrementalSilver(spark, os.path.join(tmp_dir, "inc"), CFG, buckets=8)
    inc.apply(bronze, 0)
    inc.apply({"payments": bronze["payments"].filter("payment_id = 'Y7'")}, 1)
    assert sum(v == 1 for k, v in inc.versions.items() if k[0] == "silver") == 1
    assert {k[1] for k, v in inc.versions.items() if v == 1} == {"payments"}
    _same(inc, Model(bronze, CFG))


def test_streams_of_bronze_files(spark, tmp_dir):
    bronze = _bronze(spark)
    for t, df in bronze.items():
        df.repartition(2).write.parquet(os.path.join(tmp_dir, "bronze", t))
    inc = IncrementalSilver(spark, os.path.join(tmp_dir, "inc"), CFG, buckets=2)
    streams = {t: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", "1").parquet(os.path.join(tmp_dir, "bronze", t)) for t, df in bronze.items()
               if t in ("orders", "customers", "stores", "products", "payments")}
    silver_stream(inc, streams, os.path.join(tmp_dir, "ckpt"))
    n = inc.applied
    silver_stream(inc, streams, os.path.join(tmp_dir, "ckpt"))  # nothing new
    assert inc.applied == n >= 4
    model = Model({**bronze, "order_items": bronze["order_items"].limit(0)}, CFG)
    for t in ("customers", "orders", "payments"):
        assert _rows(inc.silver(t)) == _rows(model.silver(t))
