"""Joins of tables that repeat and so take little room in files, by their number of rows."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from lakemart.operators import joins
from lakemart.operators import validate as V
from lakemart.sources import testdata


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture()
def few(monkeypatch):
    """Bounds that small tables exceed."""
    for f in (joins.packable, joins.maybe_broadcast, joins.bounded, joins.passes):
        monkeypatch.setattr(f, "__defaults__", (20,))


def test_a_large_dimension_is_never_broadcast_whatever_its_files(spark, few):
    dim = spark.range(21).selectExpr("id dk", "concat('n', id) name").localCheckpoint()
    fact = spark.range(100).selectExpr("id % 30 k").localCheckpoint()
    assert "BroadcastHashJoin" in _plan(fact.join(joins.maybe_broadcast(dim, 20), F.col("k") == F.col("dk"), "left"))
    got = fact.join(joins.maybe_broadcast(dim, 21), F.col("k") == F.col("dk"), "left")
    assert "BroadcastHashJoin" not in _plan(got) and got.where("name IS NOT NULL").count() == 73


def test_a_packed_lookup_is_the_join(spark):
    dim = spark.range(500).selectExpr("id * 7 - 900 dk", "if(id % 9 = 0, null, id / 4) v").union(spark.createDataFrame([(None, 1.5)], "dk long, v double"))
    fact = spark.range(3000).selectExpr("if(id % 11 = 0, null, id % 4000 - 1000) k", "id").localCheckpoint()
    got = joins.packed_lookup(fact, dim, F.col("k"), F.col("dk"), "v", 500)
    want = fact.join(dim, F.col("k") == F.col("dk"), "left").select("k", "id", "v", F.col("dk").isNotNull().alias("__found"))
    assert got.columns == want.columns and _rows(got) == _rows(want)
    assert joins.packable(dim, F.col("dk"), 501, 100) and not joins.packable(dim.union(dim), F.col("dk"), 1002, 100)
    assert not joins.packable(dim, F.col("dk"), 501) and not joins.packable(dim, F.col("dk"), joins.MAX_PACKED_ROWS + 1)


def test_keys_that_a_parent_lacks_by_their_hashes(spark, tmp_dir):
    spark.range(4000).selectExpr("if(id % 9 = 0, null, concat('k', id % 900)) k", "id").write.parquet(f"{tmp_dir}/child")
    child = spark.read.parquet(f"{tmp_dir}/child")
    parent = spark.range(300).selectExpr("concat('k', id * 2) k").union(spark.createDataFrame([(None,)], "k string"))
    plain, hashed = V.absent(child, parent, "k"), V.absent(child, parent, "k", few_keys=10)
    assert plain.hashes is None and hashed.hashes is not None and hashed.keys.count() == hashed.n == plain.keys.count()
    assert sum(len(r["__hashes"]) for r in hashed.hashes.collect()) == hashed.n and hashed.hashes.count() < hashed.n / 8
    for check in (V.fk_valid, V.fk_invalid):
        got = check(child, hashed, "k")
        assert got.columns == child.columns and _rows(got) == _rows(check(child, plain, "k")) == _rows(check(child, parent, "k"))
        assert "Exchange hashpartitioning(k" not in _plan(got)


def test_keys_that_a_parent_has_where_it_lacks_many(spark, tmp_dir):
    spark.range(4000).selectExpr("if(id % 9 = 0, null, concat('k', id % 900)) k", "id").write.parquet(f"{tmp_dir}/child")
    child = spark.read.parquet(f"{tmp_dir}/child")
    parent = spark.range(300).selectExpr("concat('k', id * 2) k").union(spark.createDataFrame([(None,), ("k2",)], "k string"))
    got = V.absent(child, parent, "k", max_keys=9, max_present=302)
    assert got.present and V.absent(child, parent, "k", max_keys=9, max_present=301) is parent
    for check in (V.fk_valid, V.fk_invalid):
        assert _rows(check(child, got, "k")) == _rows(check(child, parent, "k"))
    assert "Exchange hashpartitioning(k" not in _plan(V.fk_valid(child, got, "k"))


def test_a_parent_of_many_keys_is_not_broadcast_to_find_them(spark, few, monkeypatch):
    seen = []
    whole = joins.bounded
    monkeypatch.setattr(V, "bounded", lambda df, rows: seen.append(rows) or whole(df, rows))
    child, parent = spark.range(50).selectExpr("concat('k', id) k"), spark.range(30).selectExpr("concat('k', id) k")
    assert V.absent(child, parent, "k").keys.count() == 20 and seen == [30]


def test_items_priced_in_passes_are_those_of_one(spark, tmp_dir, few):
    want = testdata.raw(spark, SF0001).as_dict()
    t = testdata.read_tpch(spark, SF0001)
    assert 1 < joins.passes(t["part"].count()) <= joins.MAX_PASSES
    got = testdata.staged(spark, SF0001, f"{tmp_dir}/base")
    for name in ("orders", "order_items", "payments"):
        assert _rows(got(name)) == _rows(want[name])


def test_lake_of_many_products_is_that_of_few(spark, tmp_dir, monkeypatch):
    from lakemart.plans import pipeline
    from lakemart.plans.model import FIXTURE_CONFIG
    raw = testdata.raw(spark, SF0001).as_dict()
    one = pipeline.run(spark, raw, pipeline.Lake(f"{tmp_dir}/one"), FIXTURE_CONFIG, quality=False)
    rows = one.dim_rows["dim_product"]
    monkeypatch.setattr(joins.packable, "__defaults__", (10,))
    monkeypatch.setattr(joins.passes, "__defaults__", (rows // 3,))
    monkeypatch.setattr(joins.maybe_broadcast, "__defaults__", (10,))
    many = pipeline.run(spark, raw, pipeline.Lake(f"{tmp_dir}/many"), FIXTURE_CONFIG, quality=False)
    assert len({r["pass"] for r in spark.read.parquet(f"{tmp_dir}/many/work/product_items").select("pass").distinct().collect()}) == 4
    assert _rows(one.fact_sales) == _rows(many.fact_sales)
    assert many.dim_product.count() == rows


def test_children_without_parents_yet_are_classified_in_place(spark, tmp_dir):
    """No item moves for a parent that is empty or lacks few keys."""
    from lakemart.plans.model import FIXTURE_CONFIG
    from lakemart.streaming.silver_stream import IncrementalSilver
    raw = {t: df.localCheckpoint() for t, df in testdata.raw(spark, SF0001).as_dict().items()}
    inc = IncrementalSilver(spark, f"{tmp_dir}/inc", FIXTURE_CONFIG, buckets=2)
    early = inc._classify("order_items", raw["order_items"])
    early.collect()
    assert "Exchange hashpartitioning" not in _plan(early)
    assert {r[0] for r in early.select(V.REASON).distinct().collect()} == {"negative_quantity", "invalid_order_fk"}
    inc.apply({t: raw[t] for t in ("customers", "products", "stores", "orders")}, 0)
    late = inc._classify("order_items", raw["order_items"])
    assert "Exchange hashpartitioning" not in _plan(late)
    plain = V.with_parent(raw["order_items"], inc.silver("orders"), "order_id", "there")
    assert late.where(f"{V.REASON} = 'invalid_order_fk'").count() == plain.where("there IS NULL AND quantity > 0").count() > 0
