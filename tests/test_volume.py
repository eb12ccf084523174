"""What is shuffled and stored: whole rows only where they are needed."""

import random
from pathlib import Path

from lakemart.operators import skipping
from lakemart.operators import validate as V
from lakemart.operators.dedupe import dedupe_latest, dedupe_stored

from conftest import SF0001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_dedupe_of_a_stored_table_gives_the_rows_of_dedupe_latest(spark):
    rng = random.Random(3)
    rows = [(None if rng.random() < 0.05 else f"k{rng.randrange(400)}", rng.choice([None, 1, 2]), f"v{i % 7}") for i in range(500)]
    df = spark.createDataFrame(rows, "k string, ts int, v string").repartition(5)
    want = _rows(dedupe_latest(df, "k", ("ts",)))
    assert _rows(dedupe_stored(df, "k", ("ts",))) == want
    assert _rows(dedupe_stored(df, "k", ("ts",), max_repeated=1)) == want  # too many repeat: the whole table
    assert dedupe_stored(df, "k", ("ts",)).columns == df.columns
    assert dedupe_stored(df.limit(0), "k", ("ts",)).count() == 0


def test_rows_of_keys_that_occur_once_are_not_shuffled(spark, tmp_dir):
    spark.range(1000).selectExpr("cast(id as string) k", "1 ts", "'x' v").write.parquet(f"{tmp_dir}/once")
    once = dedupe_stored(spark.read.parquet(f"{tmp_dir}/once"), "k", ("ts",))
    assert once.count() == 1000 and "Exchange" not in _plan(once)


def test_range_layout_shuffles_no_z_value(spark):
    df = spark.range(100).selectExpr("id sale", "cast(id % 7 as int) a", "cast(id % 5 as int) b", "cast(id % 2 as int) year")
    out = skipping.ranged(df, {"a": 7, "b": 5}, ("year",), 100, "sale")
    assert out.columns == df.columns and _rows(out) == _rows(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RepartitionByExpression", 1)
    assert "AS _z#" in above and "AS _z#" not in below


def _stored(spark, path: str, rows: str):
    spark.sql(rows).write.parquet(path)
    return spark.read.parquet(path)


def test_keys_that_a_parent_lacks_check_a_child_without_moving_it(spark, tmp_dir):
    child = _stored(spark, f"{tmp_dir}/child", "select if(id % 9 = 0, null, concat('k', id % 40)) k, id from range(300)")
    parent = _stored(spark, f"{tmp_dir}/parent", "select concat('k', id) k from range(30)").union(spark.createDataFrame([(None,)], "k string"))
    gone = V.absent(child, parent, "k")
    assert isinstance(gone, V.Absent) and gone.keys.count() == 10
    for check in (V.fk_valid, V.fk_invalid):
        got = check(child, gone, "k")
        assert got.columns == child.columns and _rows(got) == _rows(check(child, parent, "k"))
        assert "Exchange hashpartitioning" not in _plan(got)
    known = V.with_parent(child, gone, "k", "there")
    assert known.filter(V.missing("there")).count() == V.fk_invalid(child, parent, "k").count()
    assert V.absent(child, parent, "k", max_keys=9) is parent
    assert V.absent(child.limit(0), parent, "k").keys.count() == 0


def test_lake_is_the_same_by_lacked_keys_and_by_parents(spark, tmp_dir, monkeypatch):
    """Classified twice from bronze, or staged where too many keys are lacked."""
    from lakemart.plans import pipeline
    from lakemart.plans.model import FIXTURE_CONFIG, Model
    from lakemart.sources import testdata
    raw = testdata.raw(spark, SF0001).as_dict()
    lazy = Model(raw, FIXTURE_CONFIG)
    few = pipeline.run(spark, raw, pipeline.Lake(f"{tmp_dir}/few"), FIXTURE_CONFIG, quality=False)
    assert not (Path(tmp_dir) / "few" / "work").exists()
    whole = V.absent
    monkeypatch.setattr(V, "absent", lambda *a, **k: whole(*a, **k, max_keys=0))
    many = pipeline.run(spark, raw, pipeline.Lake(f"{tmp_dir}/many"), FIXTURE_CONFIG, quality=False)
    assert (Path(tmp_dir) / "many" / "work" / "order_items").exists()
    for t in raw:
        assert _rows(few.silver(t)) == _rows(many.silver(t)) == _rows(lazy.silver(t))
    for t in pipeline.REJECTING:
        assert few.rejected(t).count() and _rows(few.rejected(t)) == _rows(many.rejected(t)) == _rows(lazy.rejected(t))
    assert _rows(few.fact_sales) == _rows(many.fact_sales) == _rows(lazy.fact_sales)


def test_months_of_the_fact_are_not_shuffled(spark):
    from pyspark.sql import functions as F
    df = spark.range(100).selectExpr("id sale", "cast(id % 7 as int) a", "cast(id % 5 as int) b")
    out = skipping.ranged(df, {"a": 7, "b": 5}, {"year": (F.col("sale") % 2).cast("int")}, 100, "sale")
    assert _rows(out.select("sale", "a", "b", "year")) == _rows(df.withColumn("year", (F.col("sale") % 2).cast("int")))
    above, below = out._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression", 1)
    assert "AS year#" in above and "AS year#" not in below
