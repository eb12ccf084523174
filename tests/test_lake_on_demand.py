"""A question writes the tables that its own are made from, and no others."""

import glob
import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from lakemart.plans import catalog, dq, metrics, pipeline, queries, star
from lakemart.sources import schemas as S

from conftest import SF0001


@pytest.fixture()
def fresh(spark):
    """A lake of which nothing is written yet; the application's own comes back afterwards."""
    saved = dict(pipeline._LAKES)
    yield pipeline.lake_on_demand(spark, SF0001, reuse=False)
    pipeline._LAKES.clear()
    pipeline._LAKES.update(saved)


def written(lake) -> set[str]:
    return {done.split(os.sep)[-3] + "/" + done.split(os.sep)[-2] for done in glob.glob(f"{lake.lake.root}/*/*/_SUCCESS")}


def test_silver_products_needs_products_alone(spark, fresh):
    got = queries.run("silver_products", spark, SF0001)
    assert written(fresh) == {"bronze/products", "silver/products", "quarantine/products"}
    assert got.count() + fresh.rejected("products").count() == 200
    assert written(fresh) == {"bronze/products", "silver/products", "quarantine/products"}


def test_checks_read_the_tables_that_they_name(spark, fresh):
    assert dq.duplicate_customer_ids(dq.bronze_tables(fresh)).count() == 2
    assert [r.check_name for r in dq.dq_summary(fresh, only={"Null category"}).collect()] == ["Null category"] * 2
    assert written(fresh) == {"bronze/customers", "bronze/products", "silver/products", "quarantine/products"}


def test_revenue_of_the_fact_alone_equals_that_of_the_whole_lake(spark, fresh):
    alone = metrics.total_revenue(fresh).first().total_revenue
    monthly = sorted(map(tuple, catalog.run_sql_on(spark, "monthly_net_sales", fresh).collect()))
    assert not {"bronze/payments", "silver/payments", "quality/data_quality_results"} & written(fresh)
    assert {"gold/fact_sales", "stats/fact_sales", "silver/orders", "quarantine/order_items"} <= written(fresh)
    whole = pipeline.fixture_lake(spark, SF0001, reuse=False)
    assert alone == metrics.total_revenue(whole).first().total_revenue
    assert monthly == sorted(map(tuple, catalog.run_sql_on(spark, "monthly_net_sales", whole).collect()))
    assert dict(fresh.dim_rows) == dict(whole.dim_rows)


def test_a_whole_lake_has_every_table_and_is_finished_from_parts(spark, fresh):
    fresh.silver("stores").count()
    whole = pipeline.fixture_lake(spark, SF0001)
    assert whole is fresh
    want = {f"{layer}/{t}" for layer in ("bronze", "silver") for t in S.SOURCES} | {f"quarantine/{t}" for t in pipeline.REJECTING}
    want |= {f"gold/{n}" for n in (*pipeline.DIMENSIONS, "fact_sales")} | {"stats/fact_sales", "quality/data_quality_results"}
    assert want <= written(whole)
    assert os.path.exists(f"{whole.lake.root}/{pipeline._DONE}")


def test_threads_share_one_run_of_a_step_and_a_failed_one_runs_again(spark, fresh, monkeypatch):
    wrote, plain = [], pipeline._write

    def noted(df, path, *args, **kwargs):
        wrote.append(path)
        if len(wrote) == 1:
            raise OSError("lost")
        return plain(df, path, *args, **kwargs)

    monkeypatch.setattr(pipeline, "_write", noted)
    with pytest.raises(OSError):
        fresh.build.need("bronze/stores")
    with ThreadPoolExecutor(4) as pool:
        counts = list(pool.map(lambda _: fresh.silver("stores").count(), range(4)))
    assert len(set(counts)) == 1
    assert [p.rsplit("/", 2)[1:] for p in wrote] == [["bronze", "stores"]] * 2 + [["silver", "stores"]]


def test_a_star_on_demand_knows_the_size_of_its_dimensions(fresh):
    plan = star.star(fresh)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 4
