"""Fault injection: exact counts, partition independence, detection by DQ."""

from pyspark.sql import functions as F

from lakemart.operators import faults, quality as Q

from conftest import SF0001


def _customers(spark, n=2000, parts=3):
    return (spark.range(n).select(F.format_string("C%05d", "id").alias("customer_id"),
                                  F.lit("Delhi").alias("city"), (F.col("id") % 7).alias("score"))
            .repartition(parts))


def test_exact_counts_and_report(spark):
    df = _customers(spark)
    plan = faults.ISSUE_PLANS["customers"]
    out = faults.apply_issues(df, "customer_id", plan)
    rep = {r.issue: r.rows_affected for r in faults.issue_report(out, "customers", plan).collect()}
    assert rep == {"Customers landed twice": 20, "Customers without city": 40,
                   "City spelled in mixed case": 60}
    clean = faults.strip_flags(out)
    assert clean.count() == 2020 and clean.filter(F.col("city").isNull()).count() == 40
    dup = Q.table_checks("raw", "customers", clean, "customer_id", [Q.ScalarCheck("Null city", Q.is_null("city"))])
    got = {r.check_name: r.failed_records for r in dup.collect()}
    assert got == {"Null city": 40, "Duplicate customer_id": 20}


def test_picks_do_not_depend_on_partitioning(spark):
    a = faults.inject_nulls(_customers(spark, parts=2), "city", 0.05, "customer_id")
    b = faults.inject_nulls(_customers(spark, parts=9), "city", 0.05, "customer_id")
    ids = lambda d: sorted(r.customer_id for r in d.filter(F.col("city").isNull()).collect())
    assert ids(a) == ids(b) and len(ids(a)) == 100


def test_numeric_and_fk_injectors(spark):
    df = _customers(spark, 1000)
    neg = faults.inject_invalid_numeric(df, "score", 0.01, "customer_id", negative=False)
    assert neg.filter("_picked_invalid_score").filter("score = 0").count() == 10
    fk = faults.inject_invalid_fk(df, "customer_id", 0.02, "customer_id", "CUST")
    assert fk.filter(F.col("customer_id").startswith("NOCUST-")).count() == 20


def test_copies_are_hit_on_their_own(spark):
    d = faults.inject_duplicates(_customers(spark), 0.1, "customer_id")
    d = faults.strip_flags(faults.inject_nulls(d, "city", 0.2, "customer_id", seed=7))
    assert not [c for c in d.columns if c.startswith("_")]
    pairs = d.groupBy("customer_id").agg(F.count("*").alias("n"), F.count_if(F.col("city").isNull()).alias("nulls"))
    got = {r.nulls: r["count"] for r in pairs.filter("n = 2").groupBy("nulls").count().collect()}
    assert sum(got.values()) == 200 and got.get(1, 0) > 20


def test_picks_are_the_smallest_digests_without_sort_or_checkpoint(spark):
    from hashlib import md5
    df = _customers(spark, 3000).cache()
    for pct, n in ((0.0, 0), (0.0001, 0), (0.001, 3), (0.37, 1110), (1.0, 3000)):
        out = faults.inject_nulls(df, "city", pct, "customer_id", seed=5)
        got = {r.customer_id for r in out.filter("city IS NULL").select("customer_id").collect()}
        ids = [r.customer_id for r in df.select("customer_id").collect()]
        assert got == set(sorted(ids, key=lambda c: md5(f"5|{c}|0".encode()).hexdigest())[:n])
    main = out._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in main and "Join" not in main and "Exchange hash" not in main and "Exchange range" not in main
    assert faults.inject_nulls(df.limit(0), "city", 0.5, "customer_id").count() == 0


def test_every_check_finds_what_was_injected(spark):
    from lakemart.plans import queries
    from lakemart.plans.pipeline import fixture_lake

    got = {(r.table_name, r.check_name): r for r in queries.run("dq_injected", spark, SF0001).collect()}
    assert len(got) == 14 and all(r.failed_records > 0 and r.status == "FAIL" for r in got.values())
    orders = fixture_lake(spark, SF0001).silver_orders.count()
    landed = orders + orders * 5 // 1000
    failed = {c: got["orders", c] for c in ("Duplicate order_id", "Invalid order_date", "Invalid order_status")}
    assert all(r.total_records == landed for r in failed.values())
    assert failed["Duplicate order_id"].failed_records == orders * 5 // 1000
    # a null date and a date to come may hit one row; a restyled status can stay as it was
    nulls, late = landed // 100, landed * 5 // 1000
    assert max(nulls, late) <= failed["Invalid order_date"].failed_records <= nulls + late
    assert failed["Invalid order_status"].failed_records <= landed * 2 // 100


def test_far_dates_hit_exactly_their_share(spark):
    rows = spark.range(1000).select("id", F.lit("2001-02-03").cast("date").alias("day"))
    got = faults.strip_flags(faults.inject_far_date(rows, "day", 0.013, "id"))
    assert got.where(F.col("day") == faults.FAR_DATE).count() == 13 and got.count() == 1000
    assert faults.inject_far_date(rows.limit(0), "day", 0.5, "id").count() == 0


def test_histogram_of_digests_is_short(spark):
    """A task shuffles one row for each bin that it met, not for each of its rows."""
    from lakemart.operators import faults
    n = 300_000
    df = spark.range(0, n, 1, 1).selectExpr("cast(id as string) k")
    out = faults.inject_nulls(df.withColumn("v", df["k"]), "v", 0.01, "k", label="v")
    assert out.filter("_picked_v").count() == n // 100 == out.filter("v is null").count()
    assert 16 ** faults.BIN_DIGITS < n / 4
