"""Unit tests of the operators on hand-written rows (NULLs, ties, empty input)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import Row
from pyspark.sql import functions as F

from lakemart.functions import dates, money, ratios, text
from lakemart.operators import keys, quality, validate as V
from lakemart.operators.dedupe import dedupe_latest, duplicate_excess
from lakemart.operators.layout import z_value


def test_dedupe_ties_are_deterministic(spark):
    rows = [("C1", 1, "delhi"), ("C1", 1, "Agra"), ("C2", 0, "x"), (None, 0, "a"), (None, 0, "b")]
    df = spark.createDataFrame(rows, "id string, ts int, city string")
    out = {(r.id, r.city) for r in dedupe_latest(df, "id", ("ts",)).collect()}
    # same timestamp: the larger remaining value wins; NULL keys form one group
    assert out == {("C1", "delhi"), ("C2", "x"), (None, "b")}


def test_dedupe_latest_wins_and_null_is_smallest(spark):
    rows = [("K", 2, None), ("K", 2, "v"), ("K", 1, "z")]
    df = spark.createDataFrame(rows, "id string, ts int, v string")
    out = dedupe_latest(df, "id", ("ts",)).collect()
    assert [(r.ts, r.v) for r in out] == [(2, "v")]
    assert dedupe_latest(df.limit(0), "id", ("ts",)).count() == 0


def test_positive_split_both_null_policies(spark):
    df = spark.createDataFrame([(1, 5), (2, 0), (3, -1), (4, None)], "id int, price int")
    valid, rej = V.split(df, V.positive("price", "invalid_price"))
    assert {r.id for r in valid.collect()} == {1}
    assert {(r.id, r.rejected_reason) for r in rej.collect()} == {
        (2, "invalid_price"), (3, "invalid_price"), (4, "null_price")}
    valid, rej = V.split(df, V.positive("price", "invalid_price", "drop"), ("price",))
    assert {r.id for r in valid.collect()} == {1}
    assert {r.id for r in rej.collect()} == {2, 3}  # the NULL row falls out of both


def test_first_failing_rule_wins(spark):
    items = spark.createDataFrame([("i1", "o1", "p9", -2), ("i2", "o9", "p1", 1), ("i3", "o1", "p9", 3),
                                   ("i4", "o1", "p1", 1), ("i5", None, "p1", 1)],
                                  "item string, order_id string, product_id string, qty int")
    orders = spark.createDataFrame([("o1",)], "order_id string")
    products = spark.createDataFrame([("p1",)], "product_id string")
    d = V.with_parent(items, orders, "order_id", "_o")
    d = V.with_parent(d, products, "product_id", "_p")
    rules = V.positive("qty", "negative_quantity") + [V.Rule("invalid_order_fk", V.missing("_o")),
                                                      V.Rule("invalid_product_fk", V.missing("_p"))]
    got = {r.item: r.rejected_reason for r in V.classify(d, rules).collect()}
    assert got == {"i1": "negative_quantity", "i2": "invalid_order_fk", "i3": "invalid_product_fk",
                   "i4": None, "i5": "invalid_order_fk"}


def test_fk_semi_anti_null_key(spark):
    child = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",)], "k string")
    assert [r.k for r in V.fk_valid(child, parent, "k").collect()] == ["a"]
    assert sorted(V.fk_invalid(child, parent, "k").collect(), key=str) == sorted([Row(k="b"), Row(k=None)], key=str)


def test_domain_default_and_text(spark):
    df = spark.createDataFrame([("Active",), ("weird",), (None,)], "s string")
    got = [r.x for r in df.select(text.in_domain_or("s", ["Active", "Inactive"]).alias("x")).collect()]
    assert got == ["Active", "Unknown", "Unknown"]
    df = spark.createDataFrame([(" new  DELHI ",), ("o'neil",), ("mc-donald",), ("",), (None,)], "c string")
    got = [r.x for r in df.select(text.title_trim_or("c").alias("x")).collect()]
    assert got == ["New  Delhi", "O'neil", "Mc-donald", "", "Unknown"]
    got = [r.x for r in df.select(text.title_trim_or("c", blank_as_null=True).alias("x")).collect()]
    assert got[3] == "Unknown"


def test_padded_id_never_truncates(spark):
    df = spark.createDataFrame([(42,), (123456789,)], "k long")
    assert [r.x for r in df.select(text.padded_id("CUST", "k", 7).alias("x")).collect()] == [
        "CUST0000042", "CUST123456789"]


def test_invalid_dates_and_not_in(spark):
    as_of = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(None, "A"), (as_of, None), (as_of + dt.timedelta(days=1), "Z")],
                               "d date, s string")
    r = df.agg(F.count_if(quality.invalid_date("d", F.lit(as_of))).alias("bad_d"),
               F.count_if(quality.not_in("s", ["A"])).alias("bad_s"),
               F.count_if(quality.not_in("s", ["A"], nulls_fail=True)).alias("bad_s2")).first()
    assert (r.bad_d, r.bad_s, r.bad_s2) == (2, 1, 2)


def test_duplicate_excess(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "k string")
    assert duplicate_excess(df, "k").first().failed_records == 2
    assert duplicate_excess(df.filter("k = 'b'"), "k").first().failed_records == 0
    assert duplicate_excess(df.limit(0), "k").first().failed_records == 0


def test_table_checks_single_plan(spark):
    orders = spark.createDataFrame([("o1", "c1", "Pending"), ("o1", "c1", "Pending"), ("o2", "cX", None),
                                    ("o3", None, "Bad")], "order_id string, customer_id string, s string")
    cust = spark.createDataFrame([("c1",), ("c1",)], "customer_id string")
    out = quality.table_checks("bronze", "orders", orders, "order_id",
                               [quality.ScalarCheck("Invalid s", quality.not_in("s", ["Pending"]))],
                               [quality.FkCheck("Invalid customer_id FK", "customer_id", cust)])
    got = {r.check_name: (r.total_records, r.failed_records, r.status) for r in out.collect()}
    assert got == {"Invalid s": (4, 1, "FAIL"), "Invalid customer_id FK": (4, 2, "FAIL"),
                   "Duplicate order_id": (4, 1, "FAIL")}


def test_ratios_never_raise(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 8), (1, 32), (2, 3)], "a long, b long")
    got = [tuple(r) for r in df.select(ratios.safe_div("a", "b"), ratios.pct_of_counts("a", "b")).collect()]
    assert got[0] == (None, None) and got[1] == (None, None)
    assert got[2] == (0.125, 12.5)
    assert got[3][1] == 3.13  # 3.125 rounds half up, exactly
    assert got[4][1] == 66.67
    empty = df.limit(0).agg(ratios.pct_of_counts(F.count_if(F.col("a") > 0), F.count(F.lit(1))).alias("p"))
    assert empty.first().p is None


def test_money_formulae_exact(spark):
    df = spark.createDataFrame([(3, Decimal("10.10"), Decimal("5.00"), Decimal("12.00"), Decimal("21.2100")),
                                (1, Decimal("0.00"), Decimal("0.00"), Decimal("5.00"), Decimal("0.0000"))],
                               "q long, p decimal(12,2), d decimal(5,2), t decimal(5,2), c decimal(18,4)")
    g = money.gross_sales("q", "p")
    dsc = money.discount_amount(g, "d")
    net = money.net_sales(g, dsc)
    out = df.select(g.alias("g"), dsc.alias("d"), net.alias("n"), money.tax_amount(net, "t").alias("t"),
                    money.profit(net, "c").alias("pr"),
                    money.profit_margin(money.profit(net, "c"), net).alias("m"),
                    money.line_amount("q", "p", "d", "t").alias("line")).collect()
    r = out[0]
    assert (r.g, r.d, r.n) == (Decimal("30.30"), Decimal("1.515000"), Decimal("28.785000"))
    assert r.t == Decimal("3.4542000000") and r.pr == Decimal("7.575000")
    assert r.line == Decimal("32.24")
    assert out[1].m == 0.0  # net sales 0 -> margin 0


def test_calendar(spark):
    from lakemart.plans.gold import dim_date
    one = spark.createDataFrame([(dt.date(2024, 2, 29),)], "order_date date")
    d = dim_date(one).collect()
    assert len(d) == 1 and d[0].date_key == 20240229 and d[0].month_name == "February"
    assert d[0].day_of_week == "Thursday" and d[0].is_weekend is False
    span = spark.createDataFrame([(dt.date(2024, 2, 27),), (dt.date(2024, 3, 2),)], "order_date date")
    assert [r.day for r in dim_date(span).orderBy("full_date").collect()] == [27, 28, 29, 1, 2]
    assert dim_date(one.limit(0)).count() == 0
    r = spark.createDataFrame([(20240229,)], "k int").select(dates.key_year("k"), dates.key_month("k")).first()
    assert tuple(r) == (2024, 2)


def test_dense_key_matches_row_number(spark):
    ids = [f"ID{(i * 7919) % 1000:04d}" for i in range(1000)]
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(7)
    got = {r.id: r.k for r in keys.with_dense_key(df, "id", "k", partitions=5).collect()}
    want = {r.id: r.k for r in keys.with_row_number_key(df, "id", "k").collect()}
    assert got == want and sorted(got.values()) == list(range(1, 1001))


def test_z_value_fast_path_equals_bit_loop(spark):
    df = spark.range(0, 3000).select((F.col("id") * 7 % 1000).alias("a"), (F.col("id") * 13 % 977).alias("b"))
    fast = z_value(["a", "b"], bits=16)
    loop = F.lit(0).cast("long")
    for i in range(16):
        for j, c in enumerate(["a", "b"]):
            loop = loop + F.shiftleft(F.shiftright(F.col(c), i).bitwiseAND(1), 2 * i + j)
    assert df.filter(fast != loop).count() == 0
    assert df.select(z_value(["a", "b", "a"], bits=10).alias("z")).filter("z < 0").count() == 0


def test_growth_plain_vs_gap_aware(spark):
    from lakemart.plans import timeintel
    from lakemart.plans.metrics import monthly_growth
    fact = spark.createDataFrame([(2024, 1, Decimal("100")), (2024, 3, Decimal("50")), (2024, 4, Decimal("0")),
                                  (2024, 5, Decimal("10"))], "year int, month int, net_sales decimal(22,6)")

    class M:
        fact_sales = fact
    plain = {(r.month): r.mom_growth_pct for r in monthly_growth(M).collect()}
    gap = {(r.month): (r.prev_month_sales, r.mom_growth_pct) for r in timeintel.mom_growth(fact).collect()}
    assert plain[3] == -50.0          # compares with January (LAG over existing months)
    assert gap[3] == (None, None)     # calendar previous month (February) is missing
    assert gap[5] == (0.0, None)      # zero previous month -> NULL, no error
    assert plain[1] is None


def test_existence_flag_with_same_key_name(spark):
    child = spark.createDataFrame([("a",), ("b",), (None,)], "customer_id string")
    parent = spark.createDataFrame([("a",), ("a",)], "customer_id string")
    d = V.with_parent(child, parent, "customer_id", "f")
    got = {r.customer_id: r.miss for r in d.select("customer_id", V.missing("f").alias("miss")).collect()}
    assert got == {"a": False, "b": True, None: True} and d.count() == 3


def test_silver_dates_from_dirty_text(spark):
    from lakemart.plans import silver
    from lakemart.plans.silver import SilverConfig
    rows = [("C1", "A", "B", "M", "1990-05-01", "delhi", "x", "India", "xx", "S", "e", "Active", 0)]
    cols = ("customer_id string, first_name string, last_name string, gender string, date_of_birth string, "
            "city string, state string, country string, signup_date string, customer_segment string, "
            "email string, customer_status string, seq int")
    c = silver.customers(spark.createDataFrame(rows, cols), SilverConfig(order_cols=("seq",)))
    r = silver.silver_view(c, "customers").first()
    assert r.date_of_birth == dt.date(1990, 5, 1) and r.signup_date is None and r.city == "Delhi"


def test_round_ratio_exact_ties(spark):
    df = spark.createDataFrame([(Decimal("38819.497"), Decimal("39044.000")), (Decimal("1.125"), Decimal("1")),
                                (Decimal("5"), Decimal("0")), (Decimal("-1.005"), Decimal("1"))],
                               "cur decimal(22,6), prev decimal(22,6)")
    got = [r.g for r in df.select(ratios.growth_pct("cur", "prev").alias("g")).collect()]
    assert got == [-0.58, 12.5, None, -200.5]
    got = [r.v for r in df.select(ratios.money_per(F.col("prev") * 0 + Decimal("1.005"), F.lit(1)).alias("v")).collect()]
    assert got[0] == 1.01  # a float 1.005 would round to 1.0
