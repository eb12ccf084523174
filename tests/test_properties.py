"""Property-based checks (hypothesis) of the operators whose correctness is
easy to state but easy to get subtly wrong."""

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart.functions import ratios
from lakemart.operators.dedupe import dedupe_latest

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 2),
                             st.one_of(st.none(), st.sampled_from(["x", "y", "z"])), st.integers(-3, 3)),
                   min_size=0, max_size=25)


@SETTINGS
@given(rows=rows_st, parts=st.integers(1, 4))
def test_dedupe_picks_latest(spark, rows, parts):
    df = spark.createDataFrame(rows, "k string, ts int, v string, w int").repartition(parts)
    agg = sorted(map(tuple, dedupe_latest(df, "k", ("ts",)).collect()), key=repr)
    keys = {r[0] for r in rows}
    assert len(agg) == len(keys)
    for k, ts, v, w in agg:
        assert ts == max(r[1] for r in rows if r[0] == k)


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 10**6)), min_size=1, max_size=20))
def test_pct_of_counts_is_exact_half_up(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r.p for r in df.select(ratios.pct_of_counts("a", "b").alias("p")).collect()]
    for (a, b), p in zip(pairs, got):
        if b == 0:
            assert p is None
        else:
            # HALF_UP of the exact rational 100*a/b (Decimal has ample precision here)
            want = (Decimal(100 * a) / Decimal(b)).quantize(Decimal("0.01"), ROUND_HALF_UP)
            assert Fraction(want) == Fraction((20000 * a + b) // (2 * b), 100)
            assert p == float(want)


@SETTINGS
@given(vals=st.lists(st.decimals(min_value=-10**6, max_value=10**6, places=6, allow_nan=False), min_size=1,
                     max_size=30), parts=st.integers(1, 5))
def test_decimal_sums_do_not_depend_on_partitioning(spark, vals, parts):
    df = spark.createDataFrame([(v,) for v in vals], "x decimal(22,6)")
    a = df.repartition(parts).agg(F.sum("x")).first()[0]
    b = df.coalesce(1).agg(F.sum("x")).first()[0]
    assert a == b == sum(vals)
