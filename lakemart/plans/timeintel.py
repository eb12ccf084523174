"""Calendar-aware month-over-month and year-over-year comparisons.

The monthly totals are keyed by ``year*12 + month``; a RANGE frame of exactly
one (twelve) months back finds the calendar previous month (same month last
year), so a missing month gives NULL instead of comparing with an older month.
The window runs over one row per month: bounded, whatever the fact size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions.dates import month_index
from lakemart.functions.ratios import growth_pct


def monthly_totals(fact: DataFrame, measure: str = "net_sales") -> DataFrame:
    return (fact.groupBy("year", "month").agg(F.sum(measure).alias("_v"))
            .withColumn("_mi", month_index("year", "month")))


def _offset(monthly: DataFrame, months: int):
    w = Window.orderBy("_mi").rangeBetween(-months, -months)
    return F.sum("_v").over(w)


def _growth(cur, prev):
    return growth_pct(cur, prev)


def mom_growth(fact: DataFrame) -> DataFrame:
    m = monthly_totals(fact)
    prev = _offset(m, 1)
    return m.select("year", "month", F.col("_v").cast("double").alias("total_sales"),
                    prev.cast("double").alias("prev_month_sales"),
                    _growth(F.col("_v"), prev).alias("mom_growth_pct"))


def yoy_sales(fact: DataFrame) -> DataFrame:
    m = monthly_totals(fact)
    ly = _offset(m, 12)
    return m.select("year", "month", F.col("_v").cast("double").alias("total_sales"),
                    ly.cast("double").alias("sales_last_year"),
                    _growth(F.col("_v"), ly).alias("yoy_growth_pct"))
