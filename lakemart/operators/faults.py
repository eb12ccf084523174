"""Fault injection for tests: exactly ``int(n * pct)`` rows get a defect.

Rows are picked by the smallest MD5 of (seed, key, copy number) -- independent
of partitioning, repeatable, and the same in any engine.  The digest up to which
rows are picked comes from a histogram (see ``_rank_flag``), so the rows
themselves are neither sorted nor moved.  Every injector returns the frame plus a boolean
column ``_picked_<label>`` consumed by ``issue_report``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Number of a row's copy, present once duplicates were injected; dropped with the flags.
COPY = "_picked__copy"


def _copy_no(df: DataFrame) -> Column:
    return F.col(COPY) if COPY in df.columns else F.lit(0)


def _digest(df: DataFrame, seed: int, key: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"), _copy_no(df).cast("string")))


#: Hexadecimal digits of a digest that make a histogram's bins (16**4 rows of each task
#: at most; the digests of one bin, n / 16**4 of them, are then read).
BIN_DIGITS = 4


def _rank_flag(df: DataFrame, key: str, pct: float, seed: int, flag: str) -> DataFrame:
    """Flag the ``int(n * pct)`` rows of the smallest digests.

    The row that stands at that place is found by two small queries, run here: a
    histogram of digest beginnings gives its bin and its place in the bin, and the
    digests of that one bin give its digest; one value of each comes to the driver.  Every row is then compared with it where it is:
    rows are neither sorted nor shuffled.  A key with its copy number tells rows
    apart; rows that agree in both are flagged together."""
    digest = _digest(df, seed, key)
    bins = df.groupBy(F.substring(digest, 1, BIN_DIGITS).alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.orderBy("_bin"))  # at most 16**BIN_DIGITS rows
    n = F.sum("_n").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    k = F.floor(n.cast("decimal(20,0)") * F.lit(Decimal(str(pct))))  # exact: int(n * pct)
    place = bins.select("_bin", (k - upto + F.col("_n")).cast("long").alias("_rank"), "_n").filter("_rank > 0 AND _rank <= _n").first()
    if place is None:
        return df.withColumn(flag, F.lit(False))
    inside = df.select(digest.alias("_h")).filter(F.substring("_h", 1, BIN_DIGITS) == place["_bin"])
    last = inside.agg(F.sort_array(F.collect_list("_h"))[place["_rank"] - 1]).first()[0]
    return df.withColumn(flag, F.coalesce(digest <= F.lit(last), F.lit(False)))


def inject_nulls(df: DataFrame, col: str, pct: float, key: str, seed: int = 42, label: str | None = None) -> DataFrame:
    flag = f"_picked_{label or 'null_' + col}"
    d = _rank_flag(df, key, pct, seed, flag)
    return d.withColumn(col, F.when(F.col(flag), F.lit(None)).otherwise(F.col(col)))


def inject_duplicates(df: DataFrame, pct: float, key: str, seed: int = 42, label: str = "duplicates") -> DataFrame:
    """Picked rows appear twice; one pass via explode.  The copies are equal, but
    numbered, so that a later injector picks each on its own."""
    flag = f"_picked_{label}"
    d = _rank_flag(df, key, pct, seed, flag)
    copies = F.when(F.col(flag), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    d = d.withColumn("_copy", F.explode(copies))
    # only the first copy carries the flag, so the report counts injected rows once
    d = d.withColumn(flag, F.col(flag) & (F.col("_copy") == 0))
    number = _copy_no(df) * 2 + F.col("_copy")
    return d.withColumn(COPY, number).drop("_copy")


def inject_inconsistent_case(df: DataFrame, col: str, pct: float, key: str, seed: int = 42,
                             label: str | None = None) -> DataFrame:
    flag = f"_picked_{label or 'case_' + col}"
    d = _rank_flag(df, key, pct, seed, flag)
    style = F.pmod(F.ascii(_digest(df, seed + 1, key)), F.lit(3))
    restyled = F.when(style == 0, F.upper(col)).when(style == 1, F.lower(col)).otherwise(F.initcap(col))
    return d.withColumn(col, F.when(F.col(flag), restyled).otherwise(F.col(col)))


def inject_invalid_numeric(df: DataFrame, col: str, pct: float, key: str, negative: bool = True, seed: int = 42,
                           label: str | None = None) -> DataFrame:
    flag = f"_picked_{label or 'invalid_' + col}"
    d = _rank_flag(df, key, pct, seed, flag)
    bad = -F.abs(F.col(col)) if negative else F.lit(0).cast(d.schema[col].dataType)
    return d.withColumn(col, F.when(F.col(flag), bad).otherwise(F.col(col)))


#: A date that no order can have had.
FAR_DATE = "2999-12-31"


def inject_far_date(df: DataFrame, col: str, pct: float, key: str, seed: int = 42, label: str | None = None) -> DataFrame:
    flag = f"_picked_{label or 'date_' + col}"
    d = _rank_flag(df, key, pct, seed, flag)
    far = F.lit(FAR_DATE).cast(d.schema[col].dataType)
    return d.withColumn(col, F.when(F.col(flag), far).otherwise(F.col(col)))


def inject_invalid_fk(df: DataFrame, col: str, pct: float, key: str, prefix: str, seed: int = 42,
                      label: str | None = None) -> DataFrame:
    """Replace the FK with ``NO<prefix>-<hash>``, a form that no parent id has
    however many parents there are."""
    flag = f"_picked_{label or 'fk_' + col}"
    d = _rank_flag(df, key, pct, seed, flag)
    fake = F.concat(F.lit(f"NO{prefix}-"), F.upper(F.substring(_digest(df, seed + 2, key), 1, 16)))
    return d.withColumn(col, F.when(F.col(flag), fake).otherwise(F.col(col)))


@dataclass(frozen=True)
class Issue:
    kind: str          # nulls | duplicates | case | negative | zero | fk | date
    pct: float
    col: str | None = None
    prefix: str | None = None
    label: str | None = None


# Per-table defect plans (rates as fractions; order matters --
# duplicates are injected first, so later defects can hit only one copy).
ISSUE_PLANS: dict[str, list[Issue]] = {
    "customers": [Issue("duplicates", 0.01, label="Customers landed twice"),
                  Issue("nulls", 0.02, "city", label="Customers without city"),
                  Issue("case", 0.03, "city", label="City spelled in mixed case")],
    "products": [Issue("nulls", 0.02, "category", label="Products without category"),
                 Issue("negative", 0.01, "selling_price", label="Products priced below zero")],
    "orders": [Issue("duplicates", 0.005, label="Orders landed twice"),
               Issue("fk", 0.01, "customer_id", "CUST", label="Orders of an unknown customer")],
    "order_items": [Issue("negative", 0.005, "quantity", label="Items of negative quantity"),
                    Issue("fk", 0.01, "product_id", "PROD", label="Items of an unknown product")],
    "payments": [Issue("duplicates", 0.01, label="Payments landed twice"),
                 Issue("negative", 0.01, "payment_amount", label="Payments below zero"),
                 Issue("nulls", 0.02, "transaction_reference", label="Payments without reference")],
}

#: The issue plans and the defects that the other checks look for: dates, statuses, unknown orders.
CHECK_PLANS: dict[str, list[Issue]] = ISSUE_PLANS | {
    "orders": [*ISSUE_PLANS["orders"], Issue("nulls", 0.01, "order_date"), Issue("date", 0.005, "order_date"),
               Issue("case", 0.02, "order_status")],
    "payments": [*ISSUE_PLANS["payments"], Issue("case", 0.02, "payment_status"), Issue("fk", 0.01, "order_id", "ORD")],
}


def _slug(label: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in label.lower()).strip("_")


def apply_issues(df: DataFrame, key: str, issues: Sequence[Issue], seed: int = 42) -> DataFrame:
    """Fold the injectors over a table; one ``_picked_<slug>`` flag per issue."""
    for i, iss in enumerate(issues):
        lab, s = _slug(iss.label or f"{iss.kind}_{i}"), seed + 101 * i
        if iss.kind == "nulls":
            df = inject_nulls(df, iss.col, iss.pct, key, s, lab)
        elif iss.kind == "duplicates":
            df = inject_duplicates(df, iss.pct, key, s, lab)
        elif iss.kind == "case":
            df = inject_inconsistent_case(df, iss.col, iss.pct, key, s, lab)
        elif iss.kind in ("negative", "zero"):
            df = inject_invalid_numeric(df, iss.col, iss.pct, key, iss.kind == "negative", s, lab)
        elif iss.kind == "date":
            df = inject_far_date(df, iss.col, iss.pct, key, s, lab)
        elif iss.kind == "fk":
            df = inject_invalid_fk(df, iss.col, iss.pct, key, iss.prefix, s, lab)
        else:
            raise ValueError(iss.kind)
    return df


def issue_report(df: DataFrame, table: str, issues: Sequence[Issue]) -> DataFrame:
    """(table_name, issue, target_pct, rows_affected) from the pick flags, one pass."""
    labs = [(iss.label or f"{iss.kind}_{i}", iss.pct) for i, iss in enumerate(issues)]
    agg = df.agg(*[F.count_if(F.col(f"_picked_{_slug(lab)}")).alias(f"_c{i}") for i, (lab, _) in enumerate(labs)])
    rows = [F.struct(F.lit(lab).alias("issue"), F.lit(round(pct * 100, 6)).alias("target_pct"),
                     F.col(f"_c{i}").alias("rows_affected")) for i, (lab, pct) in enumerate(labs)]
    return agg.select(F.lit(table).alias("table_name"), F.inline(F.array(*rows)))


def strip_flags(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_picked_")])
