"""Data-quality checks producing a result relation
``(layer, table_name, check_name, total_records, failed_records, status)``.

Scalar checks on one table share a single aggregate (``count_if`` per check),
duplicate checks are one grouped aggregate, FK checks one left join against
the distinct parent keys.  Results stay a DataFrame; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.operators.validate import parent_keys

RESULT_COLUMNS = ["layer", "table_name", "check_name", "total_records", "failed_records", "status"]


def status(failed: Column) -> Column:
    return F.when(failed == 0, "PASS").otherwise("FAIL")


# ----- check conditions (TRUE = failed row) ---------------------------------

def is_null(col: str) -> Column:
    return F.col(col).isNull()


def is_negative(col: str) -> Column:
    return F.col(col) < 0


def not_positive(col: str) -> Column:
    return F.col(col) <= 0


def invalid_date(col: str, as_of: Column | None = None) -> Column:
    ref = as_of if as_of is not None else F.current_date()
    return F.col(col).isNull() | (F.col(col) > ref)


def not_in(col: str, allowed: Sequence[str], nulls_fail: bool = False) -> Column:
    """``NOT IN``: a NULL value is not counted (three-valued logic) unless
    ``nulls_fail``."""
    cond = ~F.col(col).isin(list(allowed))
    return (cond | F.col(col).isNull()) if nulls_fail else cond


@dataclass(frozen=True)
class ScalarCheck:
    name: str
    fails: Column


def _rows(layer: str, table: str, agg: DataFrame, names: Sequence[str]) -> DataFrame:
    structs = [F.struct(F.lit(n).alias("check_name"), F.col(f"_f{i}").cast("long").alias("failed_records"))
               for i, n in enumerate(names)]
    out = agg.select(F.col("_total").cast("long").alias("total_records"), F.inline(F.array(*structs)))
    return out.select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "check_name",
                      "total_records", "failed_records", status(F.col("failed_records")).alias("status"))


@dataclass(frozen=True)
class FkCheck:
    name: str
    key: str
    parent: DataFrame
    parent_key: str | None = None


def fk_rows(layer: str, table: str, df: DataFrame, fk: FkCheck) -> DataFrame:
    """One FK check.  Rows are counted per key before the join (partial
    aggregate), so a hot key costs one row per map task, and the parent is
    reduced to its distinct keys, so repeated ones count nothing twice."""
    per_key = df.groupBy(F.col(fk.key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    # both sides are grouped by the key, so that a merge moves neither again; the parent is never broadcast
    hits = per_key.join(parent_keys(fk.parent, fk.key, "_hit", fk.parent_key).hint("merge"), F.col("_key") == F.col("__pk"), "left")
    agg = hits.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"),
                   F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("_n"))), F.lit(0)).alias("_f0"))
    return _rows(layer, table, agg, [fk.name])


def table_checks(layer: str, table: str, df: DataFrame, key: str | None = None,
                 scalars: Sequence[ScalarCheck] = (), fks: Sequence[FkCheck] = (),
                 dup_name: str | None = None) -> DataFrame:
    """Every check of one table: the row conditions and the duplicate excess in
    one plan, and one narrow plan (one column of the table) per foreign key.

    With a duplicate check, rows are reduced per key by a partial (map-side)
    aggregate -- a key holding a third of the table costs one row per map task
    in the shuffle -- and a final global aggregate yields total, duplicate
    excess and all failure counts at once.
    """
    own = [_own_checks(layer, table, df, key, scalars, dup_name)] if scalars or key is not None else []
    return union_all(own + [fk_rows(layer, table, df, fk) for fk in fks])


def _own_checks(layer: str, table: str, d: DataFrame, key: str | None, scalars: Sequence[ScalarCheck],
                dup_name: str | None) -> DataFrame:
    conds = [c.fails for c in scalars]
    names = [c.name for c in scalars]
    if key is None:
        agg = d.agg(F.count(F.lit(1)).alias("_total"), *[F.count_if(c).alias(f"_f{i}") for i, c in enumerate(conds)])
        return _rows(layer, table, agg, names)
    per_key = d.groupBy(key).agg(F.count(F.lit(1)).alias("_n"),
                                 *[F.count_if(c).alias(f"_k{i}") for i, c in enumerate(conds)])
    agg = per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"),
                      F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias(f"_f{len(conds)}"),
                      *[F.coalesce(F.sum(f"_k{i}"), F.lit(0)).alias(f"_f{i}") for i in range(len(conds))])
    return _rows(layer, table, agg, names + [dup_name or f"Duplicate {key}"])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
