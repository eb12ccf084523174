"""String standardisation expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def title_trim(col, blank_as_null: bool = False) -> Column:
    """``trim(initcap(col))``: words split on blanks, rest lower-cased."""
    out = F.trim(F.initcap(_c(col)))
    if blank_as_null:
        out = F.when(out == "", F.lit(None)).otherwise(out)
    return out


def title_trim_or(col, default: str = UNKNOWN, blank_as_null: bool = False) -> Column:
    """Standardised text with a default for missing values."""
    return F.coalesce(title_trim(col, blank_as_null), F.lit(default))


def in_domain_or(col, allowed: Iterable[str], default: str = UNKNOWN) -> Column:
    """Keep values of a closed domain; anything else (NULL included) -> default."""
    c = _c(col)
    return F.when(c.isin(list(allowed)), c).otherwise(F.lit(default))


def padded_id(prefix: str, key, width: int) -> Column:
    """Zero-padded business id such as ``CUST0000042`` for a non-negative
    integer key; a key wider than ``width`` is kept whole, never truncated."""
    s = _c(key).cast("string")
    digits = F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))
    return F.concat(F.lit(prefix), digits)
