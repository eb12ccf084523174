"""Exact money arithmetic in DECIMAL.

Row-level sales formulae of the fact table:
gross = quantity * unit_price; discount = gross * discount_pct / 100;
net = gross - discount (tax excluded); tax = net * tax_pct / 100;
profit = net - cost; margin = profit / net (0 when net is 0).

Percentages are multiplied by 0.01 rather than divided by 100 so the decimal
scale stays exact, and every step is cast to a fixed type so sums are
order-independent and identical in any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QTY = "decimal(10,0)"
PRICE = "decimal(12,2)"
PCT = "decimal(5,2)"
GROSS = "decimal(18,2)"
NET = "decimal(22,6)"
TAX = "decimal(26,10)"
COST = "decimal(18,4)"
LINE = "decimal(18,2)"


def _hundredth() -> Column:
    return F.lit("0.01").cast("decimal(2,2)")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def gross_sales(qty="quantity", price="unit_price") -> Column:
    return (_c(qty).cast(QTY) * _c(price)).cast(GROSS)


def discount_amount(gross, disc_pct="discount_percentage") -> Column:
    return (_c(gross) * _c(disc_pct) * _hundredth()).cast(NET)


def net_sales(gross, discount) -> Column:
    return (_c(gross) - _c(discount)).cast(NET)


def tax_amount(net, tax_pct="tax_percentage") -> Column:
    return (_c(net) * _c(tax_pct) * _hundredth()).cast(TAX)


def profit(net, cost="cost_amount") -> Column:
    return (_c(net) - _c(cost)).cast(NET)


def profit_margin(profit_col, net) -> Column:
    """profit / net as DOUBLE, 0.0 when net is 0 (NULL stays NULL)."""
    p, n = _c(profit_col), _c(net)
    return F.when(n != 0, p.cast("double") / n.cast("double")).when(n == 0, F.lit(0.0))


def line_amount(qty, price, disc_pct, tax_pct) -> Column:
    """round(qty * price * (1 - disc/100) * (1 + tax/100), 2)."""
    after_disc = (_c(qty).cast(QTY) * _c(price) * (F.lit(1) - _c(disc_pct) * _hundredth())).cast("decimal(24,6)")
    return F.round(after_disc * (F.lit(1) + _c(tax_pct) * _hundredth()), 2).cast(LINE)

