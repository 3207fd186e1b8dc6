"""Amounts, guarded ratios and the governed revenue measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPLETED = "COMPLETED"
REFUNDED = "REFUNDED"


def as_double(amount: Column) -> Column:
    """Sums are kept as exact decimals, so they do not depend on row order; results are handed out as doubles."""
    return amount.cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Exact sums divided as doubles; NULL when the denominator is zero."""
    return as_double(numerator) / F.nullif(as_double(denominator), F.lit(0.0))


def is_completed(status: str | Column = "status") -> Column:
    return _column(status) == COMPLETED


def is_refunded(status: str | Column = "status") -> Column:
    """Reusable filter: refunded payments only."""
    return _column(status) == REFUNDED


def is_high_value(threshold: float, net_amount: str | Column = "net_amount") -> Column:
    """Reusable filter: a single order line above the threshold."""
    return _column(net_amount) > threshold


def net_of_refunds(amount: str | Column = "amount", status: str | Column = "status") -> Column:
    """Reusable measure: collected money minus refunded money. Failed and pending payments count nothing."""
    value = _column(amount)
    return F.sum(F.when(is_completed(status), value).when(is_refunded(status), -value).otherwise(F.lit(0)))


def distinct_customers(customer_id: str | Column = "customer_id") -> Column:
    """Reusable measure: how many different customers."""
    return F.count_distinct(_column(customer_id))


def flag_count(flag: str | Column) -> Column:
    return F.sum(F.when(_column(flag), 1).otherwise(0))


def flag_rate(flag: str | Column) -> Column:
    """Share of rows whose flag is true; a NULL flag counts as false."""
    return F.avg(F.when(_column(flag), F.lit(1.0)).otherwise(F.lit(0.0)))


def displayed(value: Column, decimals: int) -> Column:
    """A number as people read it: thousands separated, a fixed number of decimals."""
    return F.format_number(value, decimals)


def _column(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name
