"""Reusable fields: age bracket of a customer, size bracket of an order line."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def age_group(birth_date: str | Column, as_of: date | Column) -> Column:
    """Age bracket on ``as_of``, a year counted as 365 days. An unknown birth date falls in the oldest bracket."""
    day = F.lit(as_of) if isinstance(as_of, date) else as_of
    years = F.datediff(day, birth_date) / 365
    return F.when(years < 25, "Under 25").when(years < 40, "25-39").when(years < 60, "40-59").otherwise("60+")


def order_size(net_amount: str | Column, small_below: float = 50, medium_below: float = 200) -> Column:
    """Size bracket of a line amount. An unknown amount falls in the largest bracket."""
    amount = F.col(net_amount) if isinstance(net_amount, str) else net_amount
    return F.when(amount < small_below, "Small").when(amount < medium_below, "Medium").otherwise("Large")
