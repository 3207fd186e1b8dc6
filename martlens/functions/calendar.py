"""Calendar months and the fiscal calendar."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the fiscal year starts on February 1, one month after the calendar year.
FISCAL_SHIFT_MONTHS = 1


def month_of(day: str | Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(day, "month")


def fiscal_quarter_start(day: str | Column) -> Column:
    """First day of the fiscal quarter: quarters begin in February, May, August and November."""
    return F.add_months(F.trunc(F.add_months(day, -FISCAL_SHIFT_MONTHS), "quarter"), FISCAL_SHIFT_MONTHS)


def fiscal_quarter(day: str | Column) -> Column:
    return F.quarter(F.add_months(day, -FISCAL_SHIFT_MONTHS))


def fiscal_year(day: str | Column) -> Column:
    """Calendar year in which the fiscal year starts."""
    return F.year(F.add_months(day, -FISCAL_SHIFT_MONTHS))


def _quarter_days(first_month: int) -> tuple[date, date]:
    """First and last day of the three months from a month, which is counted from year 0."""
    after = first_month + 3
    start, end = (date(month // 12, month % 12 + 1, 1) for month in (first_month, after))
    return start, end - timedelta(days=1)


def fiscal_quarter_days(as_of: date) -> tuple[date, date]:
    """First and last day of the fiscal quarter that contains ``as_of``."""
    month = as_of.year * 12 + as_of.month - 1
    return _quarter_days(month - (month - FISCAL_SHIFT_MONTHS) % 3)


def last_calendar_quarter_days(as_of: date) -> tuple[date, date]:
    """First and last day of the last calendar quarter that is over by ``as_of``."""
    next_day = as_of + timedelta(days=1)
    month = next_day.year * 12 + next_day.month - 1
    return _quarter_days(month - month % 3 - 3)


def ordered_since(first: date | Column) -> Column:
    """Order lines from a day on. The bound on the month leaves the folders of earlier months unread."""
    day = F.lit(first)
    return (F.col("order_month") >= month_of(day)) & (F.col("order_date") >= day)


def ordered_between(first: date, last: date) -> Column:
    """Order lines of some days; folders of other months are not read."""
    month = F.col("order_month").between(F.lit(first.replace(day=1)), F.lit(last.replace(day=1)))
    return month & F.col("order_date").between(F.lit(first), F.lit(last))
