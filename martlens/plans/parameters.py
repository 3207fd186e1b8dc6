"""Numbers and days the questions leave to the business."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Parameters:
    """Defaults suit a shop with orders up to mid-2026 and amounts of a few hundred per line."""

    high_value: float = 500
    small_below: float = 50
    medium_below: float = 200
    age_as_of: date = date(2026, 6, 30)
    fiscal_as_of: date = date(2026, 7, 31)
    half_year: tuple[date, date] = (date(2026, 1, 1), date(2026, 6, 30))
    active_days: int = 90


# The provided tables end in August 2001 and hold far larger amounts.
TABLE_PARAMETERS = Parameters(
    high_value=90_000,
    small_below=10_000,
    medium_below=50_000,
    age_as_of=date(2026, 6, 30),
    fiscal_as_of=date(2001, 7, 31),
    half_year=(date(2001, 1, 1), date(2001, 6, 30)),
)
