"""Cleaning operators for the silver layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical(value: Column, spellings: dict[str, str]) -> Column:
    """Replace any casing or padding of a known value by its one spelling.

    ``spellings`` maps the trimmed upper-case form to the spelling wanted. Unknown values and NULL come back untouched.
    """
    lookup = F.create_map(*[F.lit(text) for pair in spellings.items() for text in pair])
    return F.coalesce(F.try_element_at(lookup, F.upper(F.trim(value))), value)


def iso_date(value: str | Column) -> Column:
    """Parse an ISO date; text that is no date becomes NULL instead of failing the job."""
    return F.try_to_date(value)


def first_per_key(
    df: DataFrame, key: str, order_by: Sequence[str] = (), colocated_with: str | None = None
) -> DataFrame:
    """Keep one row per key: the first by ``order_by``, or by all other columns when none are given.

    This is an aggregation, so each task reduces its own copies before the shuffle and a key with very many copies
    never gathers in one task. ``colocated_with`` names a column the key determines; rows already partitioned on that
    column are then not shuffled again.
    """
    keys = [colocated_with, key] if colocated_with else [key]
    rest = [name for name in df.columns if name not in keys]
    rank = [F.col(name).alias(f"rank_{position}") for position, name in enumerate(order_by)]
    first = F.min(F.struct(*rank, *[name for name in rest if name not in order_by]))
    picked = {name: f"rank_{position}" for position, name in enumerate(order_by)}
    return (
        df.groupBy(*keys)
        .agg(first.alias("first_row"))
        .select(
            *[F.col(name) if name in keys else F.col("first_row")[picked.get(name, name)].alias(name) for name in df.columns]
        )
    )
