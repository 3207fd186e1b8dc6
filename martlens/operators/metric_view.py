"""Metric views: joins, filter, dimensions and measures defined once, queried at any grouping.

A measure is an aggregate expression, never a stored number, so ratios and distinct counts are right at whatever
grouping is asked for. A query joins only the tables its dimensions, measures and conditions touch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.operators.joins import require_single_match

SOURCE = "source"


@dataclass(frozen=True)
class ManyToOne:
    """A table met on an equally named key, at most one row per source row; unmatched source rows stay."""

    name: str
    table: DataFrame
    key: str


@dataclass(frozen=True)
class Dimension:
    """An expression to group by, and the tables it reads (``source`` or names of joins)."""

    name: str
    expr: Column
    reads: tuple[str, ...] = (SOURCE,)


@dataclass(frozen=True)
class Part:
    """One plain aggregate of a measure. Sums and counts of subgroups add up; distinct counts need the values kept apart."""

    aggregate: Column
    distinct: Column | None = None


def total(value: Column) -> Part:
    return Part(F.sum(value))


def row_count() -> Part:
    return Part(F.count(F.lit(1)))


def value_count(value: Column) -> Part:
    return Part(F.count(value))


def distinct_count(value: Column) -> Part:
    return Part(F.count_distinct(value), value)


@dataclass(frozen=True)
class Measure:
    """A number made of aggregates over the joined rows."""

    name: str
    parts: tuple[Part, ...]
    finish: Callable[..., Column]
    reads: tuple[str, ...] = (SOURCE,)

    def over_rows(self) -> Column:
        return self.finish(*[part.aggregate for part in self.parts]).alias(self.name)


class MetricView:
    def __init__(
        self,
        source: DataFrame,
        joins: Sequence[ManyToOne],
        dimensions: Sequence[Dimension],
        measures: Sequence[Measure],
        only: Column | None = None,
        only_reads: tuple[str, ...] = (),
        rolled_up: MetricView | None = None,
    ) -> None:
        """``rolled_up`` is the same view over fewer rows. It has those dimensions and measures that its rows determine, under the
        same names, and is asked instead wherever these suffice."""
        self.source = source
        self.joins = {join.name: join for join in joins}
        self.dimensions = {dimension.name: dimension for dimension in dimensions}
        self.measures = {measure.name: measure for measure in measures}
        self.only = only
        self.only_reads = only_reads
        self.rolled_up = rolled_up

    def query(
        self,
        dims: Sequence[str] = (),
        measures: Sequence[str] = (),
        where: Mapping[str, Callable[[Column], Column]] | None = None,
        order_by: Sequence[Column] = (),
        limit: int | None = None,
    ) -> DataFrame:
        """Measures grouped by dimensions; no dimensions give one row over everything.

        ``where`` maps a dimension to a predicate on it. ``order_by`` refers to the columns of the result.
        """
        keys = [_named(self.dimensions, name, "dimension") for name in dims]
        wanted = [_named(self.measures, name, "measure") for name in measures]
        tests = [(_named(self.dimensions, name, "dimension"), test) for name, test in (where or {}).items()]
        if not wanted:
            raise ValueError("a metric view query needs at least one measure")
        if self.rolled_up is not None and self.rolled_up.knows([*dims, *(where or {})], measures):
            return self.rolled_up.query(dims, measures, where, order_by, limit)

        needed = set(self.only_reads).union(*[m.reads for m in wanted], *[d.reads for d, _ in tests]) - {SOURCE}
        for_keys = set().union(*[d.reads for d in keys]) - {SOURCE} - needed
        if not all(for_keys.isdisjoint(d.reads) or for_keys.issuperset(d.reads) for d in keys):
            needed, for_keys = needed | for_keys, set()
        rows = self._joined(needed)
        if self.only is not None:
            rows = rows.where(self.only)
        for dimension, test in tests:
            rows = rows.where(test(dimension.expr))

        if for_keys:
            result = self._totals_then_join(rows, [j for j in self.joins.values() if j.name in for_keys], keys, wanted)
        else:
            grouped = rows.groupBy(*[d.expr.alias(d.name) for d in keys])
            result = grouped.agg(*[m.over_rows() for m in wanted])
        if order_by:
            result = result.orderBy(*order_by)
        return result if limit is None else result.limit(limit)

    def knows(self, dims: Sequence[str], measures: Sequence[str]) -> bool:
        return set(dims) <= self.dimensions.keys() and set(measures) <= self.measures.keys()

    def require_single_matches(self) -> None:
        """Fail when a joined table repeats its key, which would multiply source rows."""
        for join in self.joins.values():
            require_single_match(join.table, join.key)

    def _joined(self, names: set[str]) -> DataFrame:
        rows = self.source.alias(SOURCE)
        for name, join in self.joins.items():
            if name in names:
                on = F.col(f"{SOURCE}.{join.key}") == F.col(f"{name}.{join.key}")
                rows = rows.join(join.table.alias(name), on, "left")
        return rows

    def _totals_then_join(
        self, rows: DataFrame, joins: list[ManyToOne], keys: list[Dimension], wanted: list[Measure]
    ) -> DataFrame:
        """Add up before the tables are joined that are needed for nothing but the grouping.

        The rows are added up per join key, per dimension that needs none of these tables, and per value that is counted
        distinct; what is left of them meets the tables. Sums and counts are added up again, distinct values counted then. A
        part that several measures share is kept once: each further column of distinct values would repeat all rows.
        """
        apart = {join.name for join in joins}
        own = {d.name: f"key_{i}" for i, d in enumerate(keys) if apart.isdisjoint(d.reads)}
        parts = list({id(part): part for m in wanted for part in m.parts}.values())
        columns = [f"part_{i}" for i in range(len(parts))]
        joined_on = {join.key: join.key for join in joins}
        first = rows.groupBy(
            *[F.col(f"{SOURCE}.{key}").alias(key) for key in joined_on],
            *[d.expr.alias(own[d.name]) for d in keys if d.name in own],
            *[p.distinct.alias(c) for p, c in zip(parts, columns) if p.distinct is not None],
        )
        added = [p.aggregate.alias(c) for p, c in zip(parts, columns) if p.distinct is None]
        met = (first.agg(*added) if added else first.agg(F.lit(1).alias("one"))).alias(SOURCE)
        for join in joins:
            on = F.col(f"{SOURCE}.{join.key}") == F.col(f"{join.name}.{join.key}")
            met = met.join(join.table.alias(join.name), on, "left")
        again = {
            id(p): F.sum(f"{SOURCE}.{c}") if p.distinct is None else F.count_distinct(f"{SOURCE}.{c}")
            for p, c in zip(parts, columns)
        }
        finished = [m.finish(*[again[id(part)] for part in m.parts]).alias(m.name) for m in wanted]
        grouped = met.groupBy(
            *[F.col(f"{SOURCE}.{own[d.name]}").alias(d.name) if d.name in own else d.expr.alias(d.name) for d in keys]
        )
        return grouped.agg(*finished)


def _named(known: Mapping[str, object], name: str, kind: str):
    if name not in known:
        raise KeyError(f"unknown {kind} {name!r}; known: {', '.join(known)}")
    return known[name]
