"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as registered
from martlens.plans.queries import all_queries
from oracle.statements import statements
from tests.compare import differences, oracle_connection
from tests.conftest import SMALL

QUERIES = all_queries()
STATEMENTS = statements()


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SMALL)


def test_every_query_has_a_statement():
    assert sorted(QUERIES) == sorted(STATEMENTS)
    assert set(QUERIES) <= set(registered.queries())
    assert set(STATEMENTS) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SMALL), connection, STATEMENTS[name]) == []


# Queries whose rows come in an order, with what they are ordered by: column and whether it descends.
ORDERED = {
    "b19_revenue_by_month": [("Order Month", False)],
    "b28_high_value_lines": [("net_amount", True)],
    "x3_top_products": [("revenue", True), ("product_name", False)],
    "x4_monthly_revenue": [("month", False)],
    "x5_monthly_net_revenue": [("month", False)],
    "x6_margin_without_internal": [("margin_pct", True), ("subcategory", False)],
    "x7_punctuality_by_carrier": [("on_time_pct", True), ("carrier", False)],
    "x8_repeat_customers": [("spend", True), ("customer_id", False)],
    "mvq1_best_subcategories": [("Total Revenue", True), ("Subcategory", False)],
    "mvq2_punctual_regions": [("On Time Rate", True), ("Region", False)],
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_rows_come_in_their_order(spark, name):
    rows = QUERIES[name](spark, SMALL).collect()
    wanted = list(rows)
    for column, descending in reversed(ORDERED[name]):
        wanted.sort(key=lambda row: row[column], reverse=descending)
    assert len(rows) > 1 and [[r[c] for c, _ in ORDERED[name]] for r in rows] == [
        [r[c] for c, _ in ORDERED[name]] for r in wanted
    ]


def test_entry_runs(spark):
    result = registered.entry(spark)
    assert result.columns == ["Subcategory", "Gross Margin Pct", "Total Revenue"]
    assert result.count() == 6
