"""Questions about whole orders are answered from one row per order, with the same results as from the lines."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from martlens.plans import bank, examples, store, truths
from martlens.plans.gold import derive_order_totals
from martlens.plans.parameters import TABLE_PARAMETERS
from martlens.plans.views import order_analytics
from tests.conftest import SMALL
from tests.test_scale import initial_plan

OF_ORDERS = [
    bank.revenue_california,
    bank.order_value_by_segment,
    bank.revenue_by_month,
    bank.margin_by_channel,
    bank.gross_profit,
    bank.completed_orders,
    bank.customers_with_unshipped,
    bank.unshipped_order_count,
    bank.top_customers,
    bank.revenue_by_age_group,
    bank.region_most_unshipped,
    bank.fiscal_quarter_revenue,
    bank.revenue_without_internal,
    bank.active_customers,
    bank.revenue_with_internal,
    bank.latest_month_summary,
    bank.revenue_by_country,
    bank.corporate_share,
    examples.monthly_revenue,
    examples.repeat_customers,
    examples.revenue_by_fiscal_quarter,
    examples.revenue_by_account_kind,
    truths.completed_revenue,
    truths.calendar_quarter_revenue,
]
ORDER_DIMENSIONS = [
    ("Order Month",),
    ("Order Channel",),
    ("Region",),
    ("State",),
    ("Country",),
    ("Customer Segment",),
    ("Payment Method",),
    ("Currency",),
    ("Region", "Customer Segment"),
]


def rows(df) -> list:
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("query", OF_ORDERS, ids=lambda q: q.__name__)
def test_no_line_is_read_and_no_fact_is_shuffled(gold, settings, query):
    settings(autoBroadcastJoinThreshold="-1", maxMetadataStringLength="1000")
    plan = initial_plan(query(gold, TABLE_PARAMETERS))
    assert "/order_totals]" in plan and "/fact_" not in plan
    assert "hashpartitioning(order_id" not in plan
    assert rows(query(gold, TABLE_PARAMETERS)) == rows(query(replace(gold, order_totals=None, paid_lines=None), TABLE_PARAMETERS))


@pytest.mark.parametrize("dims", ORDER_DIMENSIONS, ids="-".join)
def test_views_count_orders_as_rows(gold, settings, dims):
    settings(autoBroadcastJoinThreshold="-1", maxMetadataStringLength="1000")
    view, of_lines = order_analytics(gold), order_analytics(replace(gold, order_totals=None, paid_lines=None))
    query = view.query(dims, list(view.measures))
    plan = initial_plan(query)
    assert "/order_totals]" in plan and "/fact_" not in plan and "distinct" not in plan
    assert rows(query) == rows(of_lines.query(dims, list(of_lines.measures)))


@pytest.mark.parametrize("dims", [["Product"], ["Subcategory"], ["Category", "Region"]], ids="-".join)
def test_products_are_known_to_lines_only(gold, settings, dims):
    settings(maxMetadataStringLength="1000")
    view = order_analytics(gold)
    assert not view.rolled_up.knows(dims, ["Order Count"])
    assert "/fact_orders]" in initial_plan(view.query(dims, ["Order Count"]))
    where = {"Product": lambda name: name.isNotNull()}
    assert "/fact_orders]" in initial_plan(view.query(["Region"], ["Order Count"], where=where))


def test_totals_are_those_of_the_lines(gold):
    totals = gold.order_totals
    assert totals.count() == totals.select("order_id").distinct().count() == gold.fact_transactions.count()
    sums = [F.sum(c) for c in ("quantity", "net_amount", "cogs_amount")]
    assert tuple(totals.agg(F.sum("lines"), *sums).first()) == tuple(gold.fact_orders.agg(F.count("*"), *sums).first())
    assert totals.where("shipped").count() == gold.fact_shipments.count()
    assert totals.where("status IS NULL").count() == 0


def test_orders_that_disagree_with_themselves_leave_no_totals(spark, gold, settings, tmp_path, monkeypatch):
    """An order with lines of two channels is no single row, so the lines themselves are asked."""
    settings(maxMetadataStringLength="1000")
    first = gold.fact_orders.agg(F.min("order_line_id")).first()[0]
    channel = F.when(F.col("order_line_id") == first, "Other").otherwise(F.col("order_channel"))
    split = gold.fact_orders.withColumn("order_channel", channel)
    totals = derive_order_totals(split, gold.fact_transactions, gold.fact_shipments)
    assert totals.count() == gold.fact_transactions.count() + 1
    monkeypatch.setattr(store, "derive_order_totals", lambda *facts: totals)
    built = store.build_store(spark, SMALL, f"{tmp_path}/store")
    assert built.gold.order_totals is None and built.gold.latest_month == gold.latest_month
    query = order_analytics(built.gold).query(["Order Channel"], ["Order Count"])
    assert "/fact_orders]" in initial_plan(query)
