"""Lines are stored with what their payment says, so questions by product meet no payments and move no line by its order."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from martlens.plans import bank, examples, queries, store
from martlens.plans.gold import COLUMN_COMMENTS, MONTHS, PAYMENT_COLUMNS, derive_paid_lines
from martlens.plans.parameters import TABLE_PARAMETERS
from martlens.plans.views import order_analytics
from martlens.sources import files
from tests.conftest import SMALL
from tests.test_order_totals import rows
from tests.test_scale import initial_plan

BY_PRODUCT = {
    "margin_by_subcategory": lambda gold: bank.margin_by_subcategory(gold, TABLE_PARAMETERS),
    "top_products": lambda gold: examples.top_products(gold, TABLE_PARAMETERS),
    "best_subcategories": queries.best_subcategories,
    "web_revenue_by_country": queries.web_revenue_by_country,
}
VIEW_DIMENSIONS = [("Category",), ("Subcategory",), ("Product",), ("Product", "Payment Method"), ("Subcategory", "Currency")]


def plain(gold):
    return replace(gold, order_totals=None, paid_lines=None)


def reads_lines_alone(plan: str) -> bool:
    return "/fact_orders]" in plan and "/fact_transactions]" not in plan and "hashpartitioning(order_id" not in plan


@pytest.mark.parametrize("name", BY_PRODUCT)
def test_no_payments_are_read_and_no_line_moves_by_its_order(gold, settings, name):
    settings(autoBroadcastJoinThreshold="-1", maxMetadataStringLength="1000")
    assert reads_lines_alone(initial_plan(BY_PRODUCT[name](gold)))
    assert "/fact_transactions]" in initial_plan(BY_PRODUCT[name](plain(gold)))
    assert rows(BY_PRODUCT[name](gold)) == rows(BY_PRODUCT[name](plain(gold)))


@pytest.mark.parametrize("dims", VIEW_DIMENSIONS, ids="-".join)
def test_views_by_product(gold, settings, dims):
    settings(autoBroadcastJoinThreshold="-1", maxMetadataStringLength="1000")
    view, joined = order_analytics(gold), order_analytics(plain(gold))
    assert reads_lines_alone(initial_plan(view.query(dims, list(view.measures))))
    assert rows(view.query(dims, list(view.measures))) == rows(joined.query(dims, list(joined.measures)))


def test_months_stay_unread(gold, settings):
    """A bound on the order date reaches the folders of the stored lines, whether their payment is asked for or not."""
    settings(maxMetadataStringLength="1000")
    month = gold.latest_month
    bounded = gold.ordered(F.col("order_month") == F.lit(month))
    for lines in (bounded.paid_lines, bounded.fact_orders):
        assert "PartitionFilters: [isnotnull(order_month" in initial_plan(lines)
        assert len(lines.inputFiles()) > 0
    assert bounded.paid_lines.where(F.col("order_month") != F.lit(month)).isEmpty()
    assert plain(bounded).ordered(F.lit(True)).paid_lines is None


def test_the_stored_lines_are_the_lines(gold):
    assert gold.fact_orders.columns == list(COLUMN_COMMENTS["fact_orders"])
    assert set(gold.paid_lines.columns) == {*COLUMN_COMMENTS["fact_orders"], *PAYMENT_COLUMNS}
    payments = gold.fact_transactions.select("order_id", *PAYMENT_COLUMNS)
    met = gold.fact_orders.join(payments, "order_id", "left").select(*gold.paid_lines.columns)
    assert rows(met.select(*sorted(met.columns))) == rows(gold.paid_lines.select(*sorted(met.columns)))


def test_a_line_without_payment_stays_and_counts_for_nothing(gold):
    first = gold.fact_transactions.agg(F.min("order_id")).first()[0]
    fewer = gold.fact_transactions.where(F.col("order_id") != first)
    paid = derive_paid_lines(gold.fact_orders, fewer)
    assert paid.count() == gold.fact_orders.count() and paid.columns[-1] == MONTHS["fact_orders"]
    unpaid = paid.where("status IS NULL")
    assert unpaid.count() == gold.fact_orders.where(F.col("order_id") == first).count() > 0
    known = replace(gold, order_totals=None, paid_lines=paid, fact_transactions=fewer)
    assert rows(BY_PRODUCT["top_products"](known)) == rows(BY_PRODUCT["top_products"](plain(known)))


def test_two_payments_of_an_order_are_refused(spark, gold, tmp_path, monkeypatch):
    twice = gold.fact_transactions.unionByName(gold.fact_transactions.limit(1))
    monkeypatch.setattr(store, "derive_paid_lines", lambda lines, payments: derive_paid_lines(lines, twice))
    with pytest.raises(ValueError, match="more than one payment"):
        store.build_store(spark, SMALL, f"{tmp_path}/store")
    with pytest.raises(store.StaleStore):
        store.open_store(spark, SMALL, f"{tmp_path}/store")


def test_lines_on_their_way_are_removed(spark, tmp_path):
    store.build_store(spark, SMALL, f"{tmp_path}/store")
    (source,) = files.names_in(spark, f"{tmp_path}/store")
    (version,) = files.names_in(spark, f"{tmp_path}/store/{source}")
    found = files.names_in(spark, f"{tmp_path}/store/{source}/{version}")
    assert "fact_orders" in found and store.UNPAID not in found
