from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from martlens.operators.joins import EDGES, edge_between, repeated_keys, require_single_match
from martlens.operators.metric_view import Dimension, ManyToOne, Measure, MetricView, distinct_count, total
from martlens.plans.views import order_analytics, shipment_performance


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def small_view(spark) -> MetricView:
    lines = spark.createDataFrame(
        [(1, 1, 10.0), (1, 2, 20.0), (2, 1, 30.0), (3, 9, 40.0), (4, None, 50.0)], "o int, p int, amount double"
    )
    products = spark.createDataFrame([(1, "A"), (2, "B")], "p int, kind string")
    amount = F.col("source.amount")
    return MetricView(
        source=lines,
        joins=[ManyToOne("products", products, "p")],
        dimensions=[Dimension("Kind", F.col("products.kind"), ("products",)), Dimension("Order", F.col("source.o"))],
        measures=[
            Measure("Amount", (total(amount),), lambda x: x),
            Measure("Orders", (distinct_count(F.col("source.o")),), lambda x: x),
        ],
    )


def test_rows_without_partner_stay(spark):
    view = small_view(spark)
    want = {"A": 40.0, "B": 20.0, None: 90.0}
    assert {r[0]: r[1] for r in view.query(["Kind"], ["Amount"]).collect()} == want
    # With a distinct count the totals cannot be taken first; the amounts are the same.
    both = view.query(["Kind"], ["Amount", "Orders"]).collect()
    assert {r[0]: r[1] for r in both} == want
    assert {r[0]: r[2] for r in both} == {"A": 2, "B": 1, None: 2}


def test_no_dimension_gives_one_row(spark):
    (row,) = small_view(spark).query(measures=["Amount", "Orders"]).collect()
    assert tuple(row) == (150.0, 4)


def test_where_order_and_limit(spark):
    got = small_view(spark).query(
        ["Order"],
        ["Amount"],
        where={"Kind": lambda kind: kind.isNotNull()},
        order_by=[F.desc("Amount"), F.col("Order")],
        limit=1,
    )
    assert [tuple(r) for r in got.collect()] == [(1, 30.0)]


def test_unknown_names_raise(gold):
    view = order_analytics(gold)
    with pytest.raises(KeyError, match="Planet"):
        view.query(["Planet"], ["Total Revenue"])
    with pytest.raises(KeyError, match="Profit"):
        view.query(["Region"], ["Profit"])
    with pytest.raises(KeyError, match="Planet"):
        view.query(["Region"], ["Total Revenue"], where={"Planet": lambda c: c == "x"})
    with pytest.raises(ValueError):
        view.query(["Region"])


def test_only_the_needed_tables_are_joined(gold):
    assert "Join" not in plan_of(order_analytics(gold).query(measures=["Total Revenue"]))
    view = order_analytics(replace(gold, order_totals=None, paid_lines=None))
    alone = plan_of(view.query(measures=["Total Revenue"]))
    assert alone.count("Join") == 1 and "product_name" not in alone and "segment" not in alone
    by_product = plan_of(view.query(["Subcategory"], ["Order Count"]))
    assert by_product.count("Join") == 2 and "region_name" not in by_product
    assert "Join" not in plan_of(shipment_performance(gold).query(["Carrier"], ["On Time Rate"]))


def test_totals_are_taken_before_a_dimension_is_joined(gold):
    joined = order_analytics(replace(gold, order_totals=None, paid_lines=None))
    plan = plan_of(joined.query(["Subcategory"], ["Total Revenue", "Gross Margin Pct"]))
    assert plan.count("Aggregate") == 2
    assert "Join Inner" in plan  # payments: the filter drops lines without one


def test_completed_payments_only(gold):
    methods = order_analytics(gold).query(["Payment Method"], ["Total Revenue"]).collect()
    assert {r[0] for r in methods} == {"PM01", "PM02", "PM03", "PM04"}


@pytest.mark.parametrize(
    "dimension",
    ["Order Month", "Order Channel", "Region", "State", "Subcategory", "Product", "Customer Segment", "Currency"],
)
def test_revenue_adds_up_over_every_dimension(gold, dimension):
    view = order_analytics(gold)
    (whole,) = view.query(measures=["Total Revenue", "Units Sold"]).collect()
    split = view.query([dimension], ["Total Revenue", "Units Sold"]).agg(F.sum("Total Revenue"), F.sum("Units Sold"))
    revenue, units = split.first()
    assert revenue == pytest.approx(whole[0]) and units == whole[1]


def test_declared_joins_have_one_match(spark, gold):
    order_analytics(gold).require_single_matches()
    twice = small_view(spark)
    twice.joins["products"] = ManyToOne("products", spark.createDataFrame([(1, "A"), (1, "B")], "p int, kind string"), "p")
    with pytest.raises(ValueError):
        twice.require_single_matches()
    for edge in EDGES:
        require_single_match(gold.table(edge.right), edge.key)
    assert edge_between("fact_orders", "dim_products").key == "product_id"
    with pytest.raises(LookupError):
        edge_between("dim_products", "fact_orders")
    with pytest.raises(ValueError):
        require_single_match(gold.fact_orders, "order_id")
    assert not repeated_keys(gold.fact_orders, "order_id").isEmpty()
