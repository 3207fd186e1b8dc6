"""The two governed metric views.

They are kept apart because they count different things: order lines and shipments. A shipment joined to order lines
would be counted once per line.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martlens.functions.amounts import as_double, flag_count, is_completed, ratio
from martlens.functions.calendar import month_of
from martlens.operators.joins import edge_between
from martlens.operators.metric_view import (
    Dimension,
    ManyToOne,
    Measure,
    MetricView,
    Part,
    distinct_count,
    row_count,
    total,
    value_count,
)
from martlens.plans.gold import Gold


def _dimension(name: str, column: str) -> Dimension:
    return Dimension(name, F.col(column), (column.split(".")[0],))


# The names of dimensions and measures below are fixed values: users ask for them by these names.


def _joined(gold: Gold, name: str, left: str, right: str) -> ManyToOne:
    return ManyToOne(name, gold.table(right), edge_between(left, right).key)


def _whole(value: Column) -> Column:
    return value.cast("bigint")


def order_analytics(gold: Gold) -> MetricView:
    """Order lines with completed payments: revenue, margin, order value. Lines stored with their payment join none."""
    stored = gold.paid_lines is not None
    payment = "source" if stored else "transactions"
    net, cogs = F.col("source.net_amount"), F.col("source.cogs_amount")
    revenue, profit, orders = total(net), total(net - cogs), distinct_count(F.col("source.order_id"))
    return MetricView(
        source=gold.paid_lines if stored else gold.fact_orders,
        joins=[
            *([] if stored else [_joined(gold, "transactions", "fact_orders", "fact_transactions")]),
            _joined(gold, "geography", "fact_orders", "dim_geography"),
            _joined(gold, "products", "fact_orders", "dim_products"),
            _joined(gold, "customers", "fact_orders", "dim_customers"),
        ],
        only=is_completed(f"{payment}.status"),
        only_reads=(payment,),
        dimensions=[
            Dimension("Order Month", month_of(F.col("source.order_date"))),
            _dimension("Order Channel", "source.order_channel"),
            _dimension("Region", "geography.region_name"),
            _dimension("State", "geography.state_code"),
            _dimension("Country", "geography.country_name"),
            _dimension("Category", "products.category"),
            _dimension("Subcategory", "products.subcategory"),
            _dimension("Product", "products.product_name"),
            _dimension("Customer Segment", "customers.segment"),
            _dimension("Payment Method", f"{payment}.payment_method"),
            _dimension("Currency", f"{payment}.currency"),
        ],
        rolled_up=None if gold.order_totals is None else _per_order(gold),
        measures=[
            Measure("Total Revenue", (revenue,), as_double),
            Measure("Total COGS", (total(cogs),), as_double),
            Measure("Gross Profit", (profit,), as_double),
            Measure("Gross Margin Pct", (profit, revenue), ratio),
            Measure("Order Count", (orders,), _whole),
            Measure("Units Sold", (total(F.col("source.quantity")),), _whole),
            Measure("Average Order Value", (revenue, orders), ratio),
        ],
    )


def _per_order(gold: Gold) -> MetricView:
    """What of it the order determines, over one row per order: no line is read, and orders are counted as rows."""
    net, cogs = F.col("source.net_amount"), F.col("source.cogs_amount")
    return MetricView(
        source=gold.order_totals,
        joins=[
            _joined(gold, "geography", "fact_orders", "dim_geography"),
            _joined(gold, "customers", "fact_orders", "dim_customers"),
        ],
        only=is_completed("source.status"),
        dimensions=[
            Dimension("Order Month", F.col("source.order_month")),
            _dimension("Order Channel", "source.order_channel"),
            _dimension("Region", "geography.region_name"),
            _dimension("State", "geography.state_code"),
            _dimension("Country", "geography.country_name"),
            _dimension("Customer Segment", "customers.segment"),
            _dimension("Payment Method", "source.payment_method"),
            _dimension("Currency", "source.currency"),
        ],
        measures=[
            Measure("Total Revenue", (total(net),), as_double),
            Measure("Total COGS", (total(cogs),), as_double),
            Measure("Gross Profit", (total(net - cogs),), as_double),
            Measure("Gross Margin Pct", (total(net - cogs), total(net)), ratio),
            Measure("Order Count", (row_count(),), _whole),
            Measure("Units Sold", (total(F.col("source.quantity")),), _whole),
            Measure("Average Order Value", (total(net), row_count()), ratio),
        ],
    )


def shipment_performance(gold: Gold) -> MetricView:
    """Shipments: punctuality, duration, cost."""
    on_time, days = F.col("source.on_time_flag"), F.col("source.delivery_days")
    on_time_total = Part(flag_count(on_time))
    return MetricView(
        source=gold.fact_shipments,
        joins=[_joined(gold, "geography", "fact_shipments", "dim_geography")],
        dimensions=[
            Dimension("Ship Month", month_of(F.col("source.ship_date"))),
            _dimension("Region", "geography.region_name"),
            _dimension("State", "geography.state_code"),
            _dimension("Carrier", "source.carrier"),
        ],
        measures=[
            Measure("Shipment Count", (row_count(),), _whole),
            Measure("On Time Count", (on_time_total,), _whole),
            Measure("On Time Rate", (on_time_total, row_count()), ratio),
            Measure("Average Delivery Days", (total(days), value_count(days)), ratio),
            Measure("Total Shipping Cost", (total(F.col("source.shipping_cost")),), as_double),
        ],
    )
