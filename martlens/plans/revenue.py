"""Building blocks shared by the questions: collected revenue and unshipped orders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.functions.amounts import as_double, is_completed
from martlens.operators.joins import without_partner
from martlens.plans.gold import Gold


def completed_payments(gold: Gold) -> DataFrame:
    return gold.fact_transactions.where(is_completed()).select("order_id")


def collected_lines(gold: Gold) -> DataFrame:
    """Order lines whose payment completed. Where a build has stored them with their payment, nothing is joined."""
    if gold.paid_lines is not None:
        return gold.paid_lines.where(is_completed())
    return gold.fact_orders.join(completed_payments(gold), "order_id")


def collected_orders(gold: Gold) -> DataFrame:
    """Orders whose payment completed, one row each, with the sums of their lines."""
    if gold.order_totals is not None:
        return gold.order_totals.where(is_completed())
    per_order = gold.fact_orders.groupBy("order_id", "customer_id", "geo_id", "order_date", "order_channel")
    sums = [F.sum(name).alias(name) for name in ("quantity", "net_amount", "cogs_amount")]
    return per_order.agg(*sums).join(completed_payments(gold), "order_id")


def collected_per(gold: Gold, *keys: str) -> DataFrame:
    """Collected net amount per key of the order line, added up before any dimension is joined.

    Keys that belong to the order are looked up in the order totals, where a build has left them; then no line is read.
    """
    of_orders = gold.order_totals is not None and set(keys).issubset(gold.order_totals.columns)
    rows = collected_orders(gold) if of_orders else collected_lines(gold)
    return rows.groupBy(*keys).agg(F.sum("net_amount").alias("net_amount"))


def collected_total(gold: Gold, which: Callable[[DataFrame], DataFrame] = lambda orders: orders) -> DataFrame:
    """Collected revenue of some orders as one number; ``which`` chooses them by columns of the order.

    Without order totals, lines are added up per order before they meet the payments: an order with very many lines arrives as
    one row, and the aggregation already leaves the rows where the join needs them.
    """
    if gold.order_totals is not None:
        collected = which(gold.order_totals).where(is_completed())
    else:
        per_order = which(gold.fact_orders).groupBy("order_id").agg(F.sum("net_amount").alias("net_amount"))
        collected = per_order.join(completed_payments(gold), "order_id")
    return collected.agg(as_double(F.sum("net_amount")).alias("revenue"))


def unshipped_orders(gold: Gold, *columns: str) -> DataFrame:
    """Orders without a shipment, with columns of the order; one row for each order and what its lines say."""
    if gold.order_totals is not None:
        return gold.order_totals.where(~F.col("shipped")).select("order_id", *columns)
    orders = gold.fact_orders.select("order_id", *columns).distinct()
    return without_partner(orders, gold.fact_shipments, "order_id")
