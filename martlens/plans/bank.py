"""The bank of forty reference questions, each with its category, its level and its query."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.functions.amounts import (
    as_double,
    is_completed,
    is_high_value,
    is_refunded,
    net_of_refunds,
    ratio,
)
from martlens.functions.calendar import fiscal_quarter_days, month_of, ordered_between, ordered_since
from martlens.functions.fields import age_group
from martlens.functions.vocabulary import means
from martlens.operators.joins import with_partner
from martlens.plans.gold import Gold
from martlens.plans.parameters import Parameters
from martlens.plans.revenue import (
    collected_lines,
    collected_per,
    collected_total,
    unshipped_orders,
)
from martlens.plans.views import order_analytics, shipment_performance

Query = Callable[[Gold, Parameters], DataFrame]


@dataclass(frozen=True)
class BankItem:
    id: str
    question: str
    category: str
    level: str
    query: Query


BANK: list[BankItem] = []


def _asks(id: str, question: str, category: str, level: str) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        BANK.append(BankItem(id, question, category, level, query))
        return query

    return register


# ---- plain aggregates --------------------------------------------------------------------------------------------


@_asks("b01_net_amount_total", "Net amount over all order lines, paid or not", "aggregation", "basic")
def net_amount_total(gold: Gold, p: Parameters) -> DataFrame:
    return gold.fact_orders.agg(as_double(F.sum("net_amount")).alias("total_net_amount"))


@_asks("b02_orders_per_channel", "Orders per sales channel", "aggregation", "basic")
def orders_per_channel(gold: Gold, p: Parameters) -> DataFrame:
    return gold.fact_orders.groupBy("order_channel").agg(F.count_distinct("order_id").alias("orders"))


@_asks("b03_customers_per_segment", "Customers per segment", "aggregation", "basic")
def customers_per_segment(gold: Gold, p: Parameters) -> DataFrame:
    return gold.dim_customers.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))


@_asks("b04_average_delivery_days", "Average days from dispatch to delivery", "aggregation", "basic")
def average_delivery_days(gold: Gold, p: Parameters) -> DataFrame:
    return gold.fact_shipments.agg(F.avg("delivery_days").alias("average_days"))


@_asks("b05_products_per_subcategory", "Products per subcategory", "aggregation", "basic")
def products_per_subcategory(gold: Gold, p: Parameters) -> DataFrame:
    return gold.dim_products.groupBy("subcategory").agg(F.count(F.lit(1)).alias("products"))


@_asks("b06_units_total", "Units ordered in all", "aggregation", "basic")
def units_total(gold: Gold, p: Parameters) -> DataFrame:
    return gold.fact_orders.agg(F.sum("quantity").alias("units"))


@_asks("b07_dearest_product", "Product with the highest list price", "aggregation", "basic")
def dearest_product(gold: Gold, p: Parameters) -> DataFrame:
    ranked = gold.dim_products.orderBy(F.desc("list_price"), "product_id").limit(1)
    return ranked.select("product_name", as_double(F.col("list_price")).alias("list_price"))


@_asks("b08_shipments_per_carrier", "Shipments per carrier", "aggregation", "basic")
def shipments_per_carrier(gold: Gold, p: Parameters) -> DataFrame:
    return gold.fact_shipments.groupBy("carrier").agg(F.count(F.lit(1)).alias("shipments"))


# ---- words for codes ---------------------------------------------------------------------------------------------


def _completed_amount(gold: Gold, method: str) -> DataFrame:
    paid = gold.fact_transactions.where(means("payment_method", method) & is_completed())
    return paid.agg(as_double(F.sum("amount")).alias("revenue"))


@_asks("b09_paypal_revenue", "Completed revenue paid with PayPal", "value-matching", "intermediate")
def paypal_revenue(gold: Gold, p: Parameters) -> DataFrame:
    return _completed_amount(gold, "PayPal")


@_asks("b10_credit_card_orders", "Orders paid by credit card", "value-matching", "intermediate")
def credit_card_orders(gold: Gold, p: Parameters) -> DataFrame:
    paid = gold.fact_transactions.where(means("payment_method", "credit card") & is_completed())
    return paid.agg(F.count_distinct("order_id").alias("orders"))


@_asks("b11_gift_card_amount", "Completed amount paid with gift cards", "value-matching", "intermediate")
def gift_card_amount(gold: Gold, p: Parameters) -> DataFrame:
    return _completed_amount(gold, "gift card")


@_asks("b12_revenue_california", "Completed revenue in California", "value-matching", "intermediate")
def revenue_california(gold: Gold, p: Parameters) -> DataFrame:
    there = gold.dim_geography.where(means("state_code", "California"))
    return collected_total(gold, lambda orders: with_partner(orders, there, "geo_id"))


@_asks("b13_orders_to_ontario", "Orders shipped to Ontario", "value-matching", "intermediate")
def orders_to_ontario(gold: Gold, p: Parameters) -> DataFrame:
    there = gold.dim_geography.where(means("state_code", "Ontario"))
    return with_partner(gold.fact_shipments, there, "geo_id").agg(F.count_distinct("order_id").alias("orders"))


@_asks("b14_cad_transactions", "Transactions in Canadian dollars", "value-matching", "intermediate")
def cad_transactions(gold: Gold, p: Parameters) -> DataFrame:
    paid = gold.fact_transactions.where(means("currency", "Canadian dollars"))
    return paid.agg(F.count(F.lit(1)).alias("transactions"))


@_asks("b15_refunded_transactions", "Refunded transactions", "value-matching", "intermediate")
def refunded_transactions(gold: Gold, p: Parameters) -> DataFrame:
    return gold.fact_transactions.where(is_refunded()).agg(F.count(F.lit(1)).alias("transactions"))


# ---- governed measures -------------------------------------------------------------------------------------------


@_asks("b16_on_time_rate_by_region", "On-time rate by region", "measure", "intermediate")
def on_time_rate_by_region(gold: Gold, p: Parameters) -> DataFrame:
    return shipment_performance(gold).query(["Region"], ["On Time Rate"])


@_asks("b17_margin_by_subcategory", "Gross margin by subcategory", "measure", "intermediate")
def margin_by_subcategory(gold: Gold, p: Parameters) -> DataFrame:
    return order_analytics(gold).query(["Subcategory"], ["Gross Margin Pct"])


@_asks("b18_order_value_by_segment", "Average order value by customer segment", "measure", "intermediate")
def order_value_by_segment(gold: Gold, p: Parameters) -> DataFrame:
    return order_analytics(gold).query(["Customer Segment"], ["Average Order Value"])


@_asks("b19_revenue_by_month", "Completed revenue month by month", "measure", "intermediate")
def revenue_by_month(gold: Gold, p: Parameters) -> DataFrame:
    return order_analytics(gold).query(["Order Month"], ["Total Revenue"], order_by=[F.col("Order Month")])


@_asks("b20_margin_by_channel", "Gross margin by sales channel", "measure", "intermediate")
def margin_by_channel(gold: Gold, p: Parameters) -> DataFrame:
    return order_analytics(gold).query(["Order Channel"], ["Gross Margin Pct"])


@_asks("b21_delivery_days_by_carrier", "Average delivery days by carrier", "measure", "intermediate")
def delivery_days_by_carrier(gold: Gold, p: Parameters) -> DataFrame:
    return shipment_performance(gold).query(["Carrier"], ["Average Delivery Days"])


@_asks("b22_gross_profit", "Gross profit overall", "measure", "intermediate")
def gross_profit(gold: Gold, p: Parameters) -> DataFrame:
    return order_analytics(gold).query(measures=["Gross Profit"])


@_asks("b23_completed_orders", "Orders with a completed payment", "measure", "intermediate")
def completed_orders(gold: Gold, p: Parameters) -> DataFrame:
    return order_analytics(gold).query(measures=["Order Count"])


# ---- joins and exceptions ----------------------------------------------------------------------------------------


@_asks("b24_customers_with_unshipped", "Customers with orders that never shipped", "joins-exceptions", "advanced")
def customers_with_unshipped(gold: Gold, p: Parameters) -> DataFrame:
    waiting = unshipped_orders(gold, "customer_id").select("customer_id").distinct()
    return with_partner(gold.dim_customers, waiting, "customer_id").select("customer_id", "customer_name")


@_asks("b25_refunded_but_shipped", "Orders that were refunded and still shipped", "joins-exceptions", "advanced")
def refunded_but_shipped(gold: Gold, p: Parameters) -> DataFrame:
    refunds = gold.fact_transactions.where(is_refunded()).select("order_id")
    return with_partner(refunds, gold.fact_shipments, "order_id").distinct()


@_asks("b26_revenue_net_of_refunds", "Revenue with refunds taken off", "joins-exceptions", "advanced")
def revenue_net_of_refunds(gold: Gold, p: Parameters) -> DataFrame:
    return gold.fact_transactions.agg(as_double(net_of_refunds()).alias("net_revenue"))


@_asks("b27_unshipped_orders", "Number of orders that never shipped", "joins-exceptions", "advanced")
def unshipped_order_count(gold: Gold, p: Parameters) -> DataFrame:
    return unshipped_orders(gold).agg(F.count(F.lit(1)).alias("orders"))


@_asks("b28_high_value_lines", "Order lines above the high-value mark", "joins-exceptions", "advanced")
def high_value_lines(gold: Gold, p: Parameters) -> DataFrame:
    # The line key ends the sort order, so many lines of one amount still spread over all sort ranges.
    return (
        gold.fact_orders.where(is_high_value(p.high_value))
        .orderBy(F.desc("net_amount"), "order_line_id")
        .select("order_id", as_double(F.col("net_amount")).alias("net_amount"))
    )


@_asks("b29_top_customers", "Ten customers with the most completed revenue", "joins-exceptions", "advanced")
def top_customers(gold: Gold, p: Parameters) -> DataFrame:
    ranked = collected_per(gold, "customer_id").orderBy(F.desc("net_amount"), "customer_id").limit(10)
    return ranked.select("customer_id", as_double(F.col("net_amount")).alias("revenue"))


@_asks("b30_revenue_by_age_group", "Completed revenue by customer age group", "joins-exceptions", "advanced")
def revenue_by_age_group(gold: Gold, p: Parameters) -> DataFrame:
    return (
        collected_per(gold, "customer_id")
        .join(gold.dim_customers, "customer_id")
        .groupBy(age_group("birth_date", p.age_as_of).alias("age_group"))
        .agg(as_double(F.sum("net_amount")).alias("revenue"))
    )


@_asks("b31_refund_rate", "Share of transactions that were refunded", "joins-exceptions", "advanced")
def refund_rate(gold: Gold, p: Parameters) -> DataFrame:
    refunds = F.sum(F.when(is_refunded(), 1).otherwise(0))
    return gold.fact_transactions.agg(ratio(refunds, F.count(F.lit(1))).alias("refund_rate"))


@_asks("b32_region_most_unshipped", "Region with the most unshipped orders", "joins-exceptions", "advanced")
def region_most_unshipped(gold: Gold, p: Parameters) -> DataFrame:
    return (
        unshipped_orders(gold, "geo_id")
        .join(gold.dim_geography, "geo_id")
        .groupBy("region_name")
        .agg(F.count_distinct("order_id").alias("orders"))
        .orderBy(F.desc("orders"), "region_name")
        .limit(1)
    )


# ---- business rules ----------------------------------------------------------------------------------------------


@_asks("b33_fiscal_quarter_revenue", "Revenue in the last fiscal quarter", "rules", "advanced")
def fiscal_quarter_revenue(gold: Gold, p: Parameters) -> DataFrame:
    quarter = ordered_between(*fiscal_quarter_days(p.fiscal_as_of))
    return collected_total(gold, lambda orders: orders.where(quarter))


@_asks("b34_revenue_without_internal", "Completed revenue without internal accounts", "rules", "advanced")
def revenue_without_internal(gold: Gold, p: Parameters) -> DataFrame:
    outside = gold.dim_customers.where(~F.col("is_internal"))
    return with_partner(collected_per(gold, "customer_id"), outside, "customer_id").agg(
        as_double(F.sum("net_amount")).alias("revenue")
    )


@_asks("b35_active_customers", "Customers with an order in the 90 days up to the latest one", "rules", "advanced")
def active_customers(gold: Gold, p: Parameters) -> DataFrame:
    # The first day that counts is worked out inside the subquery, so the scan gets a plain bound.
    since = gold.latest_orders().agg(F.date_sub(F.max("order_date"), p.active_days)).scalar()
    orders = gold.fact_orders if gold.order_totals is None else gold.order_totals
    recent = orders.where(ordered_since(since))
    return recent.agg(F.count_distinct("customer_id").alias("customers"))


@_asks("b36_revenue_with_internal", "Completed revenue, internal accounts included", "rules", "advanced")
def revenue_with_internal(gold: Gold, p: Parameters) -> DataFrame:
    return collected_total(gold)


@_asks("b37_latest_month_summary", "Revenue, orders and margin of the latest month", "rules", "advanced")
def latest_month_summary(gold: Gold, p: Parameters) -> DataFrame:
    latest = gold.latest_orders().agg(month_of(F.max("order_date"))).scalar()
    # No line is later than the latest month; the bound only spares the scan the months before.
    recent = gold.ordered(F.col("order_month") >= latest)
    return order_analytics(recent).query(
        measures=["Total Revenue", "Order Count", "Gross Margin Pct"],
        where={"Order Month": lambda month: month == latest},
    )


@_asks("b38_internal_accounts", "Number of internal accounts", "rules", "basic")
def internal_accounts(gold: Gold, p: Parameters) -> DataFrame:
    return gold.dim_customers.where("is_internal").agg(F.count(F.lit(1)).alias("customers"))


@_asks("b39_revenue_by_country", "Completed revenue by country without internal accounts", "rules", "advanced")
def revenue_by_country(gold: Gold, p: Parameters) -> DataFrame:
    outside = gold.dim_customers.where(~F.col("is_internal"))
    return (
        with_partner(collected_per(gold, "customer_id", "geo_id"), outside, "customer_id")
        .groupBy("geo_id")
        .agg(F.sum("net_amount").alias("net_amount"))
        .join(gold.dim_geography, "geo_id")
        .groupBy("country_name")
        .agg(as_double(F.sum("net_amount")).alias("revenue"))
    )


@_asks("b40_corporate_share", "Corporate customers' share of completed revenue", "rules", "advanced")
def corporate_share(gold: Gold, p: Parameters) -> DataFrame:
    corporate = F.sum(F.when(means("segment", "Corporate"), F.col("net_amount")).otherwise(F.lit(0)))
    return (
        collected_per(gold, "customer_id")
        .join(gold.dim_customers, "customer_id")
        .agg(ratio(corporate, F.sum("net_amount")).alias("corporate_share"))
    )
