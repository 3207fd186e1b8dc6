"""Worked examples of patterns the metric views leave out, and uses of the reusable filters, measures and fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.functions.amounts import (
    as_double,
    distinct_customers,
    flag_rate,
    is_completed,
    is_high_value,
    is_refunded,
    net_of_refunds,
    ratio,
)
from martlens.functions.calendar import (
    fiscal_quarter,
    fiscal_quarter_start,
    fiscal_year,
    month_of,
)
from martlens.functions.fields import age_group, order_size
from martlens.operators.joins import with_partner
from martlens.plans.bank import customers_with_unshipped
from martlens.plans.gold import Gold
from martlens.plans.parameters import Parameters
from martlens.plans.revenue import collected_orders, collected_per


def unshipped_customers(gold: Gold, p: Parameters) -> DataFrame:
    return customers_with_unshipped(gold, p)


def refunded_and_shipped(gold: Gold, p: Parameters) -> DataFrame:
    refunds = gold.fact_transactions.where(is_refunded()).select("order_id", "amount")
    shipped = gold.fact_shipments.select("order_id", "ship_date")
    return refunds.join(shipped, "order_id").distinct().withColumn("amount", as_double(F.col("amount")))


def top_products(gold: Gold, p: Parameters) -> DataFrame:
    """Five product names with the most completed revenue; products of one name count together."""
    return (
        collected_per(gold, "product_id")
        .join(gold.dim_products, "product_id")
        .groupBy("product_name")
        .agg(as_double(F.round(F.sum("net_amount"), 2)).alias("revenue"))
        .orderBy(F.desc("revenue"), "product_name")
        .limit(5)
    )


def monthly_revenue(gold: Gold, p: Parameters) -> DataFrame:
    return (
        collected_per(gold, "order_date")
        .groupBy(month_of("order_date").alias("month"))
        .agg(as_double(F.round(F.sum("net_amount"), 2)).alias("revenue"))
        .orderBy("month")
    )


def monthly_net_revenue(gold: Gold, p: Parameters) -> DataFrame:
    return (
        gold.fact_transactions.groupBy(month_of("txn_date").alias("month"))
        .agg(as_double(F.round(net_of_refunds(), 2)).alias("net_revenue"))
        .orderBy("month")
    )


def margin_without_internal(gold: Gold, p: Parameters) -> DataFrame:
    """Margin per subcategory over all orders, paid or not, of outside customers."""
    outside = gold.dim_customers.where(~F.col("is_internal"))
    margin = F.sum(F.col("net_amount") - F.col("cogs_amount")).alias("margin")
    per_customer = gold.fact_orders.groupBy("customer_id", "product_id").agg(margin, F.sum("net_amount").alias("net_amount"))
    per_product = (
        with_partner(per_customer, outside, "customer_id")
        .groupBy("product_id")
        .agg(F.sum("margin").alias("margin"), F.sum("net_amount").alias("net_amount"))
    )
    return (
        per_product.join(gold.dim_products, "product_id")
        .groupBy("subcategory")
        .agg(F.round(ratio(F.sum("margin"), F.sum("net_amount")) * 100, 1).alias("margin_pct"))
        .orderBy(F.desc("margin_pct"), "subcategory")
    )


def punctuality_by_carrier(gold: Gold, p: Parameters) -> DataFrame:
    return (
        gold.fact_shipments.groupBy("carrier")
        .agg(
            F.round(flag_rate("on_time_flag") * 100, 1).alias("on_time_pct"),
            F.count(F.lit(1)).alias("shipments"),
        )
        .orderBy(F.desc("on_time_pct"), "carrier")
    )


def repeat_customers(gold: Gold, p: Parameters) -> DataFrame:
    return (
        collected_orders(gold)
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            as_double(F.round(F.sum("net_amount"), 2)).alias("spend"),
        )
        .where("orders > 1")
        .orderBy(F.desc("spend"), "customer_id")
    )


# ---- reusable filters, measures and fields in use ------------------------------------------------------------------


def high_value_summary(gold: Gold, p: Parameters) -> DataFrame:
    return (
        gold.fact_orders.where(is_high_value(p.high_value))
        .groupBy("order_channel")
        .agg(F.count(F.lit(1)).alias("lines"), as_double(F.sum("net_amount")).alias("net_amount"))
    )


def refunds_by_method(gold: Gold, p: Parameters) -> DataFrame:
    return (
        gold.fact_transactions.where(is_refunded())
        .groupBy("payment_method")
        .agg(F.count(F.lit(1)).alias("transactions"), as_double(F.sum("amount")).alias("amount"))
    )


def net_revenue_by_currency(gold: Gold, p: Parameters) -> DataFrame:
    return gold.fact_transactions.groupBy("currency").agg(as_double(net_of_refunds()).alias("net_revenue"))


def customers_by_channel(gold: Gold, p: Parameters) -> DataFrame:
    return gold.fact_orders.groupBy("order_channel").agg(distinct_customers().alias("customers"))


def customers_by_age_group(gold: Gold, p: Parameters) -> DataFrame:
    return gold.dim_customers.groupBy(age_group("birth_date", p.age_as_of).alias("age_group")).agg(
        F.count(F.lit(1)).alias("customers")
    )


def lines_by_order_size(gold: Gold, p: Parameters) -> DataFrame:
    size = order_size("net_amount", p.small_below, p.medium_below)
    return gold.fact_orders.groupBy(size.alias("order_size")).agg(
        F.count(F.lit(1)).alias("lines"), as_double(F.sum("net_amount")).alias("net_amount")
    )


# ---- business rules in use ---------------------------------------------------------------------------------------


def revenue_by_fiscal_quarter(gold: Gold, p: Parameters) -> DataFrame:
    per_day = collected_per(gold, "order_date")
    return (
        per_day.groupBy(
            fiscal_year("order_date").cast("bigint").alias("fiscal_year"),
            fiscal_quarter("order_date").cast("bigint").alias("fiscal_quarter"),
            fiscal_quarter_start("order_date").alias("starts_on"),
        )
        .agg(as_double(F.sum("net_amount")).alias("revenue"))
        .orderBy("starts_on")
    )


def revenue_by_account_kind(gold: Gold, p: Parameters) -> DataFrame:
    return (
        collected_per(gold, "customer_id")
        .join(gold.dim_customers, "customer_id")
        .groupBy("is_internal")
        .agg(as_double(F.sum("net_amount")).alias("revenue"))
    )


def revenue_definitions(gold: Gold, p: Parameters) -> DataFrame:
    """Collected revenue and the same with refunds taken off, side by side per year."""
    collected = F.sum(F.when(is_completed(), F.col("amount")).otherwise(F.lit(0)))
    return gold.fact_transactions.groupBy(F.year("txn_date").cast("bigint").alias("year")).agg(
        as_double(collected).alias("revenue_completed"),
        as_double(net_of_refunds()).alias("revenue_net_of_refunds"),
    )


def revenue_by_currency(gold: Gold, p: Parameters) -> DataFrame:
    """Amounts in their own currency; nothing is converted."""
    paid = gold.fact_transactions.where(is_completed())
    return paid.groupBy("currency").agg(as_double(F.sum("amount")).alias("revenue"))
