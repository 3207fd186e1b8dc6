"""Bronze: raw tables landed in the shape of a shop's source systems.

Dates arrive as ISO strings, some segment and carrier values in lower case with a leading blank, some e-mails are NULL
and order lines keep their repeated keys. Everything is integer or decimal arithmetic on the raw keys, so a table
lands the same way on every run and on every number of executors.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.operators.joins import Edge, edge_counts
from martlens.sources.raw import Raw

# The codes the source systems use.
ORDER_CHANNELS = ["Mobile", "Web", "Store", "Partner"]
CARRIERS = ["USPS", "FedEx", "UPS", "DHL"]
PAYMENT_METHODS = ["PM01", "PM02", "PM03", "PM04"]
STATE_CODES = ["CA", "NY", "TX", "IL", "WA", "FL", "MA", "ON", "QC", "BC", "AB"]
FIRST_CANADIAN_STATE = 7
ON_TIME_DAYS = 6
SHIPMENT_ID_BASE = 1_000_000_000

MONEY = "decimal(18,2)"
LINE_MONEY = "decimal(18,4)"


def _pick(values: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (position % len(values) + 1).cast("int"))


def _unclean(value: Column, key: Column) -> Column:
    return F.when(key % 10 < 3, F.concat(F.lit(" "), F.lower(value))).otherwise(value)


def _iso(day: Column) -> Column:
    return day.cast("string")


def _days_after(start: date, days: Column) -> Column:
    return F.date_add(F.lit(start), days.cast("int"))


def _is_canadian(geo_id: Column) -> Column:
    return geo_id % len(STATE_CODES) >= FIRST_CANADIAN_STATE


def bronze_customers(raw: Raw) -> DataFrame:
    key = F.col("c_custkey")
    market = F.col("c_mktsegment")
    segment = (
        F.when(market.isin("MACHINERY", "BUILDING"), "Corporate").when(market == "HOUSEHOLD", "Consumer").otherwise("SMB")
    )
    return raw.customer.select(
        key.alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.when(key % 33 != 0, F.concat(F.lit("user"), key.cast("string"), F.lit("@example.com"))).alias("email"),
        _unclean(segment, key).alias("segment"),
        _iso(_days_after(date(1994, 1, 1), key * 11 % 365)).alias("signup_date"),
        (key * 17 % 5001).alias("loyalty_points"),
        _iso(_days_after(date(1965, 1, 1), key * 37 % 14244)).alias("birth_date"),
        (key % 25 == 0).alias("is_internal"),
    )


def bronze_products(raw: Raw) -> DataFrame:
    price = F.col("p_retailprice").cast(MONEY)
    return raw.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.lit("Electronics").alias("category"),
        F.col("p_type").alias("subcategory"),
        price.alias("list_price"),
        (price * F.lit(Decimal("0.45"))).cast(LINE_MONEY).alias("standard_cost"),
    )


# The joins that landing makes; rows without a partner are not landed.
LANDING_EDGES = [
    Edge("lineitem", "orders", "order_key"),
    Edge("orders", "customer", "customer_key"),
    Edge("nation", "region", "region_key"),
]


def landed_matches(raw: Raw) -> DataFrame:
    """Rows of each raw table that landing joins to another, and how many of them find a partner and so are landed."""
    keyed = {
        "lineitem": raw.lineitem.select(F.col("l_orderkey").alias("order_key")),
        "orders": raw.orders.select(F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("customer_key")),
        "customer": raw.customer.select(F.col("c_custkey").alias("customer_key")),
        "nation": raw.nation.select(F.col("n_regionkey").alias("region_key")),
        "region": raw.region.select(F.col("r_regionkey").alias("region_key")),
    }
    return edge_counts(keyed.__getitem__, LANDING_EDGES).select("left_table", "right_table", "rows", "matched_rows")


def bronze_geography(raw: Raw) -> DataFrame:
    key = F.col("n_nationkey")
    return raw.nation.join(raw.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        key.alias("geo_id"),
        _pick(STATE_CODES, key).alias("state_code"),
        F.col("r_name").alias("region_name"),
        F.when(_is_canadian(key), "CA").otherwise("US").alias("country_code"),
        F.when(_is_canadian(key), "Canada").otherwise("United States").alias("country_name"),
    )


def bronze_orders(raw: Raw) -> DataFrame:
    """Order lines with the header's customer, place and date; repeated keys are kept.

    Headers meet customers first, so the line table is shuffled once, on the order key. ``landed_as`` carries the raw values that decide which of several lines with one key is kept.
    """
    headers = raw.orders.join(raw.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", "c_nationkey", F.col("o_orderdate").cast("date").alias("order_date")
    )
    key, part = F.col("l_orderkey"), F.col("l_partkey")
    price = F.col("l_extendedprice").cast(MONEY)
    discount = F.col("l_discount").cast("decimal(4,2)")
    cost_rate = (part % 31 + 30).cast("decimal(3,0)") * F.lit(Decimal("0.01"))
    landed_as = [
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        "l_quantity",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
    ]
    return raw.lineitem.join(headers, key == F.col("o_orderkey")).select(
        key.alias("order_id"),
        (key * 10 + F.col("l_linenumber")).alias("order_line_id"),
        F.col("o_custkey").alias("customer_id"),
        part.alias("product_id"),
        F.col("c_nationkey").alias("geo_id"),
        _iso(F.col("order_date")).alias("order_date"),
        _pick(ORDER_CHANNELS, key).alias("order_channel"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        discount.alias("discount_pct"),
        (price * (F.lit(Decimal(1)) - discount)).cast(LINE_MONEY).alias("net_amount"),
        (price * cost_rate).cast(LINE_MONEY).alias("cogs_amount"),
        F.struct(*landed_as).alias("landed_as"),
    )


def bronze_transactions(lines: DataFrame) -> DataFrame:
    """One payment per order, rolled up from clean order lines."""
    headers = lines.groupBy("order_id").agg(
        F.min("customer_id").alias("customer_id"),
        F.min("geo_id").alias("geo_id"),
        F.min("order_date").alias("order_date"),
        F.sum("net_amount").alias("amount"),
    )
    key = F.col("order_id")
    outcome = key * 37 % 100
    return headers.select(
        key.alias("transaction_id"),
        "order_id",
        "customer_id",
        _pick(PAYMENT_METHODS, F.expr("order_id div 4")).alias("payment_method"),
        _iso(F.col("order_date")).alias("txn_date"),
        "amount",
        F.when(outcome < 80, "COMPLETED")
        .when(outcome < 90, "REFUNDED")
        .when(outcome < 96, "FAILED")
        .otherwise("PENDING")
        .alias("status"),
        F.when(_is_canadian(F.col("geo_id")), "CAD").otherwise("USD").alias("currency"),
    )


def bronze_shipments(lines: DataFrame) -> DataFrame:
    """One shipment per shipped order; the orders that never ship are filtered before the roll-up."""
    headers = (
        lines.where(F.expr("order_id div 100") % 25 >= 3)
        .groupBy("order_id")
        .agg(F.min("geo_id").alias("geo_id"), F.min("order_date").alias("order_date"))
    )
    key = F.col("order_id")
    shipped = F.date_add("order_date", (key % 4).cast("int"))
    days = 2 + key * 7 % 9
    return headers.select(
        (key + SHIPMENT_ID_BASE).alias("shipment_id"),
        "order_id",
        "geo_id",
        _unclean(_pick(CARRIERS, F.expr("order_id div 16")), key).alias("carrier"),
        _iso(shipped).alias("ship_date"),
        _iso(F.date_add(shipped, days.cast("int"))).alias("delivery_date"),
        ((675 + key * 13 % 1741).cast("decimal(10,0)") * F.lit(Decimal("0.01"))).cast(MONEY).alias("shipping_cost"),
        days.alias("delivery_days"),
        (days <= ON_TIME_DAYS).alias("on_time_flag"),
    )
