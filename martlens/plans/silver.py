"""Silver: bronze with real dates, one spelling per value and one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame

from martlens.operators.cleaning import canonical, first_per_key, iso_date

# Trimmed upper-case form -> stored spelling.
SEGMENT_SPELLINGS = {"SMB": "SMB", "CONSUMER": "Consumer", "CORPORATE": "Corporate"}
CARRIER_SPELLINGS = {"USPS": "USPS", "FEDEX": "FedEx", "UPS": "UPS", "DHL": "DHL"}


def silver_customers(bronze: DataFrame) -> DataFrame:
    clean = bronze.withColumns(
        {
            "segment": canonical(bronze.segment, SEGMENT_SPELLINGS),
            "signup_date": iso_date("signup_date"),
            "birth_date": iso_date("birth_date"),
        }
    )
    return first_per_key(clean, "customer_id")


def silver_products(bronze: DataFrame) -> DataFrame:
    return bronze.select("product_id", "product_name", "category", "subcategory", "list_price", "standard_cost")


def silver_geography(bronze: DataFrame) -> DataFrame:
    return bronze.select("geo_id", "state_code", "region_name", "country_code", "country_name")


def silver_orders(bronze: DataFrame) -> DataFrame:
    """A line id belongs to one order, so lines already partitioned by order are cleaned in place."""
    clean = bronze.withColumn("order_date", iso_date("order_date"))
    order_by = ["landed_as"] if "landed_as" in bronze.columns else []
    return first_per_key(clean, "order_line_id", order_by, colocated_with="order_id").select(
        "order_id",
        "order_line_id",
        "customer_id",
        "product_id",
        "geo_id",
        "order_date",
        "order_channel",
        "quantity",
        "discount_pct",
        "net_amount",
        "cogs_amount",
    )


def silver_transactions(bronze: DataFrame) -> DataFrame:
    """A payment belongs to one order, so payments already partitioned by order are cleaned in place."""
    return first_per_key(bronze.withColumn("txn_date", iso_date("txn_date")), "transaction_id", colocated_with="order_id")


def silver_shipments(bronze: DataFrame) -> DataFrame:
    """A shipment belongs to one order, as a payment does."""
    clean = bronze.withColumns(
        {
            "carrier": canonical(bronze.carrier, CARRIER_SPELLINGS),
            "ship_date": iso_date("ship_date"),
            "delivery_date": iso_date("delivery_date"),
        }
    )
    return first_per_key(clean, "shipment_id", colocated_with="order_id")
