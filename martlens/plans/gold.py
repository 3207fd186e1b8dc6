"""Gold: the documented star schema, and the ways to obtain it."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.functions.calendar import month_of
from martlens.operators.joins import bucket_imbalance
from martlens.operators.values import value_index
from martlens.plans import silver
from martlens.session import apply_scale_settings
from martlens.sources import landing
from martlens.sources.catalog import Buckets, Layout, overwrite_table, with_comments
from martlens.sources.raw import Raw

TABLE_COMMENTS = {
    "dim_customers": "Customers, one row each.",
    "dim_products": "Products on sale, one row each.",
    "dim_geography": "States and provinces orders come from and ship to, one row each.",
    "fact_orders": "Order lines: one row per product within an order. Orders have several lines.",
    "fact_transactions": "Payments, one per order. Only a completed payment is collected revenue.",
    "fact_shipments": "Shipments, one per shipped order. An order without a row here never shipped.",
}

COLUMN_COMMENTS = {
    "dim_customers": {
        "customer_id": "Key of the customer.",
        "customer_name": "Name of the customer.",
        "email": "E-mail address; NULL where none was given.",
        "segment": "Market segment, one of SMB, Consumer, Corporate.",
        "signup_date": "Day the account was opened.",
        "loyalty_points": "Loyalty points held now.",
        "birth_date": "Day of birth.",
        "is_internal": "True for the shop's own test accounts.",
    },
    "dim_products": {
        "product_id": "Key of the product.",
        "product_name": "Name shown to customers; several products may share one.",
        "category": "Top of the product hierarchy; Electronics throughout.",
        "subcategory": "Second level of the product hierarchy.",
        "list_price": "Price of one unit before discount.",
        "standard_cost": "Cost of one unit, for margins.",
    },
    "dim_geography": {
        "geo_id": "Key of the state or province.",
        "state_code": "Two-letter code of the state or province. CA here is California.",
        "region_name": "Sales region the place belongs to.",
        "country_code": "US or CA. CA here is Canada.",
        "country_name": "Country in full.",
    },
    "fact_orders": {
        "order_id": "Order the line belongs to; repeats from line to line.",
        "order_line_id": "Key of the line.",
        "customer_id": "Customer who ordered (dim_customers).",
        "product_id": "Product ordered (dim_products).",
        "geo_id": "Where the order came from (dim_geography).",
        "order_date": "Day of the order.",
        "order_channel": "Where the order was placed: Mobile, Web, Store or Partner.",
        "quantity": "Units on the line.",
        "discount_pct": "Discount as a fraction of the price.",
        "net_amount": "Amount charged for the line, discount taken off, in the currency of the order.",
        "cogs_amount": "Cost of the goods on the line.",
        "order_month": "First day of the month of the order; the lines are stored by it.",
    },
    "fact_transactions": {
        "transaction_id": "Key of the payment.",
        "order_id": "Order that is paid (fact_orders).",
        "customer_id": "Customer who pays (dim_customers).",
        "payment_method": "Code of the means of payment, PM01 to PM04.",
        "txn_date": "Day of the payment.",
        "amount": "Net amounts of the order's lines added up, in the payment's currency.",
        "status": "COMPLETED, REFUNDED, FAILED or PENDING.",
        "currency": "USD or CAD.",
    },
    "fact_shipments": {
        "shipment_id": "Key of the shipment.",
        "order_id": "Order that is shipped (fact_orders).",
        "geo_id": "Where the shipment goes (dim_geography).",
        "carrier": "Carrier: USPS, FedEx, UPS or DHL.",
        "ship_date": "Day the goods left.",
        "delivery_date": "Day the goods arrived.",
        "shipping_cost": "Cost of the shipment.",
        "delivery_days": "Days from leaving to arriving.",
        "on_time_flag": "True when the goods took six days or fewer.",
    },
}

# One row per order, with what its lines add up to and what became of it. No table of the star schema: questions that need no
# line are answered from it.
ORDER_TOTALS = "order_totals"
ORDER_TOTALS_COMMENTS = {
    "order_id": "Key of the order.",
    "customer_id": "Customer who ordered (dim_customers).",
    "geo_id": "Where the order came from (dim_geography).",
    "order_date": "Day of the order.",
    "order_channel": "Where the order was placed: Mobile, Web, Store or Partner.",
    "lines": "Lines of the order.",
    "quantity": "Units on all lines.",
    "net_amount": "Net amounts of all lines added up.",
    "cogs_amount": "Cost of the goods on all lines.",
    "status": "Status of the order's payment, NULL without one.",
    "payment_method": "Code of the payment's means, NULL without one.",
    "currency": "Currency of the payment, NULL without one.",
    "shipped": "True where the order has a shipment.",
    "order_month": "First day of the month of the order; the totals are stored by it.",
}

# What the payment of its order says about a line. It is stored with the lines, so that questions by product meet payments
# without a join: any line is in one place, however many lines its order has.
PAYMENT_COLUMNS = ["status", "payment_method", "currency"]

# The lines are stored in a folder per month, so that bounds on the order date leave other months unread.
MONTHS = {"fact_orders": "order_month", ORDER_TOTALS: "order_month"}

# Order of the rows inside each written file. Date bounds then skip most of a file by its own statistics, and the lines
# of an order, which share a date, stay next to each other.
ROW_ORDER = {
    "fact_orders": ["order_month", "order_date", "order_id", "order_line_id"],
    "fact_transactions": ["txn_date", "order_id"],
    "fact_shipments": ["ship_date", "order_id"],
    ORDER_TOTALS: ["order_month", "order_date", "order_id"],
}

# Gold table -> (layer name, function that cleans its bronze table).
_CLEANING = {
    "dim_customers": ("customers", silver.silver_customers),
    "dim_products": ("products", silver.silver_products),
    "dim_geography": ("geography", silver.silver_geography),
    "fact_orders": ("orders", silver.silver_orders),
    "fact_transactions": ("transactions", silver.silver_transactions),
    "fact_shipments": ("shipments", silver.silver_shipments),
}


@dataclass(frozen=True)
class Gold:
    """The six tables every question is asked of, and what a build may have recorded to answer some of them with less.

    ``order_totals`` has one row per order; ``paid_lines`` are the order lines with what their payment says;
    ``latest_month`` is the last month that has a folder of order lines.
    """

    dim_customers: DataFrame
    dim_products: DataFrame
    dim_geography: DataFrame
    fact_orders: DataFrame
    fact_transactions: DataFrame
    fact_shipments: DataFrame
    order_totals: DataFrame | None = None
    paid_lines: DataFrame | None = None
    latest_month: date | None = None

    @classmethod
    def names(cls) -> list[str]:
        return list(TABLE_COMMENTS)

    def ordered(self, days: Column) -> Gold:
        """The same with only those orders whose day or month meets a condition; payments and shipments stay."""
        recorded = {"order_totals": self.order_totals, "paid_lines": self.paid_lines}
        kept = {name: None if rows is None else rows.where(days) for name, rows in recorded.items()}
        return replace(self, fact_orders=self.fact_orders.where(days), **kept)

    def latest_orders(self) -> DataFrame:
        """Orders, or their lines, among which the latest are: those of the last month where it is known."""
        rows = self.fact_orders if self.order_totals is None else self.order_totals
        return rows if self.latest_month is None else rows.where(F.col("order_month") == F.lit(self.latest_month))

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def create_views(self) -> None:
        """Make the tables available to ``spark.sql`` under their plain names."""
        for name in self.names():
            self.table(name).createOrReplaceTempView(name)


def documented(name: str, df: DataFrame) -> DataFrame:
    return with_comments(df, ORDER_TOTALS_COMMENTS if name == ORDER_TOTALS else COLUMN_COMMENTS[name])


def in_row_order(name: str, df: DataFrame) -> DataFrame:
    """Sort each partition for writing; nothing is shuffled."""
    return df.sortWithinPartitions(*ROW_ORDER[name]) if name in ROW_ORDER else df


def in_storage_order(name: str, df: DataFrame) -> tuple[DataFrame, str | None]:
    """The rows as they are written, and the column they are foldered by, if any.

    Rows of one month come together, in as many tasks as their size asks for, so that a month is a few whole files.
    """
    month = MONTHS.get(name)
    return in_row_order(name, df.hint("rebalance", month) if month else df), month


def gold_lines(clean: DataFrame) -> DataFrame:
    return documented("fact_orders", clean.withColumn("order_month", month_of("order_date")))


def derive_lines(raw: Raw) -> DataFrame:
    return gold_lines(silver.silver_orders(landing.bronze_orders(raw)))


def derive_dimensions(raw: Raw) -> dict[str, DataFrame]:
    return {
        "dim_customers": documented("dim_customers", silver.silver_customers(landing.bronze_customers(raw))),
        "dim_products": documented("dim_products", silver.silver_products(landing.bronze_products(raw))),
        "dim_geography": documented("dim_geography", silver.silver_geography(landing.bronze_geography(raw))),
    }


def derive_roll_ups(lines: DataFrame) -> dict[str, DataFrame]:
    """The tables that are rolled up from clean order lines."""
    payments = silver.silver_transactions(landing.bronze_transactions(lines))
    shipments = silver.silver_shipments(landing.bronze_shipments(lines))
    return {
        "fact_transactions": documented("fact_transactions", payments),
        "fact_shipments": documented("fact_shipments", shipments),
    }


def derive_paid_lines(lines: DataFrame, payments: DataFrame) -> DataFrame:
    """The lines with what the payment of their order says, NULL without one. An order has at most one payment.

    Adaptive execution splits the lines of a heavy order here, once for all questions.
    """
    met = lines.join(payments.select("order_id", *PAYMENT_COLUMNS), "order_id", "left")
    # The folder column comes last, as it does when it is read back.
    own = [name for name in COLUMN_COMMENTS["fact_orders"] if name != MONTHS["fact_orders"]]
    return documented("fact_orders", met.select(*own, *PAYMENT_COLUMNS, MONTHS["fact_orders"]))


def plain_lines(paid_lines: DataFrame) -> DataFrame:
    """The lines as the star schema has them."""
    return paid_lines.select(*COLUMN_COMMENTS["fact_orders"])


def derive_order_totals(lines: DataFrame, payments: DataFrame, shipments: DataFrame) -> DataFrame:
    """One row per order, if its lines agree on customer, place, day and channel; the build checks that they do."""
    of_lines = lines.groupBy("order_id", "customer_id", "geo_id", "order_date", "order_channel", "order_month").agg(
        F.count(F.lit(1)).alias("lines"), *[F.sum(name).alias(name) for name in ("quantity", "net_amount", "cogs_amount")]
    )
    shipped = shipments.select("order_id").distinct().withColumn("shipped", F.lit(True))
    met = of_lines.join(payments.select("order_id", "status", "payment_method", "currency"), "order_id", "left")
    met = met.join(shipped, "order_id", "left").withColumn("shipped", F.coalesce("shipped", F.lit(False)))
    # The folder column comes last, as it does when it is read back.
    return documented(ORDER_TOTALS, met.select(*ORDER_TOTALS_COMMENTS))


def derive_gold(raw: Raw) -> Gold:
    """The whole chain raw -> bronze -> silver -> gold as lazy frames: every question derives what it reads."""
    lines = derive_lines(raw)
    return Gold(fact_orders=lines, **derive_dimensions(raw), **derive_roll_ups(lines))


# Coded columns whose distinct values are indexed, so that user terms can be matched with what is stored.
INDEXED_COLUMNS = {
    "fact_transactions": ["payment_method", "currency"],
    "dim_geography": ["state_code"],
    "dim_customers": ["segment"],
}

# How much fuller than an even share the fullest bucket of a table may be.
MOST_IMBALANCE = 3.0


def stored_values(gold: Gold) -> DataFrame:
    """The value index of the coded columns."""
    return value_index([(gold.table(name), columns) for name, columns in INDEXED_COLUMNS.items()])


# ---- catalog build -----------------------------------------------------------------------------------------------


def land_bronze(spark: SparkSession, raw: Raw, layout: Layout) -> dict[str, int]:
    """Write the six bronze tables; payments and shipments are rolled up from the cleaned lines just written."""
    layout.ensure_schema(spark)
    written = {}
    for name, df in {
        "customers": landing.bronze_customers(raw),
        "products": landing.bronze_products(raw),
        "geography": landing.bronze_geography(raw),
        "orders": landing.bronze_orders(raw),
    }.items():
        written[layout.bronze(name)] = overwrite_table(df, layout.bronze(name))
    lines = silver.silver_orders(spark.table(layout.bronze("orders")))
    for name, rolled_up in {
        "transactions": landing.bronze_transactions(lines),
        "shipments": landing.bronze_shipments(lines),
    }.items():
        written[layout.bronze(name)] = overwrite_table(rolled_up, layout.bronze(name))
    return written


def build_silver(spark: SparkSession, layout: Layout) -> dict[str, int]:
    return {
        layout.silver(name): overwrite_table(clean(spark.table(layout.bronze(name))), layout.silver(name))
        for name, clean in _CLEANING.values()
    }


def build_gold(spark: SparkSession, layout: Layout, order_buckets: int | None = None) -> dict[str, int]:
    """Write the six gold tables with table and column comments; returns the row count of each.

    With ``order_buckets`` the facts are stored in as many buckets of the order key, so that they join without a shuffle. A
    bucket is one task's work: if an order has so many lines that one bucket holds several even shares, nothing is written
    and the build fails; such facts are better left unbucketed, where their joins are shuffled and heavy partitions split.
    """
    if order_buckets:
        imbalance = bucket_imbalance(spark.table(layout.silver("orders")), "order_id", order_buckets)
        if imbalance > MOST_IMBALANCE:
            raise ValueError(f"one of {order_buckets} buckets would hold {imbalance:.1f} even shares of the order lines")
    written = {}
    for table, (name, _) in _CLEANING.items():
        clean, buckets = spark.table(layout.silver(name)), None
        df = gold_lines(clean) if table == "fact_orders" else documented(table, clean)
        if order_buckets and table in ROW_ORDER:
            df = df.repartition(order_buckets, "order_id")
            buckets = Buckets(order_buckets, "order_id", tuple(c for c in ROW_ORDER[table] if c != MONTHS.get(table)))
            month = MONTHS.get(table)
        else:
            df, month = in_storage_order(table, df)
        written[layout.gold(table)] = overwrite_table(df, layout.gold(table), TABLE_COMMENTS[table], buckets, month)
    return written


def gold_from_catalog(spark: SparkSession, layout: Layout) -> Gold:
    """The catalog's tables. The latest month comes from the names of the folders, which the catalog keeps."""
    apply_scale_settings(spark)
    folders = spark.sql(f"SHOW PARTITIONS {layout.gold('fact_orders')}").collect()
    return Gold(
        **{name: spark.table(layout.gold(name)) for name in Gold.names()},
        latest_month=latest_month([row["partition"] for row in folders]),
    )


def latest_month(folders: list[str]) -> date | None:
    """The last month among folder names of the kind ``order_month=2001-05-01``."""
    months = [name.partition("=")[2] for name in folders if name.startswith(f"{MONTHS['fact_orders']}=")]
    return max((date.fromisoformat(month) for month in months if month[:1].isdigit()), default=None)
