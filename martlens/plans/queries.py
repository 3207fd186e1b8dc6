"""Every query of the package by name, as functions of a session and a folder of raw tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlens.functions.amounts import as_double, is_high_value, is_refunded, net_of_refunds
from martlens.functions.fields import age_group, order_size
from martlens.functions.vocabulary import CODE_WORDS, code_table, word_table
from martlens.operators.joins import EDGES, edge_counts
from martlens.operators.values import decode, resolve, resolve_names, rows_meaning
from martlens.plans import bank, examples, silver, truths
from martlens.plans.gold import MONTHS, Gold, stored_values
from martlens.plans.parameters import TABLE_PARAMETERS
from martlens.plans.store import open_gold, open_index, ready_store
from martlens.plans.views import order_analytics, shipment_performance
from martlens.sources import landing
from martlens.sources.raw import read_raw

Runner = Callable[[SparkSession, str], DataFrame]

# Words a user may type, with the usual slips, for the queries that resolve terms.
USER_TERMS = [
    "PayPal",
    "paypall",
    " Gift Card ",
    "giftcard",
    "credit crad",
    "enterprise",
    "B2B",
    "small busines",
    "retial",
    "California",
    "Californa",
    "Ontaro",
    "quebek",
    "Texs",
    "CA",
    "on",
    "Canadian dollar",
    "usd",
    "corporate",
    "bitcoin",
]


# The same for reusable filters, measures and fields.
SNIPPET_TERMS = [
    "big orders",
    "Large Order",
    "refunds only",
    "net revenue",
    "revenu after refunds",
    "Unique Customers",
    "age bracket",
    "basket sise",
    "campaign",
]


def plain_amounts(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for output."""
    return df.select(
        *[
            as_double(F.col(field.name)).alias(field.name) if isinstance(field.dataType, T.DecimalType) else field.name
            for field in df.schema.fields
        ]
    )


# ---- layers ------------------------------------------------------------------------------------------------------


def _bronze(spark: SparkSession, raw_dir: str, name: str) -> DataFrame:
    if name in ("transactions", "shipments"):
        lines = open_gold(spark, raw_dir).fact_orders
        return {"transactions": landing.bronze_transactions, "shipments": landing.bronze_shipments}[name](lines)
    land = {
        "customers": landing.bronze_customers,
        "products": landing.bronze_products,
        "geography": landing.bronze_geography,
        "orders": landing.bronze_orders,
    }[name]
    return land(read_raw(spark, raw_dir))


def bronze_table(spark: SparkSession, raw_dir: str, name: str) -> DataFrame:
    return plain_amounts(_bronze(spark, raw_dir, name).drop("landed_as"))


def silver_table(spark: SparkSession, raw_dir: str, name: str) -> DataFrame:
    clean = getattr(silver, f"silver_{name}")
    return plain_amounts(clean(_bronze(spark, raw_dir, name)))


def gold_table(spark: SparkSession, raw_dir: str, name: str) -> DataFrame:
    """A gold table without the column it is stored by."""
    return plain_amounts(open_gold(spark, raw_dir).table(name).drop(*MONTHS.values()))


def table_row_counts(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Rows of each gold table: as counted by the sink while it wrote them, and as they are found now."""
    store = ready_store(spark, raw_dir)
    counted = [
        store.gold.table(name).agg(
            F.lit(name).alias("table_name"),
            F.lit(store.written_rows[name]).cast("bigint").alias("written_rows"),
            F.count(F.lit(1)).alias("rows"),
        )
        for name in Gold.names()
    ]
    return reduce(DataFrame.unionByName, counted)


def canonical_values(spark: SparkSession, raw_dir: str) -> DataFrame:
    """What cleaning makes of each raw spelling of segment and carrier, with row counts."""
    pairs = []
    for table, column, spellings in [
        ("customers", "segment", silver.SEGMENT_SPELLINGS),
        ("shipments", "carrier", silver.CARRIER_SPELLINGS),
    ]:
        raw_value = F.col(column)
        per_spelling = _bronze(spark, raw_dir, table).groupBy(raw_value.alias("raw_value")).agg(
            F.count(F.lit(1)).alias("rows")
        )
        clean = silver.canonical(F.col("raw_value"), spellings)
        pairs.append(per_spelling.select(F.lit(column).alias("column_name"), "raw_value", clean.alias("value"), "rows"))
    return reduce(DataFrame.unionByName, pairs)


def line_preview(gold: Gold) -> DataFrame:
    """Ten order lines with the smallest keys."""
    return plain_amounts(gold.fact_orders.drop(*MONTHS.values()).orderBy("order_line_id").limit(10))


# ---- declared joins ----------------------------------------------------------------------------------------------


def edge_repeats(gold: Gold) -> DataFrame:
    """How many keys repeat on the 'one' side of each declared join; zero when the declaration holds."""
    return edge_counts(gold.table, EDGES).select("left_table", "right_table", "repeated_keys")


def edge_matches(gold: Gold) -> DataFrame:
    """How many rows of the 'many' side of each declared join find a partner."""
    return edge_counts(gold.table, EDGES).select("left_table", "right_table", "rows", "matched_rows")


# ---- metric views ------------------------------------------------------------------------------------------------


def _by(view: Callable, dims: tuple[str, ...]) -> Callable[[Gold], DataFrame]:
    def run(gold: Gold) -> DataFrame:
        opened = view(gold)
        return opened.query(dims, list(opened.measures))

    return run


def best_subcategories(gold: Gold) -> DataFrame:
    return order_analytics(gold).query(
        ["Subcategory"],
        ["Gross Margin Pct", "Total Revenue"],
        order_by=[F.desc("Total Revenue"), F.col("Subcategory")],
        limit=5,
    )


def punctual_regions(gold: Gold) -> DataFrame:
    return shipment_performance(gold).query(
        ["Region"], ["On Time Rate", "Shipment Count"], order_by=[F.desc("On Time Rate"), F.col("Region")]
    )


def web_revenue_by_country(gold: Gold) -> DataFrame:
    """A condition on a dimension that is not in the result."""
    return order_analytics(gold).query(
        ["Country", "Currency"],
        ["Total Revenue", "Order Count"],
        where={"Order Channel": lambda channel: channel == "Web", "Subcategory": lambda s: s.isNotNull()},
    )


# ---- words for codes ---------------------------------------------------------------------------------------------

_CODED_IN = {
    "payment_method": "fact_transactions",
    "currency": "fact_transactions",
    "state_code": "dim_geography",
    "segment": "dim_customers",
}


def decoded_counts(spark: SparkSession, raw_dir: str, column: str) -> DataFrame:
    """Rows per code of a column, with the label of the code."""
    rows = open_gold(spark, raw_dir).table(_CODED_IN[column])
    per_code = rows.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return decode(per_code, code_table(spark, column), column, "label")


def words_in_use(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Every word of the vocabulary with the rows it stands for; words for a whole column stand for all its rows."""
    stored = open_index(spark, raw_dir).select("column_name", F.col("value").alias("code"), "rows")
    everything = stored.groupBy("column_name").agg(F.sum("rows").alias("rows"))
    words = word_table(spark).where("kind IN ('code', 'column')")
    for_codes = words.where("code IS NOT NULL").join(stored, ["column_name", "code"])
    for_columns = words.where("code IS NULL").join(everything, "column_name")
    return for_codes.unionByName(for_columns).select("term", "column_name", "code", "rows")


def user_terms(spark: SparkSession, terms: list[str] = USER_TERMS) -> DataFrame:
    return spark.createDataFrame(pa.table({"term": terms}))


def resolved_terms(spark: SparkSession, raw_dir: str) -> DataFrame:
    return resolve(user_terms(spark), open_index(spark, raw_dir), word_table(spark))


def payments_by_term(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Payments made the way the user terms say, right or wrong spelling.

    The payments are added up per code before the codes that are meant are picked, so few rows meet the terms.
    """
    per_code = open_gold(spark, raw_dir).fact_transactions.groupBy("payment_method", "status").agg(
        F.count(F.lit(1)).alias("transactions"), as_double(F.sum("amount")).alias("amount")
    )
    return rows_meaning(per_code, "payment_method", resolved_terms(spark, raw_dir))


def orders_by_term(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Order lines from the places the user terms name, added up per place before the places are joined."""
    gold = open_gold(spark, raw_dir)
    places = rows_meaning(gold.dim_geography, "state_code", resolved_terms(spark, raw_dir))
    per_place = gold.fact_orders.groupBy("geo_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("net_amount").alias("net_amount")
    )
    return (
        per_place.join(places.select("geo_id", "state_code"), "geo_id")
        .groupBy("state_code")
        .agg(F.sum("lines").alias("lines"), as_double(F.sum("net_amount")).alias("net_amount"))
    )


def numbers_by_term(spark: SparkSession, raw_dir: str, terms: list[str] = SNIPPET_TERMS) -> DataFrame:
    """What the reusable filters, measures and fields give whose words the user typed: (term, kind, name, number).

    A filter gives the rows it keeps, a measure its value, a field the number of its groups. The words are resolved before the
    facts are planned, so only the numbers asked for are computed and tables without any are not read.
    """
    gold, p = open_gold(spark, raw_dir), TABLE_PARAMETERS
    # At most one name for each term and kind.
    named = resolve_names(user_terms(spark, terms), word_table(spark)).select("term", "kind", "name").toArrow()
    asked = set(named.column("name").to_pylist())
    known = [
        (
            gold.fact_orders,
            {
                "is_high_value": F.count(F.when(is_high_value(p.high_value), 1)),
                "distinct_customers": F.count_distinct("customer_id"),
                "order_size": F.count_distinct(order_size("net_amount", p.small_below, p.medium_below)),
            },
        ),
        (gold.fact_transactions, {"is_refunded": F.count(F.when(is_refunded(), 1)), "net_of_refunds": net_of_refunds()}),
        (gold.dim_customers, {"age_group": F.count_distinct(age_group("birth_date", p.age_as_of))}),
    ]
    numbers = spark.createDataFrame([], "name string, number double")
    for table, measures in known:
        chosen = [as_double(measure).alias(name) for name, measure in measures.items() if name in asked]
        if chosen:
            row = table.agg(*chosen)
            numbers = numbers.unionByName(row.unpivot([], row.columns, "name", "number"))
    return spark.createDataFrame(named).join(numbers, "name").select("term", "kind", "name", "number")


# ---- registry ----------------------------------------------------------------------------------------------------


def _over_gold(query: Callable[[Gold], DataFrame]) -> Runner:
    return lambda spark, raw_dir: query(open_gold(spark, raw_dir))


def _with_parameters(query: bank.Query) -> Runner:
    return lambda spark, raw_dir: query(open_gold(spark, raw_dir), TABLE_PARAMETERS)


def answer_step(spark: SparkSession, raw_dir: str, step: int) -> DataFrame:
    return truths.answer_table(spark, open_gold(spark, raw_dir), TABLE_PARAMETERS, step)


ORDER_DIMENSIONS = {
    "order_month": "Order Month",
    "channel": "Order Channel",
    "region": "Region",
    "state": "State",
    "country": "Country",
    "category": "Category",
    "subcategory": "Subcategory",
    "product": "Product",
    "segment": "Customer Segment",
    "payment_method": "Payment Method",
    "currency": "Currency",
}
SHIPMENT_DIMENSIONS = {"ship_month": "Ship Month", "region": "Region", "state": "State", "carrier": "Carrier"}
LAYER_TABLES = ["customers", "products", "geography", "orders", "transactions", "shipments"]


def all_queries() -> dict[str, Runner]:
    found: dict[str, Runner] = {}
    for name in LAYER_TABLES:
        found[f"s3_bronze_{name}"] = partial(bronze_table, name=name)
        found[f"p6_silver_{name}"] = partial(silver_table, name=name)
    found["s3_landed_matches"] = lambda spark, raw_dir: landing.landed_matches(read_raw(spark, raw_dir))
    for name in Gold.names():
        found[f"p7_gold_{name}"] = partial(gold_table, name=name)
    found["p7_table_row_counts"] = table_row_counts
    found["p1_canonical_values"] = canonical_values
    found["s8_line_preview"] = _over_gold(line_preview)
    found["j7_edge_matches"] = _over_gold(edge_matches)
    found["mvk_edge_repeats"] = _over_gold(edge_repeats)

    found.update({item.id: _with_parameters(item.query) for item in bank.BANK})

    found["mv1_total"] = _over_gold(_by(order_analytics, ()))
    for short, dimension in ORDER_DIMENSIONS.items():
        found[f"mv1_by_{short}"] = _over_gold(_by(order_analytics, (dimension,)))
    found["mv1_by_region_segment"] = _over_gold(_by(order_analytics, ("Region", "Customer Segment")))
    found["mv1_web_by_country"] = _over_gold(web_revenue_by_country)
    found["mv2_total"] = _over_gold(_by(shipment_performance, ()))
    for short, dimension in SHIPMENT_DIMENSIONS.items():
        found[f"mv2_by_{short}"] = _over_gold(_by(shipment_performance, (dimension,)))
    found["mvq1_best_subcategories"] = _over_gold(best_subcategories)
    found["mvq2_punctual_regions"] = _over_gold(punctual_regions)

    for name, query in {
        "x1_unshipped_customers": examples.unshipped_customers,
        "x2_refunded_and_shipped": examples.refunded_and_shipped,
        "x3_top_products": examples.top_products,
        "x4_monthly_revenue": examples.monthly_revenue,
        "x5_monthly_net_revenue": examples.monthly_net_revenue,
        "x6_margin_without_internal": examples.margin_without_internal,
        "x7_punctuality_by_carrier": examples.punctuality_by_carrier,
        "x8_repeat_customers": examples.repeat_customers,
        "xf1_high_value_summary": examples.high_value_summary,
        "xf2_refunds_by_method": examples.refunds_by_method,
        "xm1_net_revenue_by_currency": examples.net_revenue_by_currency,
        "xm2_customers_by_channel": examples.customers_by_channel,
        "xe1_customers_by_age_group": examples.customers_by_age_group,
        "xe2_lines_by_order_size": examples.lines_by_order_size,
        "r1_revenue_by_fiscal_quarter": examples.revenue_by_fiscal_quarter,
        "r2_revenue_by_account_kind": examples.revenue_by_account_kind,
        "r3_revenue_definitions": examples.revenue_definitions,
        "r6_revenue_by_currency": examples.revenue_by_currency,
        "qa1_half_year_by_subcategory": truths.half_year_by_subcategory,
        "qa2_slowest_carrier_to_canada": truths.slowest_carrier_to_canada,
        "qa3_best_customers": truths.best_customers,
    }.items():
        found[name] = _with_parameters(query)

    for at, column in enumerate(CODE_WORDS, start=1):
        found[f"v{at}_decoded_{column}"] = partial(decoded_counts, column=column)
    found["v5_words_in_use"] = words_in_use
    found["v5_numbers_by_term"] = numbers_by_term
    found["v6_stored_values"] = _over_gold(stored_values)
    found["v7_resolved_terms"] = resolved_terms
    found["v8_payments_by_term"] = payments_by_term
    found["v8_orders_by_term"] = orders_by_term

    found.update({id: _with_parameters(answer.query) for id, answer in truths.answers(TABLE_PARAMETERS).items()})
    for step in sorted({q.step for q in truths.QUESTIONS}):
        found[f"e2_answers_step{step}"] = partial(answer_step, step=step)
    return found
