"""Questions with a right answer and, where there is a usual mistake, the number the mistake gives.

Every answer is a DataFrame of one row and one column. ``sql`` states the same query as portable SQL over the gold
tables, for readers of the answer table. The dates in it come from the parameters.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.functions.amounts import (
    as_double,
    displayed,
    flag_rate,
    is_completed,
    is_refunded,
    net_of_refunds,
    ratio,
)
from martlens.functions.calendar import fiscal_quarter_days, last_calendar_quarter_days, ordered_between
from martlens.functions.vocabulary import means
from martlens.operators.joins import with_partner
from martlens.plans import bank
from martlens.plans.gold import Gold
from martlens.plans.parameters import Parameters
from martlens.plans.revenue import collected_total

AMOUNT, COUNT, PERCENT = "amount", "count", "percent"


@dataclass(frozen=True)
class Answer:
    """A one-number query: how to run it, how to show it, and the SQL that says the same."""

    id: str
    column: str
    kind: str
    query: bank.Query
    sql: str


def enterprise_spend(gold: Gold, p: Parameters) -> DataFrame:
    """Orders of Corporate customers, whatever became of the payment."""
    per_customer = gold.fact_orders.groupBy("customer_id").agg(F.sum("net_amount").alias("net_amount"))
    enterprise = gold.dim_customers.where(means("segment", "enterprise"))
    return with_partner(per_customer, enterprise, "customer_id").agg(as_double(F.sum("net_amount")).alias("spend"))


def cad_revenue(gold: Gold, p: Parameters) -> DataFrame:
    paid = gold.fact_transactions.where(means("currency", "Canadian dollars") & is_completed())
    return paid.agg(as_double(F.sum("amount")).alias("revenue"))


def completed_revenue(gold: Gold, p: Parameters) -> DataFrame:
    return collected_total(gold)


def order_value(gold: Gold, p: Parameters) -> DataFrame:
    """Average over all orders, paid or not."""
    return gold.fact_orders.agg(ratio(F.sum("net_amount"), F.count_distinct("order_id")).alias("average_order_value"))


def line_average(gold: Gold, p: Parameters) -> DataFrame:
    return gold.fact_orders.agg(ratio(F.sum("net_amount"), F.count("net_amount")).alias("average_order_value"))


def margin_pct(gold: Gold, p: Parameters) -> DataFrame:
    """Margin over all orders, paid or not."""
    margin = F.sum(F.col("net_amount") - F.col("cogs_amount"))
    return gold.fact_orders.agg((ratio(margin, F.sum("net_amount")) * 100).alias("margin_pct"))


def mean_line_margin_pct(gold: Gold, p: Parameters) -> DataFrame:
    net, cogs = as_double(F.col("net_amount")), as_double(F.col("cogs_amount"))
    return gold.fact_orders.agg(F.round(F.avg(F.try_divide(net - cogs, net)) * 100, 4).alias("margin_pct"))


def on_time_rate(gold: Gold, p: Parameters) -> DataFrame:
    return gold.fact_shipments.agg((flag_rate("on_time_flag") * 100).alias("on_time_pct"))


def refunded_and_shipped_count(gold: Gold, p: Parameters) -> DataFrame:
    refunds = gold.fact_transactions.where(is_refunded()).select("order_id")
    return with_partner(refunds, gold.fact_shipments, "order_id").agg(F.count_distinct("order_id").alias("orders"))


def calendar_quarter_revenue(gold: Gold, p: Parameters) -> DataFrame:
    quarter = ordered_between(*last_calendar_quarter_days(p.fiscal_as_of))
    return collected_total(gold, lambda orders: orders.where(quarter))


def completed_payments_only(gold: Gold, p: Parameters) -> DataFrame:
    paid = gold.fact_transactions.where(is_completed())
    return paid.agg(as_double(F.sum("amount")).alias("net_revenue"))


def customers_ever(gold: Gold, p: Parameters) -> DataFrame:
    return gold.fact_orders.agg(F.count_distinct("customer_id").alias("customers"))


_COLLECTED = "SELECT order_id FROM fact_transactions WHERE status = 'COMPLETED'"
_REVENUE = f"SELECT SUM(net_amount) AS revenue FROM fact_orders WHERE order_id IN ({_COLLECTED})"


def answers(p: Parameters) -> dict[str, Answer]:
    """All answers by id: ``q..`` are right, ``t..`` are the usual mistakes."""
    fiscal, calendar = (
        f"{_REVENUE} AND order_date BETWEEN DATE '{first}' AND DATE '{last}'"
        for first, last in (fiscal_quarter_days(p.fiscal_as_of), last_calendar_quarter_days(p.fiscal_as_of))
    )
    listed = [
        Answer(
            "q01_paypal_revenue",
            "revenue",
            AMOUNT,
            bank.paypal_revenue,
            "SELECT SUM(amount) AS revenue FROM fact_transactions"
            " WHERE status = 'COMPLETED' AND payment_method = 'PM02'",
        ),
        Answer(
            "q02_gift_card_revenue",
            "revenue",
            AMOUNT,
            bank.gift_card_amount,
            "SELECT SUM(amount) AS revenue FROM fact_transactions"
            " WHERE status = 'COMPLETED' AND payment_method = 'PM03'",
        ),
        Answer(
            "q03_enterprise_spend",
            "spend",
            AMOUNT,
            enterprise_spend,
            "SELECT SUM(net_amount) AS spend FROM fact_orders"
            " WHERE customer_id IN (SELECT customer_id FROM dim_customers WHERE segment = 'Corporate')",
        ),
        Answer(
            "q04_cad_revenue",
            "revenue",
            AMOUNT,
            cad_revenue,
            "SELECT SUM(amount) AS revenue FROM fact_transactions WHERE status = 'COMPLETED' AND currency = 'CAD'",
        ),
        Answer("q05_completed_revenue", "revenue", AMOUNT, completed_revenue, _REVENUE),
        Answer(
            "t05_all_orders",
            "total_net_amount",
            AMOUNT,
            bank.net_amount_total,
            "SELECT SUM(net_amount) AS total_net_amount FROM fact_orders",
        ),
        Answer(
            "q06_order_value",
            "average_order_value",
            AMOUNT,
            order_value,
            "SELECT CAST(SUM(net_amount) AS DOUBLE) / COUNT(DISTINCT order_id) AS average_order_value FROM fact_orders",
        ),
        Answer(
            "t06_line_average",
            "average_order_value",
            AMOUNT,
            line_average,
            "SELECT CAST(SUM(net_amount) AS DOUBLE) / COUNT(net_amount) AS average_order_value FROM fact_orders",
        ),
        Answer(
            "q07_margin_pct",
            "margin_pct",
            PERCENT,
            margin_pct,
            "SELECT CAST(SUM(net_amount - cogs_amount) AS DOUBLE) / CAST(SUM(net_amount) AS DOUBLE) * 100"
            " AS margin_pct FROM fact_orders",
        ),
        Answer(
            "t07_mean_line_margin",
            "margin_pct",
            PERCENT,
            mean_line_margin_pct,
            "SELECT ROUND(AVG((CAST(net_amount AS DOUBLE) - CAST(cogs_amount AS DOUBLE))"
            " / NULLIF(CAST(net_amount AS DOUBLE), 0)) * 100, 4) AS margin_pct FROM fact_orders",
        ),
        Answer(
            "q08_on_time_rate",
            "on_time_pct",
            PERCENT,
            on_time_rate,
            "SELECT AVG(CASE WHEN on_time_flag THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) * 100"
            " AS on_time_pct FROM fact_shipments",
        ),
        Answer(
            "q09_net_of_refunds",
            "net_revenue",
            AMOUNT,
            bank.revenue_net_of_refunds,
            "SELECT SUM(CASE status WHEN 'COMPLETED' THEN amount WHEN 'REFUNDED' THEN -amount ELSE 0 END)"
            " AS net_revenue FROM fact_transactions",
        ),
        Answer(
            "t09_refunds_ignored",
            "net_revenue",
            AMOUNT,
            completed_payments_only,
            "SELECT SUM(amount) AS net_revenue FROM fact_transactions WHERE status = 'COMPLETED'",
        ),
        Answer(
            "q10_unshipped_orders",
            "orders",
            COUNT,
            bank.unshipped_order_count,
            "SELECT COUNT(DISTINCT order_id) AS orders FROM fact_orders o"
            " WHERE NOT EXISTS (SELECT 1 FROM fact_shipments s WHERE s.order_id = o.order_id)",
        ),
        Answer(
            "q11_refunded_and_shipped",
            "orders",
            COUNT,
            refunded_and_shipped_count,
            "SELECT COUNT(DISTINCT order_id) AS orders FROM fact_transactions"
            " WHERE status = 'REFUNDED' AND order_id IN (SELECT order_id FROM fact_shipments)",
        ),
        Answer("q12_fiscal_quarter", "revenue", AMOUNT, bank.fiscal_quarter_revenue, fiscal),
        Answer("t12_calendar_quarter", "revenue", AMOUNT, calendar_quarter_revenue, calendar),
        Answer(
            "q13_active_customers",
            "customers",
            COUNT,
            bank.active_customers,
            "SELECT COUNT(DISTINCT customer_id) AS customers FROM fact_orders WHERE order_date >="
            f" (SELECT CAST(MAX(order_date) - INTERVAL {p.active_days} DAY AS DATE) FROM fact_orders)",
        ),
        Answer(
            "t13_customers_ever",
            "customers",
            COUNT,
            customers_ever,
            "SELECT COUNT(DISTINCT customer_id) AS customers FROM fact_orders",
        ),
        Answer(
            "q14_without_internal",
            "revenue",
            AMOUNT,
            bank.revenue_without_internal,
            f"{_REVENUE} AND customer_id IN (SELECT customer_id FROM dim_customers WHERE NOT is_internal)",
        ),
        Answer("t14_with_internal", "revenue", AMOUNT, completed_revenue, _REVENUE),
    ]
    return {answer.id: answer for answer in listed}


@dataclass(frozen=True)
class Question:
    """One row of an answer table. Without ``right`` the question has no single number, as ``note`` says."""

    step: int
    group: str
    text: str
    right: str | None = None
    wrong: str | None = None
    mistake: str = ""
    why: str = ""
    note: str = ""


_OPEN = "(no single number; see the query of that name)"
_UNKNOWN = "(cannot be answered from this data)"

QUESTIONS = [
    # Group A of a step can be answered with what the step adds; group B needs what the next step adds.
    Question(2, "A", "Net revenue per subcategory in the first half of the year", note=_OPEN),
    Question(2, "A", "Carrier with the longest average delivery to Canada", note=_OPEN),
    Question(2, "A", "Five customers with the highest order value, and their segments", note=_OPEN),
    Question(
        2,
        "B",
        "Revenue from PayPal payments",
        "q01_paypal_revenue",
        mistake="a guessed code, or zero",
        why="Payment methods are stored as codes and no table says which code is PayPal.",
    ),
    Question(
        2,
        "B",
        "Spending by gift card",
        "q02_gift_card_revenue",
        mistake="a guessed code, or zero",
        why="The words 'gift card' appear nowhere in the data.",
    ),
    Question(
        2,
        "B",
        "Spending of enterprise (B2B) customers",
        "q03_enterprise_spend",
        mistake="no filter at all",
        why="The segment is stored as Corporate; 'enterprise' is a word of the business, not of the data.",
    ),
    Question(3, "A", "Completed revenue from PayPal payments", "q01_paypal_revenue"),
    Question(3, "A", "Completed spending by gift card", "q02_gift_card_revenue"),
    Question(3, "A", "Spending of enterprise (B2B) customers", "q03_enterprise_spend"),
    Question(3, "A", "Completed revenue in Canadian dollars", "q04_cad_revenue"),
    Question(
        3,
        "B",
        "Total revenue",
        "q05_completed_revenue",
        "t05_all_orders",
        "every order added up, also unpaid and refunded ones",
        "Only a definition can say that revenue is money collected.",
    ),
    Question(
        3,
        "B",
        "Average order value",
        "q06_order_value",
        "t06_line_average",
        "lines averaged instead of orders",
        "The table has one row per order line, so a plain average has the wrong grain.",
    ),
    Question(
        3,
        "B",
        "Gross margin in percent",
        "q07_margin_pct",
        "t07_mean_line_margin",
        "margins of lines averaged",
        "A ratio of sums and a mean of ratios differ; one formula has to be agreed on.",
    ),
    Question(4, "A", "Total completed revenue", "q05_completed_revenue"),
    Question(4, "A", "Overall gross margin in percent", "q07_margin_pct"),
    Question(4, "A", "On-time delivery rate", "q08_on_time_rate"),
    Question(4, "A", "Average order value", "q06_order_value"),
    Question(
        4,
        "B",
        "Revenue with refunds taken off",
        "q09_net_of_refunds",
        "t09_refunds_ignored",
        "refunds left out instead of subtracted",
        "Nothing in the data says that refunds count negative.",
    ),
    Question(
        4,
        "B",
        "Orders that never shipped",
        "q10_unshipped_orders",
        mistake="an inner join, which loses exactly these orders",
        why="The missing rows only show in a join that keeps what has no partner.",
    ),
    Question(
        4,
        "B",
        "Delivered orders that were refunded",
        "q11_refunded_and_shipped",
        mistake="no notion of 'delivered'",
        why="Delivered means that a shipment row exists; no column says so.",
    ),
    Question(5, "A", "Revenue with refunds taken off", "q09_net_of_refunds"),
    Question(5, "A", "Orders that never shipped", "q10_unshipped_orders"),
    Question(5, "A", "Delivered orders that were refunded", "q11_refunded_and_shipped"),
    Question(
        5,
        "B",
        "Revenue in the last fiscal quarter",
        "q12_fiscal_quarter",
        "t12_calendar_quarter",
        "the calendar quarter",
        "The fiscal year starts in February, which the data does not tell.",
    ),
    Question(
        5,
        "B",
        "Active customers",
        "q13_active_customers",
        "t13_customers_ever",
        "everybody who ever ordered",
        "How recent an order must be is a rule of the business.",
    ),
    Question(
        5,
        "B",
        "Total revenue without internal accounts",
        "q14_without_internal",
        "t14_with_internal",
        "internal accounts left in",
        "That the flag marks test accounts has to be told.",
    ),
    Question(6, "A", "Revenue in the last fiscal quarter", "q12_fiscal_quarter"),
    Question(6, "A", "Active customers", "q13_active_customers"),
    Question(6, "A", "Total revenue without internal accounts", "q14_without_internal"),
    Question(
        6,
        "B",
        "Marketing campaign with the most revenue",
        mistake="order_channel grouped and called a campaign",
        why="No table has a campaign column; order_channel says where an order was placed.",
        note=_UNKNOWN,
    ),
    Question(
        6,
        "B",
        "Revenue forecast for the next quarter",
        mistake="a number for days after the last order_date",
        why="fact_orders ends at its last order_date; no table has rows for later days.",
        note=_UNKNOWN,
    ),
    Question(
        6,
        "B",
        "Reason for a falling margin in a region",
        mistake="the column that moved along with it, named as its cause",
        why="net_amount and cogs_amount give the margin; no column records reasons.",
        note=_UNKNOWN,
    ),
]


def _shown(answer: Answer, value: Column) -> Column:
    if answer.kind == COUNT:
        text = displayed(value, 0)
    else:
        text = displayed(F.round(value, 2 if answer.kind == AMOUNT else 1), 2)
    return F.coalesce(text, F.lit("(no rows)"))


def _line_numbers(gold: Gold, p: Parameters) -> DataFrame:
    net, cogs = as_double(F.col("net_amount")), as_double(F.col("cogs_amount"))
    margin = F.sum(F.col("net_amount") - F.col("cogs_amount"))
    return gold.fact_orders.agg(
        as_double(F.sum("net_amount")).alias("t05_all_orders"),
        ratio(F.sum("net_amount"), F.count("net_amount")).alias("t06_line_average"),
        (ratio(margin, F.sum("net_amount")) * 100).alias("q07_margin_pct"),
        F.round(F.avg(F.try_divide(net - cogs, net)) * 100, 4).alias("t07_mean_line_margin"),
    )


def _payment_numbers(gold: Gold, p: Parameters) -> DataFrame:
    def completed(chosen: Column) -> Column:
        return as_double(F.sum(F.when(chosen & is_completed(), F.col("amount"))))

    return gold.fact_transactions.agg(
        completed(means("payment_method", "PayPal")).alias("q01_paypal_revenue"),
        completed(means("payment_method", "gift card")).alias("q02_gift_card_revenue"),
        completed(means("currency", "Canadian dollars")).alias("q04_cad_revenue"),
        as_double(net_of_refunds()).alias("q09_net_of_refunds"),
        completed(F.lit(True)).alias("t09_refunds_ignored"),
    )


def _shipment_numbers(gold: Gold, p: Parameters) -> DataFrame:
    return gold.fact_shipments.agg((flag_rate("on_time_flag") * 100).alias("q08_on_time_rate"))


def _known_orders(gold: Gold) -> DataFrame:
    """The same of every order with lines, from the order totals; payments and shipments of other orders do not exist."""
    return gold.order_totals.select(
        "customer_id",
        "order_date",
        "net_amount",
        "lines",
        F.coalesce(is_completed(), F.lit(False)).alias("completed"),
        F.coalesce(is_refunded(), F.lit(False)).alias("refunded"),
        "shipped",
    )


def _order_numbers(gold: Gold, p: Parameters) -> DataFrame:
    """What has to be known of an order as a whole: its amount, customer, day, payment and shipment.

    The order totals hold all that. Without them the three facts are laid together and added up per order, so each is read once and
    none is joined. A second aggregation per customer then meets the customers.
    """
    nothing = {name: F.lit(None) for name in ("customer_id", "order_date", "net_amount", "status", "shipped")}

    def rows(df: DataFrame, **columns: Column) -> DataFrame:
        return df.select("order_id", *[column.alias(name) for name, column in {**nothing, **columns}.items()])

    own = {name: F.col(name) for name in ("customer_id", "order_date", "net_amount")}
    laid = rows(gold.fact_orders, **own)
    laid = laid.unionByName(rows(gold.fact_transactions, status=F.col("status")))
    laid = laid.unionByName(rows(gold.fact_shipments, shipped=F.lit(True)))
    per_order = laid.groupBy("order_id").agg(
        F.min("customer_id").alias("customer_id"),
        F.max("order_date").alias("order_date"),
        F.sum("net_amount").alias("net_amount"),
        F.count("order_date").alias("lines"),
        F.coalesce(F.max(is_completed()), F.lit(False)).alias("completed"),
        F.coalesce(F.max(is_refunded()), F.lit(False)).alias("refunded"),
        F.coalesce(F.max("shipped"), F.lit(False)).alias("shipped"),
    )
    orders = per_order if gold.order_totals is None else _known_orders(gold)
    collected = F.when(F.col("completed"), F.col("net_amount"))
    fiscal = F.col("order_date").between(*fiscal_quarter_days(p.fiscal_as_of))
    calendar = F.col("order_date").between(*last_calendar_quarter_days(p.fiscal_as_of))
    customers = orders.groupBy("customer_id").agg(
        F.sum("net_amount").alias("net_amount"),
        F.sum(collected).alias("collected"),
        F.sum(F.when(fiscal, collected)).alias("fiscal"),
        F.sum(F.when(calendar, collected)).alias("calendar"),
        F.max("order_date").alias("latest"),
        F.count(F.when(F.col("lines") > 0, 1)).alias("orders"),
        F.count(F.when((F.col("lines") > 0) & ~F.col("shipped"), 1)).alias("unshipped"),
        F.count(F.when(F.col("refunded") & F.col("shipped"), 1)).alias("refunded_and_shipped"),
    )
    since = gold.latest_orders().agg(F.date_sub(F.max("order_date"), p.active_days)).scalar()
    of_customer = customers.join(gold.dim_customers.select("customer_id", "segment", "is_internal"), "customer_id", "left")
    enterprise = means("segment", "enterprise")
    return of_customer.agg(
        as_double(F.sum(F.when(enterprise, F.col("net_amount")))).alias("q03_enterprise_spend"),
        as_double(F.sum("collected")).alias("q05_completed_revenue"),
        ratio(F.sum("net_amount"), F.sum("orders")).alias("q06_order_value"),
        F.coalesce(F.sum("unshipped"), F.lit(0)).alias("q10_unshipped_orders"),
        F.coalesce(F.sum("refunded_and_shipped"), F.lit(0)).alias("q11_refunded_and_shipped"),
        as_double(F.sum("fiscal")).alias("q12_fiscal_quarter"),
        as_double(F.sum("calendar")).alias("t12_calendar_quarter"),
        F.count(F.when(F.col("latest") >= since, F.col("customer_id"))).alias("q13_active_customers"),
        F.count(F.when(F.col("orders") > 0, F.col("customer_id"))).alias("t13_customers_ever"),
        as_double(F.sum(F.when(~F.col("is_internal"), F.col("collected")))).alias("q14_without_internal"),
        as_double(F.sum("collected")).alias("t14_with_internal"),
    )


def _numbers(gold: Gold, p: Parameters, ids: set[str]) -> DataFrame:
    """One map from answers to their numbers as shown, with one aggregation for all answers that read the same rows."""
    known, found = answers(p), []
    for numbers in (_line_numbers, _payment_numbers, _shipment_numbers, _order_numbers):
        frame = numbers(gold, p)
        shown = [
            F.struct(F.lit(id).alias("id"), _shown(known[id], F.col(id)).alias("shown")) for id in frame.columns if id in ids
        ]
        if shown:
            found.append(frame.select(F.inline(F.array(*shown))))
    pairs = reduce(DataFrame.unionByName, found)
    return pairs.agg(F.map_from_entries(F.collect_list(F.struct("id", "shown"))).alias("numbers"))


def answer_table(spark: SparkSession, gold: Gold, p: Parameters, step: int) -> DataFrame:
    """Questions of a step with the right number, its SQL and the usual wrong number, one row per question.

    The numbers are one scalar subquery of the plan; an error in any of them fails the whole table.
    """
    known, asked = answers(p), [q for q in QUESTIONS if q.step == step]
    ids = {id for q in asked for id in (q.right, q.wrong) if id}
    numbers = _numbers(gold, p, ids).scalar() if ids else None

    def row(question: Question) -> DataFrame:
        right = F.element_at(numbers, question.right) if question.right else F.lit(question.note)
        wrong = F.lit(question.mistake)
        if question.wrong:
            wrong = F.concat(F.element_at(numbers, question.wrong), F.lit(f"  ({question.mistake})"))
        return spark.range(0, 1, 1, 1).select(
            F.lit(question.group).alias("set"),
            F.lit(question.text).alias("question"),
            right.alias("correct_answer"),
            F.lit(known[question.right].sql if question.right else "").alias("correct_sql"),
            wrong.alias("naive_or_trap_answer"),
            F.lit(question.why).alias("why_agent_fails"),
        )

    return reduce(DataFrame.unionByName, [row(q) for q in asked])


# ---- questions whose answer is a table -----------------------------------------------------------------------------


def half_year_by_subcategory(gold: Gold, p: Parameters) -> DataFrame:
    """Net amount per subcategory in the first half of the year, whatever became of the payment."""
    return (
        gold.fact_orders.where(ordered_between(*p.half_year))
        .groupBy("product_id")
        .agg(F.sum("net_amount").alias("net_amount"))
        .join(gold.dim_products, "product_id")
        .groupBy("subcategory")
        .agg(as_double(F.sum("net_amount")).alias("net_revenue"))
    )


def slowest_carrier_to_canada(gold: Gold, p: Parameters) -> DataFrame:
    there = gold.dim_geography.where(F.col("country_code") == "CA")
    return (
        with_partner(gold.fact_shipments, there, "geo_id")
        .groupBy("carrier")
        .agg(F.avg("delivery_days").alias("average_days"))
        .orderBy(F.desc("average_days"), "carrier")
        .limit(1)
    )


def best_customers(gold: Gold, p: Parameters) -> DataFrame:
    per_customer = gold.fact_orders.groupBy("customer_id").agg(F.sum("net_amount").alias("net_amount"))
    return (
        per_customer.join(gold.dim_customers, "customer_id")
        .orderBy(F.desc("net_amount"), "customer_id")
        .limit(5)
        .select("customer_id", "customer_name", "segment", as_double(F.col("net_amount")).alias("order_value"))
    )
