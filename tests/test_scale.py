"""Plans and results when one order, one customer or one group of copies holds a large share of all rows."""

from __future__ import annotations

import re
from dataclasses import replace

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from martlens.plans.parameters import TABLE_PARAMETERS
from martlens.plans.queries import all_queries
from martlens.plans import bank, examples, silver, truths
from martlens.plans.store import open_gold
from martlens.plans.views import order_analytics
from martlens.sources import landing
from martlens.sources.raw import read_raw
from tests.compare import TABLES, differences, oracle_connection
from tests.conftest import SMALL


def initial_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted_plan(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def final_plan(df) -> str:
    df.collect()
    return initial_plan(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    """The smallest tables, plus one line copied 100,000 times and one customer with a third of all orders."""
    target = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE TABLE {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    connection.execute(
        """INSERT INTO orders
           SELECT 100000 + i, 7, 'O', 100.0, TIMESTAMP '2001-06-01' + to_days(CAST(i % 60 AS INTEGER)), '1-URGENT'
           FROM range(700) AS r(i)"""
    )
    connection.execute(
        """INSERT INTO lineitem
           SELECT 3, hash(i) % 200, hash(i + 1) % 10, 1, 1 + hash(i + 2) % 50, 900 + (hash(i + 3) % 1000000) / 100.0, 0.05,
                  (hash(i + 4) % 9) / 100.0, 'N', 'O', TIMESTAMP '1999-01-01' + to_days(CAST(hash(i) % 900 AS INTEGER))
           FROM range(100000) AS r(i)
           UNION ALL
           SELECT 100000 + i // 3, hash(i) % 200, hash(i) % 10, 1 + i % 3, 5, 1000 + (hash(i) % 5000) / 100.0, 0.1, 0.02,
                  'N', 'O', TIMESTAMP '2001-07-01'
           FROM range(2100) AS r(i)"""
    )
    for table in TABLES:
        connection.execute(f"COPY {table} TO '{target}/{table}.parquet' (FORMAT parquet, ROW_GROUP_SIZE 20000)")
    return str(target)


# Small thresholds, so that small tables take the paths of very large ones.
LARGE_SCALE = {
    "autoBroadcastJoinThreshold": "-1",
    "files__maxPartitionBytes": "200KB",
    "files__openCostInBytes": "0",
    "adaptive__advisoryPartitionSizeInBytes": "64KB",
    "adaptive__skewJoin__skewedPartitionThresholdInBytes": "128KB",
    "adaptive__skewJoin__skewedPartitionFactor": "2",
}

CHECKED = [
    "p6_silver_orders",
    "p7_gold_fact_transactions",
    "b12_revenue_california",
    "b18_order_value_by_segment",
    "b24_customers_with_unshipped",
    "b29_top_customers",
    "b34_revenue_without_internal",
    "b35_active_customers",
    "b39_revenue_by_country",
    "mv1_by_subcategory",
    "mv1_by_region_segment",
    "x6_margin_without_internal",
    "x8_repeat_customers",
    "v8_payments_by_term",
    "e2_answers_step5",
]


def test_skewed_tables_give_whole_results(spark, settings, skewed_dir):
    settings(**LARGE_SCALE)
    connection = oracle_connection(skewed_dir)
    queries, statements = registered.queries(), registered.oracle_sql()
    found = {name: differences(queries[name](spark, skewed_dir), connection, statements[name]) for name in CHECKED}
    assert {name: d for name, d in found.items() if d} == {}


def test_copies_of_one_line_are_split_and_reduced_before_the_shuffle(spark, settings, skewed_dir):
    open_gold(spark, SMALL)  # applies the session settings
    settings(**LARGE_SCALE)
    lines = silver.silver_orders(landing.bronze_orders(read_raw(spark, skewed_dir)))
    plan = final_plan(lines)
    assert "SortMergeJoin(skew=true)" in plan
    # The exchange that the split makes necessary lies between the two halves of the aggregation.
    assert re.search(r"SortAggregate(?:(?!SortAggregate).)*Exchange hash(?:(?!Exchange).)*partial_min", plan, re.S)


def test_line_table_is_shuffled_once_without_skew(spark, settings, gold):
    settings(autoBroadcastJoinThreshold="-1")
    plan = initial_plan(silver.silver_orders(landing.bronze_orders(read_raw(spark, SMALL))))
    above_join, below_join = plan.split("SortMergeJoin", 1)
    assert "Exchange" not in above_join
    lines = below_join[: below_join.index("lineitem.parquet")]
    assert lines.count("Exchange") == 1 and "hashpartitioning(l_orderkey" in lines


def test_payments_are_added_up_before_they_meet_the_terms(spark, settings):
    """At default settings, in the plan that ran."""
    settings(maxMetadataStringLength="1000")
    plan = final_plan(all_queries()["v8_payments_by_term"](spark, SMALL))
    below = plan[: plan.index("fact_transactions")]
    assert re.search(r"HashAggregate[^\n]*partial_", below[below.rindex("Exchange") :])


@pytest.mark.parametrize("dims", [["Customer Segment"], ["Product"], ["Region", "Customer Segment"], ["Order Channel", "Product"]])
def test_views_with_distinct_counts_do_not_shuffle_raw_lines(gold, settings, dims):
    settings(autoBroadcastJoinThreshold="-1", maxMetadataStringLength="1000")
    view = order_analytics(gold)
    query = view.query(dims, ["Order Count", "Total Revenue", "Average Order Value"])
    for exchange in re.finditer(r"Exchange hashpartitioning\((customer_id|product_id|geo_id)[^\n]*\n([^\n]*\n){0,4}", initial_plan(query)):
        if "fact_orders" in exchange.group(0):
            assert "partial_" in exchange.group(0)


def test_revenue_by_country_and_margin_meet_customers_after_totals(gold, settings):
    settings(autoBroadcastJoinThreshold="-1", maxMetadataStringLength="1000")
    of_lines = replace(gold, order_totals=None, paid_lines=None)
    for query in (bank.revenue_by_country, examples.margin_without_internal):
        plan = initial_plan(query(of_lines, TABLE_PARAMETERS))
        lines = plan[: plan.index("fact_orders")]
        for exchange in re.findall(r"Exchange hashpartitioning\(customer_id#\d+L?, \d+\)[^\n]*\n[^\n]*", lines):
            assert "Aggregate" in exchange


@pytest.mark.parametrize("step", [2, 3, 4, 5, 6])
def test_answer_tables_read_each_fact_twice_at_most(spark, settings, step):
    settings(maxMetadataStringLength="1000")
    plan = initial_plan(all_queries()[f"e2_answers_step{step}"](spark, SMALL))
    # A subquery that is used again is printed again, as a reused one or with the number of the first.
    scans = set(re.findall(r"FileScan[^\n]*?\[([^\]]*)\][^\n]*/(fact_\w+)\]", plan))
    for table in ("fact_orders", "fact_transactions", "fact_shipments"):
        assert len([1 for _, name in scans if name == table]) <= 2, scans


def test_each_table_is_read_once_for_all_edges(spark, settings):
    settings(maxMetadataStringLength="1000")
    for name in ("j7_edge_matches", "mvk_edge_repeats"):
        plan = initial_plan(all_queries()[name](spark, SMALL))
        assert "Join" not in plan
        for table in ("fact_orders", "fact_transactions", "fact_shipments", "dim_geography"):
            assert len(re.findall(rf"FileScan[^\n]*/{table}\]", plan)) == 1


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_pairing_and_no_python_rows(spark, name):
    plan = initial_plan(all_queries()[name](spark, SMALL))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "Scan ExistingRDD"):
        assert operator not in plan, operator


def test_filters_and_columns_reach_the_scan(gold):
    plan = formatted_plan(bank.paypal_revenue(gold, TABLE_PARAMETERS))
    assert "EqualTo(payment_method,PM02)" in plan and "EqualTo(status,COMPLETED)" in plan
    assert "ReadSchema: struct<payment_method:string,amount:decimal(28,4),status:string>" in plan
    plan = formatted_plan(bank.fiscal_quarter_revenue(gold, TABLE_PARAMETERS))
    assert "GreaterThanOrEqual(order_date,2001-05-01)" in plan and "LessThanOrEqual(order_date,2001-07-31)" in plan


def test_top_k_needs_no_full_sort(gold):
    for query in (bank.top_customers, bank.dearest_product, examples.top_products):
        plan = initial_plan(query(gold, TABLE_PARAMETERS))
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_unshipped_orders_use_an_anti_join(gold):
    of_lines = replace(gold, order_totals=None, paid_lines=None)
    assert "LeftAnti" in initial_plan(bank.unshipped_order_count(of_lines, TABLE_PARAMETERS))


def test_written_rows_follow_the_date(gold):
    for name, day in (("fact_orders", "order_date"), ("fact_transactions", "txn_date"), ("fact_shipments", "ship_date")):
        rows = gold.table(name).select(
            F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"), F.col(day).alias("day")
        )
        for file in {r.file for r in rows.select("file").distinct().collect()}:
            days = [r.day for r in rows.where(F.col("file") == file).orderBy("at").collect()]
            assert days == sorted(days)


def test_date_bounds_leave_other_months_unread(gold, settings):
    settings(maxMetadataStringLength="1000")
    months = gold.fact_orders.select("order_month").distinct().count()
    assert months > 60 and len(gold.fact_orders.inputFiles()) == months
    of_lines = replace(gold, order_totals=None, paid_lines=None)
    for query, most in [
        (bank.fiscal_quarter_revenue, 3),
        (truths.calendar_quarter_revenue, 3),
        (bank.active_customers, 5),
        (bank.latest_month_summary, 1),
        (truths.half_year_by_subcategory, 6),
    ]:
        for known in (gold, of_lines):
            frame = query(known, TABLE_PARAMETERS)
            table = "order_totals" if known is gold and query is not truths.half_year_by_subcategory else "fact_orders"
            assert re.search(r"PartitionFilters: \[[^\]]*order_month", initial_plan(frame)), query
            assert files_read(frame, table) <= most, query


@pytest.mark.parametrize("query", [bank.active_customers, bank.latest_month_summary])
def test_the_latest_day_is_looked_up_in_the_last_month(gold, settings, query):
    settings(maxMetadataStringLength="1000")
    last = gold.fact_orders.agg(F.max("order_month")).first()[0]
    assert gold.latest_month == last
    for known in (gold, replace(gold, order_totals=None, paid_lines=None)):
        files = known.latest_orders().select(F.input_file_name().alias("file")).distinct().collect()
        assert len(files) == 1 and f"order_month={last}" in files[0].file
        assert f"= {last}" in initial_plan(query(known, TABLE_PARAMETERS))
        unknown = replace(known, latest_month=None)
        assert query(known, TABLE_PARAMETERS).collect() == query(unknown, TABLE_PARAMETERS).collect()


def files_read(df, table: str) -> int:
    """Files the scans of a table opened in the main plan; scans of subqueries are not counted."""
    df.collect()
    found = []

    def visit(node) -> None:
        name = node.nodeName()
        if name.startswith("Scan parquet") and f"/{table}" in node.toString():
            found.append(node.metrics().apply("numFiles").value())
        if name == "AdaptiveSparkPlan":
            visit(node.executedPlan())
        elif name.endswith("QueryStage"):
            visit(node.plan())
        for i in range(node.children().size()):
            visit(node.children().apply(i))

    visit(df._jdf.queryExecution().executedPlan())
    return max(found)
