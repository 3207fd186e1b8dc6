"""The layers as catalog tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martlens.operators.joins import bucket_imbalance
from martlens.plans.gold import (
    COLUMN_COMMENTS,
    TABLE_COMMENTS,
    Gold,
    build_gold,
    build_silver,
    derive_gold,
    gold_from_catalog,
    land_bronze,
)
from martlens.plans.revenue import collected_lines
from martlens.sources.catalog import Layout, column_comments, describe, list_tables, overwrite_table, preview
from martlens.sources.raw import read_raw
from tests.conftest import SMALL

LAYOUT = Layout("shop")


@pytest.fixture(scope="module")
def built(spark):
    raw = read_raw(spark, SMALL)
    bronze = land_bronze(spark, raw, LAYOUT)
    silver = build_silver(spark, LAYOUT)
    gold = build_gold(spark, LAYOUT)
    return bronze, silver, gold


def test_row_counts_of_the_layers(built):
    bronze, silver, gold = built
    assert bronze["shop.bronze_orders"] == 6000
    assert silver["shop.silver_orders"] == gold["shop.fact_orders"] == 4599
    assert gold["shop.dim_customers"] == 150 and gold["shop.fact_transactions"] == 1473
    assert gold["shop.fact_shipments"] == 1176 and gold["shop.dim_geography"] == 25


def test_comments_are_stored(spark, built):
    for name in Gold.names():
        assert column_comments(spark.table(LAYOUT.gold(name))) == COLUMN_COMMENTS[name]
        rows = {r.col_name: r.data_type for r in describe(spark, LAYOUT.gold(name)).collect()}
        assert rows["Comment"] == TABLE_COMMENTS[name]
    assert sum(len(c) for c in COLUMN_COMMENTS.values()) == 48


def test_tables_are_listed_and_previewed(spark, built):
    names = {r.tableName for r in list_tables(spark, LAYOUT).collect()}
    assert {"bronze_orders", "silver_orders", "fact_orders"} <= names and len(names) == 18
    assert preview(spark.table(LAYOUT.gold("fact_orders"))).count() == 10


def test_catalog_and_folder_builds_agree(spark, built, gold):
    from_tables = gold_from_catalog(spark, LAYOUT)
    for name in Gold.names():
        mine, theirs = gold.table(name), from_tables.table(name)
        assert mine.dtypes == theirs.dtypes
        assert mine.exceptAll(theirs).isEmpty() and theirs.exceptAll(mine).isEmpty()


def test_lazy_chain_agrees_with_the_written_tables(spark, gold):
    lazy = derive_gold(read_raw(spark, SMALL))
    for name in Gold.names():
        assert gold.table(name).exceptAll(lazy.table(name)).isEmpty()
        assert lazy.table(name).exceptAll(gold.table(name)).isEmpty()


def test_overwrite_replaces_rows_and_schema(spark, built):
    table = LAYOUT.gold("scratch")
    assert overwrite_table(spark.range(5), table) == 5
    assert overwrite_table(spark.range(3).selectExpr("id AS other", "'it''s' AS text"), table, "It's a test") == 3
    assert spark.table(table).columns == ["other", "text"] and spark.table(table).count() == 3
    spark.sql(f"DROP TABLE {table}")


def test_layout_names():
    assert Layout("s", "c").bronze("orders") == "c.s.bronze_orders"
    assert Layout("s").silver("orders") == "s.silver_orders" and Layout("s").gold("dim_x") == "s.dim_x"
    for bad in ("a-b", "1a", "", "a b"):
        with pytest.raises(ValueError):
            Layout(bad)


def test_questions_run_as_sql_over_views(spark, gold):
    from martlens.plans.parameters import TABLE_PARAMETERS
    from martlens.plans.truths import answers

    gold.create_views()
    for answer in answers(TABLE_PARAMETERS).values():
        (by_sql,) = spark.sql(answer.sql).collect()
        (by_frames,) = answer.query(gold, TABLE_PARAMETERS).collect()
        assert float(by_sql[0]) == pytest.approx(float(by_frames[0]), rel=1e-12), answer.id


def test_bucketed_facts_join_without_a_shuffle(spark, built, gold, settings):
    layout = Layout("bucketed")
    layout.ensure_schema(spark)
    for name in ("customers", "products", "geography", "orders", "transactions", "shipments"):
        overwrite_table(spark.table(LAYOUT.silver(name)), layout.silver(name))
    assert build_gold(spark, layout, order_buckets=8)["bucketed.fact_orders"] == 4599
    bucketed = gold_from_catalog(spark, layout)
    settings(autoBroadcastJoinThreshold="-1")
    query = collected_lines(bucketed).agg(F.sum("net_amount"), F.count_distinct("order_id"))
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
    assert query.collect() == collected_lines(gold).agg(F.sum("net_amount"), F.count_distinct("order_id")).collect()
    assert column_comments(bucketed.fact_orders) == COLUMN_COMMENTS["fact_orders"]


def test_a_hot_order_is_not_bucketed_in_silence(spark, built):
    layout = Layout("hot")
    layout.ensure_schema(spark)
    for name in ("customers", "products", "geography", "transactions", "shipments"):
        overwrite_table(spark.table(LAYOUT.silver(name)), layout.silver(name))
    lines = spark.table(LAYOUT.silver("orders"))
    hot = lines.limit(1).join(spark.range(3000)).withColumn("order_line_id", F.col("id") + 10**9).drop("id")
    overwrite_table(lines.unionByName(hot), layout.silver("orders"))
    assert bucket_imbalance(spark.table(layout.silver("orders")), "order_id", 8) > 3
    with pytest.raises(ValueError, match="even shares"):
        build_gold(spark, layout, order_buckets=8)
    assert build_gold(spark, layout)["hot.fact_orders"] == 7599
    assert bucket_imbalance(lines.limit(0), "order_id", 8) == 0.0
