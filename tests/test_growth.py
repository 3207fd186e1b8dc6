"""What keeps a task's share, and what is shuffled, in proportion to the input."""

from __future__ import annotations

from martlens.plans.gold import derive_roll_ups
from martlens.plans.store import open_gold
from martlens.plans.views import order_analytics
from martlens.session import RAW_PER_PARTITION, apply_scale_settings
from tests.conftest import SMALL

PARTITIONS = "adaptive__coalescePartitions__initialPartitionNum"


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitions_grow_with_the_raw_files_and_stay_as_many_as_the_caller_wants(spark, settings):
    settings(shuffle__partitions="8", adaptive__advisoryPartitionSizeInBytes="64MB", **{PARTITIONS: "8"})
    number, size = ("spark.sql." + name.replace("__", ".") for name in (PARTITIONS, "adaptive__advisoryPartitionSizeInBytes"))
    apply_scale_settings(spark, 3 * RAW_PER_PARTITION)
    assert int(spark.conf.get(number)) == 8
    apply_scale_settings(spark, 100 * RAW_PER_PARTITION + 1)
    assert int(spark.conf.get(number)) == 101
    apply_scale_settings(spark, RAW_PER_PARTITION)
    assert int(spark.conf.get(number)) == 101
    assert spark.conf.get(size) == str(16 << 20)
    settings(adaptive__advisoryPartitionSizeInBytes="64KB")
    apply_scale_settings(spark)
    assert spark.conf.get(size) == "64KB"


def test_a_distinct_count_that_measures_share_does_not_repeat_the_rows(spark):
    view = order_analytics(open_gold(spark, SMALL))
    both = view.query(["Product"], ["Order Count", "Average Order Value", "Total Revenue"])
    assert "Expand" not in executed(both)
    one = {row["Product"]: row["Order Count"] for row in view.query(["Product"], ["Order Count"]).collect()}
    assert {row["Product"]: row["Order Count"] for row in both.collect()} == one


def test_roll_ups_are_cleaned_where_the_order_put_them(spark):
    lines = open_gold(spark, SMALL).fact_orders
    for name, rows in derive_roll_ups(lines).items():
        assert executed(rows).count("Exchange hashpartitioning") == 1, name
