from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from martlens.functions import amounts, calendar, fields
from martlens.functions.vocabulary import codes_meant, means


@pytest.mark.parametrize(
    ("day", "start", "quarter", "year"),
    [
        (date(2026, 1, 31), date(2025, 11, 1), 4, 2025),
        (date(2026, 2, 1), date(2026, 2, 1), 1, 2026),
        (date(2026, 4, 30), date(2026, 2, 1), 1, 2026),
        (date(2026, 5, 1), date(2026, 5, 1), 2, 2026),
        (date(2026, 6, 30), date(2026, 5, 1), 2, 2026),
        (date(2026, 7, 31), date(2026, 5, 1), 2, 2026),
        (date(2026, 8, 1), date(2026, 8, 1), 3, 2026),
        (date(2026, 10, 31), date(2026, 8, 1), 3, 2026),
        (date(2026, 12, 31), date(2026, 11, 1), 4, 2026),
        (date(2024, 2, 29), date(2024, 2, 1), 1, 2024),
    ],
)
def test_fiscal_calendar(spark, day, start, quarter, year):
    row = spark.createDataFrame([(day,)], "d date").select(
        calendar.fiscal_quarter_start("d"), calendar.fiscal_quarter("d"), calendar.fiscal_year("d")
    )
    assert tuple(row.first()) == (start, quarter, year)


def test_every_day_lies_in_its_own_fiscal_quarter(spark):
    days = spark.range(2000).select(F.date_add(F.lit(date(2000, 1, 1)), F.col("id").cast("int")).alias("d"))
    late = days.where(
        (F.col("d") < calendar.fiscal_quarter_start("d"))
        | (F.col("d") >= F.add_months(calendar.fiscal_quarter_start("d"), 3))
    )
    assert late.isEmpty()


def test_quarters_as_of_a_day():
    assert calendar.fiscal_quarter_days(date(2001, 7, 31)) == (date(2001, 5, 1), date(2001, 7, 31))
    assert calendar.fiscal_quarter_days(date(2001, 1, 5)) == (date(2000, 11, 1), date(2001, 1, 31))
    assert calendar.last_calendar_quarter_days(date(2001, 7, 31)) == (date(2001, 4, 1), date(2001, 6, 30))
    assert calendar.last_calendar_quarter_days(date(2001, 3, 31)) == (date(2001, 1, 1), date(2001, 3, 31))
    assert calendar.last_calendar_quarter_days(date(2001, 2, 1)) == (date(2000, 10, 1), date(2000, 12, 31))


def test_quarter_days_agree_with_the_fiscal_calendar(spark):
    days = [date(1999, 1, 1) + timedelta(days=9 * i) for i in range(150)]
    frame = spark.createDataFrame([(d,) for d in days], "d date")
    for row in frame.select("d", calendar.fiscal_quarter_start("d").alias("start")).collect():
        first, last = calendar.fiscal_quarter_days(row.d)
        assert first == row.start and first <= row.d <= last


def test_bounds_on_days_hold_for_months_and_days(spark):
    days = spark.range(400).select(F.date_add(F.lit(date(2001, 1, 1)), F.col("id").cast("int")).alias("order_date"))
    lines = days.withColumn("order_month", calendar.month_of("order_date"))
    bounds = F.min("order_date"), F.max("order_date")
    some = lines.where(calendar.ordered_between(date(2001, 2, 10), date(2001, 4, 9))).agg(*bounds)
    assert tuple(some.first()) == (date(2001, 2, 10), date(2001, 4, 9))
    assert lines.where(calendar.ordered_since(date(2001, 12, 30))).agg(*bounds).first()[0] == date(2001, 12, 30)


def test_age_group_edges_and_unknown(spark):
    as_of = date(2026, 6, 30)
    days = [25 * 365 - 1, 25 * 365, 40 * 365 - 1, 40 * 365, 60 * 365 - 1, 60 * 365, None]
    df = spark.createDataFrame([(d,) for d in days], "days int").withColumn("born", F.date_sub(F.lit(as_of), F.col("days")))
    got = [r[0] for r in df.select(fields.age_group("born", as_of)).collect()]
    assert got == ["Under 25", "25-39", "25-39", "40-59", "40-59", "60+", "60+"]


def test_order_size_edges_and_unknown(spark):
    df = spark.createDataFrame([(49.99,), (50.0,), (199.99,), (200.0,), (None,)], "net_amount double")
    got = [r[0] for r in df.select(fields.order_size("net_amount")).collect()]
    assert got == ["Small", "Medium", "Medium", "Large", "Large"]


def test_net_of_refunds_signs(spark):
    df = spark.createDataFrame(
        [("COMPLETED", 10), ("REFUNDED", 4), ("FAILED", 100), ("PENDING", 100)], "status string, amount long"
    )
    assert df.agg(amounts.net_of_refunds()).first()[0] == 6


def test_ratio_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 0)], "a long, b long")
    assert df.agg(amounts.ratio(F.sum("a"), F.sum("b"))).first()[0] is None
    assert df.where("a > 1").agg(amounts.ratio(F.sum("a"), F.sum("b"))).first()[0] is None


def test_displayed_numbers(spark):
    row = spark.range(1).select(amounts.displayed(F.lit(1234567.891), 2), amounts.displayed(F.lit(1234567), 0)).first()
    assert tuple(row) == ("1,234,567.89", "1,234,567")


def test_words_for_codes(spark):
    assert codes_meant("payment_method", " paypal ") == ["PM02"]
    assert codes_meant("segment", "B2B") == codes_meant("segment", "enterprise") == ["Corporate"]
    assert codes_meant("state_code", "CA") == codes_meant("state_code", "california") == ["CA"]
    with pytest.raises(LookupError):
        codes_meant("payment_method", "bitcoin")
    df = spark.createDataFrame([("PM01",), ("PM02",)], "payment_method string")
    assert [r[0] for r in df.where(means("payment_method", "PayPal")).collect()] == ["PM02"]
