"""Laws of the star schema, and right answers that differ from the usual mistakes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martlens.plans.bank import BANK
from martlens.plans.parameters import TABLE_PARAMETERS, Parameters
from martlens.plans.truths import QUESTIONS, answer_table, answers


def test_payment_is_the_sum_of_its_lines(gold):
    lines = gold.fact_orders.groupBy("order_id").agg(F.sum("net_amount").alias("total"))
    assert lines.join(gold.fact_transactions, "order_id").where("total <> amount").isEmpty()
    assert lines.count() == gold.fact_transactions.count()


def test_shipment_dates_and_flag(gold):
    ships = gold.fact_shipments
    assert ships.where("delivery_date <> date_add(ship_date, CAST(delivery_days AS INT))").isEmpty()
    assert ships.where("on_time_flag <> (delivery_days <= 6)").isEmpty()


def test_currency_follows_the_country(gold):
    placed = gold.fact_orders.select("order_id", "geo_id").distinct().join(gold.dim_geography, "geo_id")
    paid = placed.join(gold.fact_transactions, "order_id")
    assert paid.where("(currency = 'CAD') <> (country_code = 'CA')").isEmpty()


def test_shipped_and_unshipped_orders_are_all_orders(gold):
    shipped = gold.fact_shipments.select("order_id").distinct().count()
    unshipped = next(i for i in BANK if i.id == "b27_unshipped_orders").query(gold, TABLE_PARAMETERS).first()[0]
    assert shipped + unshipped == gold.fact_orders.select("order_id").distinct().count()


def test_bank_has_forty_questions_of_five_kinds():
    assert len(BANK) == len({i.id for i in BANK}) == 40
    kinds = {}
    for item in BANK:
        kinds[item.category] = kinds.get(item.category, 0) + 1
    assert kinds == {"aggregation": 8, "value-matching": 7, "measure": 8, "joins-exceptions": 9, "rules": 8}


@pytest.mark.parametrize("question", [q for q in QUESTIONS if q.wrong], ids=lambda q: q.right)
def test_truth_differs_from_the_usual_mistake(gold, question):
    known = answers(TABLE_PARAMETERS)
    right, wrong = (known[i].query(gold, TABLE_PARAMETERS).first()[0] for i in (question.right, question.wrong))
    assert right != wrong


def test_a_step_answers_what_the_step_before_could_not():
    for step in (2, 3, 4, 5):
        later = [q.right for q in QUESTIONS if q.step == step + 1 and q.group == "A"]
        assert all(q.right in later for q in QUESTIONS if q.step == step and q.group == "B")


def test_answer_table_rows(spark, gold):
    rows = answer_table(spark, gold, TABLE_PARAMETERS, 3).collect()
    assert len(rows) == 7 and rows[0]["set"] == "A"
    total = next(r for r in rows if r.question == "Total revenue")
    assert total.correct_answer == "185,813,958.93"
    assert total.naive_or_trap_answer.startswith("230,052,389.88  (")


def test_default_parameters_are_the_shop_of_2026():
    p = Parameters()
    assert (p.high_value, p.small_below, p.medium_below, p.active_days) == (500, 50, 200, 90)


def test_answers_on_a_shop_without_rows(spark, gold):
    from martlens.plans.gold import Gold

    empty = Gold(**{n: gold.table(n).limit(0) for n in Gold.names()})
    rows = answer_table(spark, empty, TABLE_PARAMETERS, 4).collect()
    assert {r.correct_answer for r in rows} <= {"(no rows)", "0"}
