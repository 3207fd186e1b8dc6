"""Known values of the bound tables."""

from __future__ import annotations

import pytest

from martlens.plans.queries import all_queries
from tests.conftest import MEDIUM, SMALL

# Query -> value on the smallest and on the medium tables.
EXPECTED = {
    "q01_paypal_revenue": (48257096.1366, 467668117.6397),
    "q02_gift_card_revenue": (45865461.515, 456172602.7077),
    "q03_enterprise_spend": (98878907.5539, 926224757.7485),
    "q04_cad_revenue": (62649324.0767, 604230180.5456),
    "q05_completed_revenue": (185813958.9341, 1846192585.4882),
    "t05_all_orders": (230052389.881, 2310633317.6518),
    "q06_order_value": (156179.4907542, 156727.4854271),
    "t06_line_average": (50022.2635097, 50415.2844661),
    "q07_margin_pct": (53.2562, 52.6716),
    "t07_mean_line_margin": (53.4114, 52.6362),
    "q08_on_time_rate": (55.78231, 55.54356),
    "q09_net_of_refunds": (163670750.7346, 1609689118.0925),
    "q10_unshipped_orders": (297, 1773),
    "q11_refunded_and_shipped": (116, 1305),
    "q12_fiscal_quarter": (7407530.4078, 68344479.6687),
    "t12_calendar_quarter": (5176974.5667, 61921121.2293),
    "q13_active_customers": (52, 471),
    "t13_customers_ever": (150, 1500),
    "q14_without_internal": (177664780.951, 1776134406.837),
    "b12_revenue_california": (23285394.9408, 222552480.0254),
    "b13_orders_to_ontario": (54, 1193),
    "b14_cad_transactions": (502, 4811),
    "b15_refunded_transactions": (146, 1483),
    "b22_gross_profit": (98887828.549, 972502838.3427),
    "b31_refund_rate": (0.0991174, 0.1005901),
    "b38_internal_accounts": (6, 60),
}


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_value(spark, name):
    query = all_queries()[name]
    for raw_dir, value in zip((SMALL, MEDIUM), EXPECTED[name]):
        (row,) = query(spark, raw_dir).collect()
        assert row[0] == pytest.approx(value, rel=1e-6)


def test_row_counts(spark):
    counts = {r.table_name: r.rows for r in all_queries()["p7_table_row_counts"](spark, MEDIUM).collect()}
    assert counts == {
        "dim_customers": 1500,
        "dim_products": 2000,
        "dim_geography": 25,
        "fact_orders": 45832,
        "fact_transactions": 14743,
        "fact_shipments": 12970,
    }
    assert all_queries()["b28_high_value_lines"](spark, MEDIUM).count() == 4555


def test_age_groups(spark):
    rows = all_queries()["xe1_customers_by_age_group"](spark, MEDIUM).collect()
    assert {r.age_group: r.customers for r in rows} == {"Under 25": 72, "25-39": 576, "40-59": 788, "60+": 64}
