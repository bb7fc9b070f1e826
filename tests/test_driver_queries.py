"""Registered queries against DuckDB on the smallest tables.

``python -m driver_tables.check <folder>`` runs all of them; here the ones that
exercise each kind of operator.
"""

import pytest

import __spark_entry__ as driver
from driver_tables.check import compare, connect

CHECKED = [
    "stg_customer", "stg_premise", "stg_payment", "stg_outage", "dim_date", "dim_geography", "dim_customer", "fact_ar_monthly",
    "fact_ar_customer", "fact_ami_daily", "major_event_days", "dq_summary", "rpt_revenue_monthly", "rpt_ar_top_accounts",
    "rpt_digital_adoption_monthly", "rpt_contact_center_daily", "rpt_moratorium_compliance", "rpt_billing_exceptions_monthly",
    "rpt_customer_360", "rpt_customer_bills_recent", "typed_zsrvord", "asof_paid", "metrics_receivables_by_division",
    "metrics_reliability_by_division", "metrics_contacts_by_channel", "metrics_revenue_yoy_by_year", "visual_v04", "visual_v08",
    "visual_v11", "visual_v31", "forecast_scored", "wind_band_stats", "metrics_forecast",
]


@pytest.fixture(scope="module")
def duck(small_folder):
    return connect(small_folder)


@pytest.mark.parametrize("name", CHECKED)
def test_matches_sql(spark, duck, small_folder, name):
    assert compare(spark, duck, small_folder, driver.queries()[name], driver.oracle_sql()[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries()) and len(driver.queries()) > 120


def test_no_nested_loops_over_data(spark, small_folder):
    """Nested-loop joins are allowed only against one-row sides (global aggregates)."""
    for name in ("rpt_ar_aging_monthly", "rpt_billing_exceptions_monthly", "rpt_digital_adoption_monthly", "rpt_customer_360"):
        plan = driver.queries()[name](spark, small_folder)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name
