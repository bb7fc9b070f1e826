"""Registered queries: (Spark callable, check SQL) by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from driver_tables.extracts import SETTINGS, TABLES, Extracts
from driver_tables.oracle import compose
from meterstone import Reports, Warehouse
from meterstone.session import fit_partitions
from meterstone.sources.lake import file_listing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


_BUILT: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The datasets of a folder. Plans (no data) are kept per session, as views would be."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _BUILT:
        given = [f"{folder.rstrip('/')}/{t}.parquet" for t in TABLES]
        fit_partitions(spark, file_listing(spark, given).agg(F.sum("length")).first()[0] or 0)
        _BUILT[key] = Warehouse(spark, Extracts(spark, folder), SETTINGS)
    return _BUILT[key]


def reports(w: Warehouse) -> Reports:
    if "_reports" not in w.__dict__:
        w.__dict__["_reports"] = Reports(w)
    return w.__dict__["_reports"]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded: sums of doubles depend on row order in the last bits."""
    if not any(isinstance(f.dataType, DoubleType) for f in df.schema.fields):
        return df
    name = lambda f: f"`{f.name}`"
    return df.selectExpr(*[
        f"round({name(f)}, {digits}) AS {name(f)}" if isinstance(f.dataType, DoubleType) else name(f)
        for f in df.schema.fields
    ])


def register(name: str, query: Callable[[Warehouse], DataFrame], sql: str | None = None, doubles: str = "") -> None:
    """``doubles`` names the double columns the check SQL must round too."""
    QUERIES[name] = lambda spark, folder: rounded(query(warehouse(spark, folder)))
    if sql is not None:
        names = doubles.split()
        if names:
            sql = f"SELECT * REPLACE ({', '.join(f'round({n}, 6) AS {n}' for n in names)}) FROM ({sql}) q"
        SQL[name] = compose(sql)


def dataset(name: str, attribute: str, block: str, doubles: str = "", report: bool = False) -> None:
    if report:
        register(name, lambda w: getattr(reports(w), attribute), f"SELECT * FROM {block}", doubles)
    else:
        register(name, lambda w: getattr(w, attribute), f"SELECT * FROM {block}", doubles)


for _name in ("customer", "premise", "installation", "contract", "bill", "payment", "payment_plan", "service_order",
              "work_order", "outage", "interaction", "ami_read", "weather", "rate"):
    _d = {"premise": "latitude longitude", "bill": "kwh therms", "ami_read": "kwh peak_kw",
          "weather": "temp_avg_f temp_max_f temp_min_f precip_in heating_degree_days cooling_degree_days",
          "rate": "delivery_per_unit supply_per_unit"}.get(_name, "")
    dataset(f"stg_{_name}", _name, f"s_{_name}", _d)

_W = "temp_avg_f temp_max_f temp_min_f precip_in heating_degree_days cooling_degree_days"
for _name, _attr, _block, _d in (
    ("dim_date", "dim_date", "w_date", _W),
    ("dim_rate", "dim_rate", "s_rate", "delivery_per_unit supply_per_unit"),
    ("dim_premise", "dim_premise", "w_premise", "latitude longitude"),
    ("dim_geography", "dim_geography", "w_geography", "latitude longitude"),
    ("dim_customer", "dim_customer", "w_customer", ""),
    ("fact_bill", "fact_bill", "w_bill", "kwh therms"),
    ("fact_payment", "fact_payment", "w_payment", ""),
    ("fact_ar_monthly", "fact_ar_monthly", "w_ar_monthly", ""),
    ("fact_ar_customer", "fact_ar_customer", "w_ar_customer", ""),
    ("fact_outage", "fact_outage", "w_outage", ""),
    ("fact_ami_daily", "fact_ami_daily", "w_ami", "kwh peak_kw"),
    ("fact_work_order", "fact_work_order", "w_work_order", ""),
    ("fact_service_order", "fact_service_order", "w_service_order", ""),
    ("fact_interaction", "fact_interaction", "s_interaction", ""),
    ("fact_payment_plan", "fact_payment_plan", "w_payment_plan", ""),
    ("major_event_days", "event_days", "w_event_days", "saidi threshold"),
    ("ar_open_items", "open_items", "w_open", ""),
    ("dq_summary", "dq_summary", "w_dq", ""),
):
    dataset(_name, _attr, _block, _d)

for _name, _block, _d in (
    ("dim_period", "r_period", ""),
    ("date_daily", "r_date", _W),
    ("division", "r_division", ""),
    ("revenue_monthly", "r_revenue", "kwh therms"),
    ("revenue_residential_monthly", "r_revenue_res", "kwh therms"),
    ("revenue_commercial_monthly", "r_revenue_com", "kwh therms"),
    ("ar_aging_monthly", "w_ar_monthly", ""),
    ("ar_top_accounts", "r_ar_top", ""),
    ("payments_monthly", "r_payments", ""),
    ("digital_adoption_monthly", "r_adoption", ""),
    ("ami_daily_profile", "r_ami", "kwh_valid max_peak_kw"),
    ("reliability_events", "r_outages", ""),
    ("work_orders_monthly", "r_work_orders", ""),
    ("work_order_backlog", "r_backlog", ""),
    ("contact_center_daily", "r_contacts", ""),
    ("collections_orders_monthly", "r_collections", "avg_cycle_days"),
    ("moratorium_compliance", "r_moratorium", ""),
    ("payment_plans_monthly", "r_plans", "avg_installments"),
    ("billing_exceptions_monthly", "r_exceptions", ""),
    ("rebills_monthly", "r_rebills", ""),
    ("service_orders_monthly", "r_service", ""),
    ("customer_360", "r_customer_360", "latitude longitude"),
    ("customer_bills_recent", "r_bills_recent", "kwh therms"),
    ("data_quality", "r_dq", ""),
):
    dataset(f"rpt_{_name}", _name, _block, _d, report=True)
