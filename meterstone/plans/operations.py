"""Work orders, service orders, contacts and payment plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstone.settings import Settings

c = F.col


def fact_work_order(work_order: DataFrame, cfg: Settings) -> DataFrame:
    as_of = F.lit(cfg.as_of)
    return work_order.select(
        "*",
        F.when(c("is_open"), F.datediff(as_of, "created_date")).alias("open_age_days"),
        F.datediff("actual_finish", "planned_finish").alias("finish_variance_days"),
        F.coalesce(c("actual_finish") <= c("planned_finish"), F.lit(False)).alias("finished_on_time"),
        F.coalesce(c("is_open") & (c("planned_finish") < as_of), F.lit(False)).alias("is_overdue"),
    )


def fact_service_order(service_order: DataFrame, premises: DataFrame, cfg: Settings) -> DataFrame:
    place = premises.select("premise_id", "division", "city")
    age = F.when(c("status") == "Open", F.datediff(F.lit(cfg.as_of), "created_date"))
    return service_order.join(place, "premise_id").select(
        *service_order.columns, "division", "city", age.alias("open_age_days")
    )


def fact_interaction(interaction: DataFrame) -> DataFrame:
    return interaction


def fact_payment_plan(plan: DataFrame, customers: DataFrame) -> DataFrame:
    owner = customers.select("account_id", "customer_id", "segment", "division", "is_low_income")
    return plan.join(owner, "account_id").select(
        *plan.columns, "customer_id", "segment", "division", "is_low_income"
    )
