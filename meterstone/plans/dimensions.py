"""Dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstone.functions import dates as D
from meterstone.operators.months import day_spine
from meterstone.operators.statistics import count_where
from meterstone.settings import Settings

c = F.col


def calendar(spark: SparkSession, cfg: Settings) -> DataFrame:
    """One row per day with calendar attributes (no weather)."""
    d = c("date")
    return day_spine(spark, cfg.calendar_start, cfg.calendar_end).select(
        "date",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month_num"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        D.month_start(d).alias("month_start"),
        D.month_end(d).alias("month_end"),
        D.weekday_number(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (D.weekday_number(d) > 5).alias("is_weekend"),
        D.in_winter_moratorium(d).alias("is_winter_moratorium"),
        d.between(F.lit(cfg.window_start), F.lit(cfg.window_end)).alias("is_in_window"),
    )


def dim_date(spark: SparkSession, cfg: Settings, weather: DataFrame, event_days: DataFrame) -> DataFrame:
    """Calendar + weather + reliability of the day.

    The event-day flags are joined in rather than updated afterwards, so the
    table is right whichever part is rebuilt. Both right sides have one row per
    calendar day.
    """
    flags = event_days.select(c("outage_date").alias("date"), "is_major_event_day", "daily_saidi_min")
    w = weather.withColumnRenamed("weather_date", "date")
    joined = calendar(spark, cfg).join(w, "date", "left").join(flags, "date", "left")
    return joined.withColumn("is_major_event_day", F.coalesce("is_major_event_day", F.lit(False)))


def dim_premise(premise: DataFrame, installation: DataFrame) -> DataFrame:
    """Premise with its electric (required) and gas (optional) installation."""
    electric = installation.filter(c("commodity") == "Electric").select(
        "premise_id",
        c("rate_code").alias("elec_rate_code"), "read_route",
        c("meter_id").alias("elec_meter_id"),
        c("meter_manufacturer").alias("elec_meter_manufacturer"),
        c("meter_technology").alias("elec_meter_technology"),
    )
    gas = installation.filter(c("commodity") == "Gas").select(
        "premise_id",
        F.lit(True).alias("has_gas"),
        c("rate_code").alias("gas_rate_code"),
        c("meter_technology").alias("gas_meter_technology"),
    )
    return premise.join(electric, "premise_id").join(gas, "premise_id", "left").select(
        "premise_id", "premise_type", "address_line", "city", "zip", "county", "division", "latitude", "longitude",
        "elec_rate_code", "read_route", "elec_meter_id", "elec_meter_manufacturer", "elec_meter_technology",
        F.coalesce("has_gas", F.lit(False)).alias("has_gas"), "gas_rate_code", "gas_meter_technology",
        "dq_zip_fixed", "dq_city_fixed",
    )


def dim_geography(towns: DataFrame, premises: DataFrame) -> DataFrame:
    """Town with served premises, counted by town name; 0 where there are none."""
    served = premises.groupBy(F.upper(F.rtrim("city")).alias("_town")).agg(
        F.count(F.lit(1)).alias("customers_served"),
        count_where(c("has_gas")).alias("gas_customers_served"),
    )
    return towns.withColumn("_town", F.upper(F.rtrim("CITY"))).join(served, "_town", "left").select(
        c("CITY").alias("city"), c("ZIP").alias("zip"), c("COUNTY").alias("county"), c("DIVISION").alias("division"),
        c("LAT").alias("latitude"), c("LON").alias("longitude"),
        F.coalesce("customers_served", F.lit(0)).alias("customers_served"),
        F.coalesce("gas_customers_served", F.lit(0)).alias("gas_customers_served"),
    )


def dim_customer(
    customer: DataFrame, contract: DataFrame, installation: DataFrame, premises: DataFrame, cfg: Settings
) -> DataFrame:
    """Customer (= contract account) with its electric contract and premise."""
    electric = installation.filter(c("commodity") == "Electric").select("installation_id", "premise_id")
    service = contract.join(electric, "installation_id").select(
        "account_id", "premise_id", "move_in_date", "move_out_date", "is_active",
        c("supplier").alias("elec_supplier"),
    )
    place = premises.select("premise_id", "city", "division")
    until = F.coalesce("move_out_date", F.lit(cfg.as_of))
    return customer.join(service, "account_id").join(place, "premise_id").select(
        "customer_id", "account_id", "customer_name", "customer_type", "segment_code", "segment",
        "created_date", "email", "phone", "has_email", "has_phone",
        "is_autopay", "autopay_date", "is_paperless", "paperless_date",
        "is_budget_billing", "is_low_income", "has_medical_cert",
        "premise_id", "city", "division",
        "move_in_date", "move_out_date", "is_active", "elec_supplier",
        D.years_between(c("move_in_date"), until).alias("tenure_years"),
        "dq_name_fixed", "dq_phone_reformatted",
    )
