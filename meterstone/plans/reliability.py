"""Outages, daily SAIDI and major event days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstone.settings import Settings

c = F.col


def event_days(outage: DataFrame, geography: DataFrame, cfg: Settings) -> DataFrame:
    """Daily SAIDI and the major-event flag (2.5-beta method on log SAIDI).

    Outages collapse to one row per day first; served customers and the log
    mean / deviation are single rows, so both cross joins are one row wide.
    """
    served = geography.agg(F.sum("customers_served").cast("double").alias("_served"))
    daily = (
        outage.filter(c("customer_minutes") > 0)
        .groupBy("outage_date")
        .agg(F.sum("customer_minutes").cast("double").alias("_minutes"))
        .crossJoin(F.broadcast(served))
        .select("outage_date", F.try_divide("_minutes", "_served").alias("saidi"))
    )
    spread = daily.agg(F.avg(F.ln("saidi")).alias("_alpha"), F.stddev_samp(F.ln("saidi")).alias("_beta"))
    limit = F.exp(c("_alpha") + F.lit(cfg.major_event_beta) * c("_beta"))
    return daily.crossJoin(F.broadcast(spread)).select(
        "outage_date",
        "saidi",
        limit.alias("threshold"),
        c("saidi").cast("decimal(10,4)").alias("daily_saidi_min"),
        F.coalesce(c("saidi") > limit, F.lit(False)).alias("is_major_event_day"),
    )


def fact_outage(outage: DataFrame, dates: DataFrame) -> DataFrame:
    """Outages with the flag of their day. The calendar has a row a day, so it goes to the outages."""
    flags = F.broadcast(dates.select(c("date").alias("outage_date"), "is_major_event_day"))
    return outage.join(flags, "outage_date").select(*outage.columns, "is_major_event_day")
