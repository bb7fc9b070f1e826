"""Weather forecast payloads: parallel arrays per division -> rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

c = F.col

PAYLOAD = (
    "array<struct<daily: struct<time: array<string>, wind_gusts_10m_max: array<double>, wind_speed_10m_max: array<double>, "
    "precipitation_sum: array<double>, temperature_2m_max: array<double>, temperature_2m_min: array<double>>>>"
)
# Fixed value: degree days are counted from this temperature (F).
COMFORT_F = 65.0


def request_order(divisions: DataFrame) -> DataFrame:
    """Position of each division in the request: alphabetical, from 0.

    The division list has one row per division, a handful of rows.
    """
    ordered = divisions.agg(F.array_sort(F.collect_list("division")).alias("all"))
    return ordered.select(F.posexplode("all").alias("_at", "division")).select("division", "_at")


def parse_forecast(payloads: DataFrame, divisions: DataFrame, retrieved_at: datetime) -> DataFrame:
    """Rows per division and day from the ``payload`` text column.

    Element i of the payload belongs to division i of the request. Missing rain
    counts as 0.
    """
    elements = payloads.select(F.posexplode(F.from_json("payload", PAYLOAD)).alias("_at", "_one"))
    d = c("_one.daily")
    zipped = F.arrays_zip(
        d["time"].alias("day"), d["wind_gusts_10m_max"].alias("gust"), d["wind_speed_10m_max"].alias("wind"),
        d["precipitation_sum"].alias("rain"), d["temperature_2m_max"].alias("high"), d["temperature_2m_min"].alias("low"),
    )
    # arrays_zip numbers the fields of expressions, so they are read by position
    rows = elements.select("_at", F.explode(zipped).alias("z"))
    fields = rows.schema["z"].dataType.fieldNames()
    rows = rows.select("_at", *[c("z")[f].alias(n) for f, n in zip(fields, ("day", "gust", "wind", "rain", "high", "low"))])
    mean = (c("high") + c("low")) / 2
    return rows.join(request_order(divisions), "_at").select(
        "division",
        F.to_date("day").alias("forecast_date"),
        c("gust").alias("max_gust_mph"),
        c("wind").alias("max_wind_mph"),
        F.coalesce("rain", F.lit(0.0)).alias("precip_in"),
        c("high").alias("temp_max_f"),
        c("low").alias("temp_min_f"),
        mean.alias("temp_avg_f"),
        F.greatest(mean - COMFORT_F, F.lit(0.0)).alias("cdd"),
        F.greatest(COMFORT_F - mean, F.lit(0.0)).alias("hdd"),
        F.lit(retrieved_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("retrieved_at"),
    )
