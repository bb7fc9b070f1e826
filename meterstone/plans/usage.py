"""Daily meter reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstone.settings import Settings

c = F.col


PLACE = ("division", "elec_rate_code")


def placed_reads(reads: DataFrame, premises: DataFrame, cfg: Settings) -> DataFrame:
    """Reads of known meters with a spike flag against the meter's own mean, and their place.

    The mean (spikes included, missing reads skipped) collapses before the
    shuffle. It is joined to the premise first, so the reads take part in one
    join only, which adaptive execution splits when a meter is hot.
    """
    mean = reads.groupBy("meter_id").agg(F.avg("kwh").alias("_mean_kwh"))
    meters = premises.select("premise_id", c("elec_meter_id").alias("meter_id"), *PLACE).join(mean, "meter_id")
    spike = c("kwh") > F.lit(cfg.spike_factor) * c("_mean_kwh")
    return reads.join(meters, "meter_id").select(
        "meter_id", "premise_id", "read_date", "kwh", "peak_kw", "read_quality", "is_missing",
        F.coalesce(spike, F.lit(False)).alias("is_spike"), *PLACE,
    )


def fact_ami_daily(placed: DataFrame) -> DataFrame:
    return placed.drop(*PLACE)
