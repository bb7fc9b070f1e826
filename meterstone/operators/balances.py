"""Running totals per key and month, and the intervals between the steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterstone.functions.dates import month_end


def monthly_steps(df: DataFrame, key: str, day: str, amount: str) -> DataFrame:
    """Running total per key at every month-end with activity.

    Columns: key, ``me``, ``cum_paid``, ``next_me`` (next step, NULL at the last)
    and ``is_first``. Rows are summed to (key, month) before the window, so a
    window group holds at most one row per month however hot the key is.
    """
    monthly = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key, month_end(F.col(day)).alias("me"))
        .agg(F.sum(amount).alias("_amount"))
    )
    in_order = Window.partitionBy(key).orderBy("me")
    return monthly.select(
        key,
        "me",
        F.sum("_amount").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("cum_paid"),
        F.lead("me").over(in_order).alias("next_me"),
        F.lag("me").over(in_order).isNull().alias("is_first"),
    )


def reached_month(steps: DataFrame, targets: DataFrame, key: str, target: str, tolerance) -> DataFrame:
    """First month-end at which the running total reaches the key's target."""
    return (
        steps.join(targets.select(key, target), key)
        .filter(F.col("cum_paid") >= F.col(target) - F.lit(tolerance))
        .groupBy(key)
        .agg(F.min("me").alias("paid_me"))
    )


def as_of_month_ends(steps: DataFrame, key: str, window_start, window_end) -> DataFrame:
    """Latest running total on or before each month-end of the window, per key.

    Each step is valid until the next one, so the as-of lookup is an expansion
    of the validity interval rather than a per-row search.
    """
    from meterstone.operators.months import explode_month_ends

    out = explode_month_ends(steps, F.col("me"), F.coalesce("next_me", F.lit("9999-12-31").cast("date")),
                             window_start, window_end, "month_end")
    return out.select(key, "month_end", "cum_paid")
