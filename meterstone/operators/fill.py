"""Forward fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def fill_down(df: DataFrame, order: str, columns: Sequence[str], within: Sequence[str]) -> DataFrame:
    """Empty values take the last value above them in their group.

    ``within`` names the groups the order restarts in and has to be given: a table filled as one group is ordered in one task.
    For lookup tables of a few rows there is ``fill_lookup``.
    """
    if not within:
        raise ValueError("name the groups to fill within, or use fill_lookup for a lookup table")
    w = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def fill_lookup(df: DataFrame, order: str, columns: Sequence[str]) -> DataFrame:
    """The same for a lookup table (fixed bands, levels) as a join with itself: the known value of the highest place not above a row's own.

    The table is broadcast, so it must be of a fixed small size.
    """
    out = df
    for name in columns:
        known = F.broadcast(df.filter(F.col(name).isNotNull()).select(F.col(order).alias("_at"), F.col(name).alias("_value")))
        joined = out.join(known, F.col("_at") <= F.col(order), "left")
        last = joined.groupBy(order).agg(F.max_by("_value", "_at").alias("_last")).withColumnRenamed(order, "_order")
        out = out.join(F.broadcast(last), F.col(order) == F.col("_order"), "left").withColumn(name, F.col("_last")).drop("_last", "_order")
    return out
