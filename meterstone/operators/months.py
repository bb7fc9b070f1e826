"""Month-end expansion in place of range joins against a month table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month_number(d: Column) -> Column:
    """Months since January 1970."""
    return (F.year(d) - 1970) * 12 + F.month(d) - 1


def end_of_month_number(n: Column) -> Column:
    return F.last_day(F.add_months(F.lit(date(1970, 1, 1)), n))


def open_month_bounds(first: Column, before: Column | None, window_start: date, window_end: date) -> tuple[Column, Column]:
    """Numbers of the first and the last month of the window whose end ``m`` has ``m >= last_day(first)`` and ``m < before``.

    There is no such month where the first number is above the last.
    """
    low = F.greatest(month_number(first), month_number(F.lit(window_start)))
    high = month_number(F.lit(window_end))
    if before is not None:
        high = F.least(month_number(before) - 1, high)
    return low, high


def open_month_numbers(first: Column, before: Column | None, window_start: date, window_end: date) -> Column:
    """Numbers of the months between the bounds of ``open_month_bounds``.

    Only the months of the window are listed, so the array is never longer than
    the window. NULL (no element) when there is none. Whole numbers are used
    because stepping integers is far cheaper per element than stepping dates.
    """
    low, high = open_month_bounds(first, before, window_start, window_end)
    return F.when(low <= high, F.sequence(low, high))


def explode_month_ends(
    df: DataFrame, first: Column, before: Column | None, window_start: date, window_end: date, name: str
) -> DataFrame:
    """One row per month-end of each row's active interval: narrow, no join."""
    months = open_month_numbers(first, before, window_start, window_end)
    numbered = df.select("*", F.explode(months).alias("_month_number"))
    return numbered.withColumn(name, end_of_month_number(F.col("_month_number"))).drop("_month_number")


def counts_by_month(
    df: DataFrame, by: Sequence[str], spans: Mapping[str, tuple[Column, Column]], window_start: date, window_end: date, name: str
) -> DataFrame:
    """How many rows of each group are inside each of their spans at every month-end of the window.

    ``spans`` names a count and gives the first and last month number of a row's span (nothing is counted where one is NULL
    or the last comes first). A row gives a step up at the first month and a step down after the last one, whatever
    lies between; steps are summed by group and month, a running sum over a group's months (at most the window's) turns them
    into counts, and each sum is carried to the month before the next step. Months in which all counts are 0 have no row.
    """
    low, high = F.lit((window_start.year - 1970) * 12 + window_start.month - 1), F.lit((window_end.year - 1970) * 12 + window_end.month - 1)
    steps = []
    for span, (first, last) in spans.items():
        begin, end = F.greatest(first, low), F.least(last, high)
        inside = first.isNotNull() & last.isNotNull() & (begin <= end)
        change = lambda at, by_one, own=span: F.when(inside, F.struct(at.alias("_month"), *[F.lit(by_one if s == own else 0).cast("long").alias(s) for s in spans]))
        steps += [change(begin, 1), change(end + 1, -1)]
    moved = df.select(*by, F.explode(F.array_compact(F.array(*steps))).alias("_step")).select(*by, "_step.*").filter(F.col("_month") <= high)
    sums = moved.groupBy(*by, "_month").agg(*[F.sum(s).alias(s) for s in spans])
    in_order = Window.partitionBy(*by).orderBy("_month")
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = sums.select(*by, "_month", (F.coalesce(F.lead("_month").over(in_order), high + 1) - 1).alias("_until"), *[F.sum(s).over(upto).alias(s) for s in spans])
    some = F.greatest(*[F.col(s) for s in spans], F.lit(0)) > 0
    each = counts.filter(some).select(*by, F.explode(F.sequence("_month", "_until")).alias("_month"), *spans)
    return each.select(end_of_month_number(F.col("_month")).alias(name), *by, *spans)


def day_spine(spark, start: date, end: date, name: str = "date") -> DataFrame:
    """Every day from start to end."""
    one = spark.range(1)
    return one.select(F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias(name))
