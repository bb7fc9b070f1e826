"""Aggregate expressions shared by the plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def count_where(test: Column) -> Column:
    """Rows meeting a test; 0 (not NULL) when none does."""
    return F.count(F.when(test, F.lit(1)))


def sum_where(test: Column, value) -> Column:
    """Sum over the rows meeting a test, other rows counting as 0."""
    return F.sum(F.when(test, as_column(value)).otherwise(F.lit(0)))


def weighted_mean(value, weight) -> Column:
    return F.try_divide(F.sum(as_column(value) * as_column(weight)), F.sum(as_column(weight)))


def ratio(top: Column, bottom: Column) -> Column:
    """NULL on a zero or missing denominator; always a double."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))
