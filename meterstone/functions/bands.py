"""Banding of numbers into labelled, ordered ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (highest days past due, label, order) of the aging buckets.
AGING_BUCKETS = (
    (0, "Current", 1),
    (30, "1-30", 2),
    (60, "31-60", 3),
    (90, "61-90", 4),
    (180, "91-180", 5),
)
WRITTEN_OFF = ("Written Off", 9)
WRITE_OFF_AFTER_DAYS = 180


def _ladder(value: Column, steps: Sequence[tuple], pick: int, last) -> Column:
    out = None
    for step in steps:
        test = value <= step[0]
        out = F.when(test, step[pick]) if out is None else out.when(test, step[pick])
    return out.otherwise(last)


def aging_order(days_past_due: Column) -> Column:
    return _ladder(days_past_due, AGING_BUCKETS, 2, WRITTEN_OFF[1])


def aging_starts() -> list[tuple[int, int | None]]:
    """(order, lowest days past due) of the buckets by age; the first has no lowest."""
    orders = [order for _, _, order in AGING_BUCKETS] + [WRITTEN_OFF[1]]
    return list(zip(orders, [None, *[highest + 1 for highest, _, _ in AGING_BUCKETS]]))


def aging_bucket(bucket_order: Column) -> Column:
    """Label of a bucket order."""
    out = None
    for _, text, order in AGING_BUCKETS:
        test = bucket_order == order
        out = F.when(test, text) if out is None else out.when(test, text)
    return out.otherwise(WRITTEN_OFF[0])


def band_field(value: Column, bands: Sequence[tuple], pick: int, outside=None) -> Column:
    """Field ``pick`` of the band (low, high, label, order) with low <= value < high."""
    out = None
    for band in bands:
        test = (value >= band[0]) & (value < band[1])
        out = F.when(test, band[pick]) if out is None else out.when(test, band[pick])
    return out if outside is None else out.otherwise(outside)
