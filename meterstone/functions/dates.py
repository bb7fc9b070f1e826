"""Calendar expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: marks an interval without an end.
OPEN_END = date(9999, 12, 31)


def sap_date(c: Column, strict: bool = True) -> Column:
    """``YYYYMMDD`` text; blank and ``0`` are NULL.

    Strict mode fails on malformed text, otherwise malformed text is NULL and
    can be quarantined by comparing with the input.
    """
    missing = c.isNull() | c.isin("", "0")
    parsed = F.to_date(c, "yyyyMMdd") if strict else F.to_date(F.try_to_timestamp(c, F.lit("yyyyMMdd")))
    return F.when(~missing, parsed)


def sap_seconds(c: Column) -> Column:
    """``HHMMSS`` text that may have lost leading zeros -> seconds since midnight."""
    padded = F.lpad(c, 6, "0")
    part = lambda at: F.substring(padded, at, 2).cast("int")
    return part(1) * 3600 + part(3) * 60 + part(5)


def at_second_of_day(day: Column, seconds: Column) -> Column:
    return day.cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def minute_marks_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed (00:00:59 -> 00:01:01 is 1).

    Counted from the date and clock parts, so it does not depend on the session
    time zone.
    """
    clock = lambda t: F.hour(t) * 60 + F.minute(t)
    return F.datediff(F.to_date(end), F.to_date(start)) * 1440 + clock(end) - clock(start)


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def month_end(c: Column) -> Column:
    return F.last_day(c)


def period_key(c: Column) -> Column:
    return F.year(c) * 100 + F.month(c)


def weekday_number(c: Column) -> Column:
    """Monday = 1."""
    return F.weekday(c) + 1


def in_winter_moratorium(c: Column) -> Column:
    """15 November to 15 March, both included."""
    md = F.month(c) * 100 + F.dayofmonth(c)
    return (md >= 1115) | (md <= 315)


def years_between(start: Column, end: Column) -> Column:
    return (F.datediff(end, start) / F.lit(365.25)).cast("decimal(5,1)")
