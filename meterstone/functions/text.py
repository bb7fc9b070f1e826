"""Text clean-up as Catalyst expressions.

The source database compares text without regard to case and trailing blanks;
``same_text``/``one_of``/``label`` keep that. Data-quality checks that must see
case and blanks compare columns directly (Spark text equality is binary).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def folded(c: Column) -> Column:
    return F.upper(F.rtrim(c))


def same_text(c: Column, value: str) -> Column:
    """True/False, never NULL."""
    return F.coalesce(folded(c) == value.upper(), F.lit(False))


def one_of(c: Column, values: Iterable[str]) -> Column:
    return F.coalesce(folded(c).isin([v.upper() for v in values]), F.lit(False))


def label(c: Column, table: Mapping[str, str], default: str | None = None) -> Column:
    """Decode a code; unknown codes give ``default`` (NULL when not given)."""
    quoted = lambda text: "'" + text.replace("'", "\\'") + "'"
    pairs = ", ".join(f"{quoted(code.upper())}, {quoted(text)}" for code, text in table.items())
    found = F.try_element_at(F.expr(f"map({pairs})"), folded(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def blank_to_null(c: Column) -> Column:
    return F.when(F.rtrim(c) != "", c)


def visible_length(c: Column) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(c))


def is_all_caps(c: Column) -> Column:
    """All upper case and longer than one character; NULL counts as no."""
    return F.coalesce((c == F.upper(c)) & (visible_length(c) > 1), F.lit(False))


def proper_surname(c: Column) -> Column:
    """First letter up, rest down - only for names delivered in capitals."""
    fixed = F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 100)))
    return F.when(is_all_caps(c), fixed).otherwise(c)


def phone10(c: Column) -> Column:
    """Ten digits or NULL; a leading country digit 1 is dropped."""
    digits = F.translate(F.coalesce(c, F.lit("")), "()-+ ", "")
    size = F.length(digits)
    return F.when((size == 11) & digits.startswith("1"), F.substring(digits, 2, 10)).when(size == 10, digits)


def phone_needs_format(c: Column) -> Column:
    """Delivered, but not as ``(ddd) ddd-dddd``."""
    return F.coalesce(~F.rtrim(c).rlike(r"^\([0-9]{3}\) [0-9]{3}-[0-9]{4}$"), F.lit(False))


def zip5(c: Column) -> Column:
    return F.right(F.concat(F.lit("00000"), F.trim(c)), F.lit(5))


def optional_suffix(c: Column) -> Column:
    """`` <text>`` or nothing when NULL."""
    return F.coalesce(F.concat(F.lit(" "), c), F.lit(""))
