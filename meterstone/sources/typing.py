"""Typing of all-text extracts by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstone.functions.dates import sap_date, sap_seconds
from meterstone.sources.contracts import RULE_OF


def typed_column(name: str, strict: bool = True) -> Column:
    """The column cast by its rule. Blank is NULL for every typed column.

    Not strict: text that does not fit its type becomes NULL instead of failing.
    """
    col, rule = F.col(name), RULE_OF.get(name)
    if rule is None:
        return col
    filled = F.nullif(col, F.lit(""))
    if rule == "sap_date":
        out = sap_date(col, strict)
    elif rule == "sap_time":
        fits = F.lpad(filled, 6, "0").rlike("^([01][0-9]|2[0-3])([0-5][0-9]){2}$")
        bad = F.raise_error(F.concat(F.lit(f"malformed {name}: "), filled)) if strict else F.lit(None)
        out = F.when(filled.isNull(), F.lit(None)).when(fits, sap_seconds(filled)).otherwise(bad.cast("int"))
    elif strict:
        out = filled.cast(rule)
    else:
        out = filled.try_cast(rule)
    return out.alias(name)


def apply_types(df: DataFrame, strict: bool = True) -> DataFrame:
    """One projection; column order is kept."""
    return df.select(*[typed_column(name, strict) for name in df.columns])


def malformed_rows(df: DataFrame) -> DataFrame:
    """Rows in which some text does not fit its column's type (for a quarantine)."""
    tests = []
    for name in df.columns:
        if name in RULE_OF:
            given = F.col(name).isNotNull() & (F.col(name) != "")
            if RULE_OF[name] == "sap_date":
                given = given & (F.col(name) != "0")
            tests.append(given & typed_column(name, strict=False).isNull())
    return df.filter(reduce(lambda a, b: a | b, tests)) if tests else df.limit(0)
