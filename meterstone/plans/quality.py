"""Audit of what staging fixed: one row per check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstone.operators.statistics import count_where
from meterstone.settings import Settings

c = F.col

# Fixed values: (order, source, check, action) texts of the audit.
CHECKS = {
    1: ("sap_isu.ADRC", "ZIP code missing leading zero", "Left-padded to 5 digits"),
    2: ("sap_isu.ADRC", "City name upper-case or trailing spaces", "Replaced with canonical city from ZIP"),
    3: ("sap_isu.BUT000", "Last name in all caps", "Converted to proper case"),
    4: ("sap_isu.BUT000", "Phone number in non-standard format", "Normalized to 10 digits"),
    5: ("sap_isu.BUT000", "Missing email address", "Kept; reported as contactability gap"),
    6: ("sap_isu.DFKKZP", "Duplicate payment rows from re-extract", "Removed (kept first per PAYMENT_ID)"),
    7: ("sap_isu.ERCH", "Reversed billing documents", "Excluded from revenue and AR (rebill carries amount)"),
    8: ("ami.daily_reads", "Missing interval reads", "Flagged; excluded from usage averages"),
    9: ("ami.daily_reads", "Usage spike > {spike_factor:g}x meter average", "Flagged as outlier"),
    10: ("crm.interactions", "Contact not linked to a customer", "Kept; reported as unidentified"),
    11: ("oms.outage_events", "Outage still open at as-of date", "Excluded from closed-event durations"),
}


def _checks(df: DataFrame, tests: dict[int, Column]) -> DataFrame:
    """All checks of one dataset in one pass."""
    totals = df.agg(F.count(F.lit(1)).alias("n"), *[count_where(t).alias(f"c{k}") for k, t in tests.items()])
    rows = F.array(*[F.struct(F.lit(k).alias("check_order"), c("n").alias("rows_checked"),
                              c(f"c{k}").alias("rows_affected")) for k in tests])
    return totals.select(F.inline(rows))


def dq_summary(premises, customers, raw_payments, payments, bills, reads, contacts, outages, cfg: Settings) -> DataFrame:
    marked = raw_payments.select(F.lit(1).alias("raw"), F.lit(0).alias("kept")).unionAll(payments.select(F.lit(0), F.lit(1)))
    dropped = marked.agg(F.sum("raw").alias("rows_checked"), F.sum("kept").alias("_kept")).select(
        F.lit(6).alias("check_order"), F.coalesce("rows_checked", F.lit(0)).alias("rows_checked"),
        (F.coalesce("rows_checked", F.lit(0)) - F.coalesce("_kept", F.lit(0))).alias("rows_affected"))
    parts = [
        _checks(premises, {1: c("dq_zip_fixed"), 2: c("dq_city_fixed")}),
        _checks(customers, {3: c("dq_name_fixed"), 4: c("dq_phone_reformatted"), 5: ~c("has_email")}),
        dropped,
        _checks(bills, {7: c("is_reversed")}),
        _checks(reads, {8: c("is_missing"), 9: c("is_spike")}),
        _checks(contacts, {10: ~c("is_identified")}),
        _checks(outages, {11: c("is_open")}),
    ]
    counts = reduce(DataFrame.unionByName, parts)
    spark = counts.sparkSession
    texts = spark.createDataFrame(
        [(k, table, text.format(spike_factor=cfg.spike_factor), action) for k, (table, text, action) in CHECKS.items()],
        "check_order int, source_table string, dq_check string, action_taken string",
    )
    return counts.join(F.broadcast(texts), "check_order").select(
        "check_order", "source_table", "dq_check", "action_taken", "rows_checked", "rows_affected"
    )


def unique_key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are missing or occur more than once (what a primary key rejects)."""
    missing = reduce(lambda a, b: a | b, [c(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter((c("rows") > 1) | missing)


# What identifies a row of each table.
PRIMARY_KEYS = {
    "dim_date": ["date"],
    "dim_rate": ["rate_code"],
    "dim_premise": ["premise_id"],
    "dim_geography": ["city"],
    "dim_customer": ["customer_id"],
    "fact_ar_customer": ["customer_id"],
    "fact_outage": ["outage_id"],
}


def key_audit(warehouse) -> DataFrame:
    """Rows and key violations per table with a primary key; 0 violations is a pass."""

    def audit(name: str, keys: list[str]) -> DataFrame:
        missing = reduce(lambda a, b: a | b, [c(k).isNull() for k in keys])
        per_key = getattr(warehouse, name).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        return per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), count_where((c("n") > 1) | missing).alias("violations")
        ).select(F.lit(name).alias("table_name"), "rows", "violations")

    return reduce(DataFrame.unionByName, [audit(n, k) for n, k in PRIMARY_KEYS.items()])
