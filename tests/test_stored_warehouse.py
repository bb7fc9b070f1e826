"""A stored warehouse: bucketed ledger without exchanges, open items written once."""

from driver_tables.extracts import SETTINGS, Extracts
from meterstone import Reports, Warehouse
from meterstone.plans import receivables

LEDGER = ("dim_customer", "fact_bill", "fact_payment", "fact_ar_monthly", "fact_ar_customer")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_ledger_moves_no_bill_or_payment(spark, small_folder, tmp_path):
    plain = Warehouse(spark, Extracts(spark, small_folder), SETTINGS)
    stored = Warehouse(spark, Extracts(spark, small_folder), SETTINGS).store(str(tmp_path / "dw"), LEDGER, buckets=8)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on tables too large to broadcast
    try:
        opened = receivables.open_items(stored.fact_bill, stored.fact_payment, SETTINGS.window_start, SETTINGS.window_end)
        assert "Exchange" not in plan(opened) and "SortMergeJoin" in plan(opened)
        assert plan(receivables.open_items(plain.fact_bill, plain.fact_payment, SETTINGS.window_start, SETTINGS.window_end)).count("Exchange") > 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for name in LEDGER:
        a, b = getattr(plain, name), getattr(stored, name)
        assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name
    as_of = plan(stored.open_items_as_of)
    assert "PartitionFilters" in as_of and str(SETTINGS.as_of) in as_of.split("PartitionFilters", 1)[1][:200]
    assert opened.exceptAll(stored.open_items).isEmpty()


def test_audit_of_a_stored_warehouse_reads_no_fact(spark, small_folder, tmp_path):
    stored = Warehouse(spark, Extracts(spark, small_folder), SETTINGS).store(str(tmp_path / "dw"))
    found = plan(Reports(stored).data_quality)
    assert found.count("FileScan") == 1 and "dq_summary" in found
