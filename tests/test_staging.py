"""Staging and warehouse rules on hand-made extracts."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from meterstone.plans import dimensions, operations, reliability, staging, usage
from meterstone.settings import Settings


def test_premise_clean_up(spark):
    towns = spark.createDataFrame([("Newark", "Essex", "07102", "North")], "CITY string, COUNTY string, ZIP string, DIVISION string")
    rows = [(1, "NEWARK", "7102", None), (2, "Newark  ", "07102", "B"), (3, "Newark", " 7102 ", None), (4, "Lost", "99999", None)]
    adrc = spark.createDataFrame(
        [(i, 12, suffix, "Main St", city, zip_, "E", 1.0, 2.0) for i, city, zip_, suffix in rows],
        "ADDRNUMBER int, HOUSE_NUM1 bigint, HOUSE_NUM2 string, STREET string, CITY1 string, POST_CODE1 string, COUNTY string, "
        "GEO_LAT double, GEO_LON double")
    evbs = spark.createDataFrame([(i, i, "SFH", i) for i in range(1, 5)], "VSTELLE int, HAUS int, VBSART string, ADDRNUMBER int")
    got = {r.premise_id: r for r in staging.premise(evbs, adrc, towns).collect()}
    assert sorted(got) == [1, 2, 3]  # unknown ZIP drops out
    assert {r.city for r in got.values()} == {"Newark"} and {r.zip for r in got.values()} == {"07102"}
    assert [got[i].dq_city_fixed for i in (1, 2, 3)] == [True, True, False]
    assert [got[i].dq_zip_fixed for i in (1, 2, 3)] == [True, False, False]
    assert got[2].address_line == "12 Main St B" and got[1].address_line == "12 Main St"


def test_payment_copies(spark):
    one = (7, 1, 2, date(2024, 1, 1), Decimal("5.00"), "WEB")
    df = spark.createDataFrame([one] * 3 + [(8, 1, 2, date(2024, 1, 1), Decimal("5.00"), "??")],
                               "PAYMENT_ID int, VKONT int, BELNR int, BUDAT date, BETRZ decimal(14,2), PAY_CHANNEL string")
    got = {r.payment_id: (r.dup_rows, r.channel) for r in staging.payment(df).collect()}
    assert got == {7: (3, "Online"), 8: (1, None)}


def test_major_event_day(spark):
    rows = [(i, datetime(2024, 1, 1 + i), 100 + i % 3) for i in range(20)]
    rows += [(20, datetime(2024, 1, 25), 100_000), (21, datetime(2024, 1, 26), 0)]
    outage = spark.createDataFrame(rows, "id int, at timestamp_ntz, customer_minutes bigint").withColumn("outage_date", F.to_date("at"))
    town = spark.createDataFrame([("a", 1000)], "city string, customers_served bigint")
    days = reliability.event_days(outage, town, Settings())
    assert [r.outage_date for r in days.filter("is_major_event_day").collect()] == [date(2024, 1, 25)]
    assert days.count() == 21  # days without minutes stay out of mean and deviation


def test_spike_mean_includes_the_spike(spark):
    reads = spark.createDataFrame(
        [(1, date(2024, 1, d), 1.0, 0.1, "VALID", False) for d in range(1, 31)] + [(1, date(2024, 2, 1), 100.0, 9.0, "VALID", False),
         (1, date(2024, 2, 2), None, None, "MISSING", True), (2, date(2024, 1, 1), 5.0, 1.0, "VALID", False)],
        "meter_id int, read_date date, kwh double, peak_kw double, read_quality string, is_missing boolean")
    premises = spark.createDataFrame([(10, 1, "N", "R1")], "premise_id int, elec_meter_id int, division string, elec_rate_code string")
    got = usage.fact_ami_daily(usage.placed_reads(reads, premises, Settings()))
    assert got.count() == 32 and [r.kwh for r in got.filter("is_spike").collect()] == [100.0]  # mean 130/31, limit 62.9
    assert usage.placed_reads(reads, premises, Settings(spike_factor=25)).filter("is_spike").count() == 0


def test_geography_counts_zero(spark):
    towns = spark.createDataFrame([("A", "1", "c", "N", 1.0, 1.0), ("B", "2", "c", "S", 1.0, 1.0)],
                                  "CITY string, ZIP string, COUNTY string, DIVISION string, LAT double, LON double")
    premises = spark.createDataFrame([("a ", True), ("A", False)], "city string, has_gas boolean")
    got = {r.city: (r.customers_served, r.gas_customers_served) for r in dimensions.dim_geography(towns, premises).collect()}
    assert got == {"A": (2, 1), "B": (0, 0)}


def test_calendar_keys(spark):
    cfg = Settings()
    days = dimensions.calendar(spark, cfg)
    assert days.count() == 4748 and days.select("date").distinct().count() == 4748
    assert days.filter("is_in_window").count() == 730
    row = days.filter("date = date'2024-10-01'").first()
    assert (row.day_of_week, row.day_name, row.year_month, row.month_end) == (2, "Tuesday", "2024-10", date(2024, 10, 31))


def test_work_order_flags(spark):
    df = spark.createDataFrame(
        [(True, date(2026, 9, 1), date(2026, 9, 10), None), (False, date(2026, 9, 1), date(2026, 9, 10), date(2026, 9, 12)),
         (True, date(2026, 9, 1), None, None)],
        "is_open boolean, created_date date, planned_finish date, actual_finish date")
    got = [tuple(r)[4:] for r in operations.fact_work_order(df, Settings()).collect()]
    assert got == [(29, None, False, True), (None, 2, False, False), (29, None, False, False)]


def test_key_audit(spark, small_folder):
    from driver_tables.queries import warehouse
    from meterstone.plans.quality import PRIMARY_KEYS, key_audit

    got = {r.table_name: r.violations for r in key_audit(warehouse(spark, small_folder)).collect()}
    assert got == dict.fromkeys(PRIMARY_KEYS, 0)


def test_minutes_do_not_depend_on_the_time_zone(spark):
    events = spark.sql("""SELECT 1L EVENT_ID, timestamp_ntz'2024-03-10 01:30:59' EVENT_START, timestamp_ntz'2024-03-10 03:30:01' RESTORE_TIME,
        'N' DIVISION, 'm' MUNICIPALITY, 'c' CIRCUIT_ID, 'd' DEVICE_TYPE, 'x' CAUSE, 1L CUSTOMERS_OUT, 1L CUSTOMER_MINUTES""")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # this night has no 02:30
    try:
        assert staging.outage(events).first().duration_min == 120
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_reports_over_stored_facts_are_the_same(spark, small_folder):
    from driver_tables.extracts import SETTINGS, Extracts
    from meterstone import Reports, Warehouse
    from meterstone.session import scratch_path

    lazy = Warehouse(spark, Extracts(spark, small_folder), SETTINGS)
    stored = Warehouse(spark, Extracts(spark, small_folder), SETTINGS).store(
        scratch_path(spark, "wh"), ["dim_premise", "dim_customer", "fact_payment", "fact_ami_daily"])
    for name in ("payments_monthly", "ami_daily_profile"):
        a, b = (getattr(Reports(w), name) for w in (lazy, stored))
        b = b.select(*a.columns)
        if name == "ami_daily_profile":
            a, b = (x.withColumn("kwh_valid", F.round("kwh_valid", 4)) for x in (a, b))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name
