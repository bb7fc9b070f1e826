"""What keeps tasks and shuffles small on large tables."""

import os
import random
import time
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from driver_tables import lake_checks, queries
from driver_tables.extracts import TABLES
from meterstone import session
from meterstone.operators.dedup import keep_one_per_key
from meterstone.operators.lag import previous_values
from meterstone.plans import receivables
from meterstone.plans.reliability import fact_outage
from meterstone.sources import publish as publishing


def test_shuffle_partitions_grow_with_the_input(spark, small_folder, monkeypatch):
    settings = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {s: spark.conf.get(s, None) for s in settings}
    given = int(before[settings[0]] or spark.conf.get("spark.sql.shuffle.partitions"))
    asked = []
    monkeypatch.setattr(queries, "fit_partitions", lambda s, n: asked.append(n))
    monkeypatch.setattr(queries, "_BUILT", {})
    queries.warehouse(spark, small_folder)
    assert asked == [sum(os.path.getsize(f"{small_folder}/{t}.parquet") for t in TABLES)]
    try:
        assert session.fit_partitions(spark, 1) == given and {s: spark.conf.get(s, None) for s in settings} == before
        assert session.fit_partitions(spark, 400 * session.INPUT_BYTES) == 400
        assert spark.conf.get(settings[0]) == "400" and spark.conf.get(settings[1]) == str(session.JOINED_BYTES)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_published_reports_share_stored_tables(spark, small_folder):
    w = queries.warehouse(spark, small_folder)
    r = lake_checks.stored_reports(w)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" in plan(queries.reports(w).customer_360)
    for name in ("payments_monthly", "customer_360", "ar_top_accounts", "customer_bills_recent", "ar_aging_monthly"):
        assert "l_orderkey" not in plan(getattr(r, name)), name
    assert "o_orderkey" not in plan(r.revenue_residential_monthly) and "o_orderkey" not in plan(r.revenue_commercial_monthly)
    for name in ("payments_monthly", "customer_bills_recent", "revenue_residential_monthly"):
        a, b = getattr(r, name), getattr(queries.reports(w), name)
        assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name


def test_joined_partitions_have_a_bound_where_enough_partitions_are_set(spark):
    """With the default 200 partitions, 1 GB needs no more of them, but adaptive execution joined them up to 64 MB."""
    settings = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {s: spark.conf.get(s, None) for s in settings}
    try:
        spark.conf.set(settings[0], "200")
        for given, kept in (("64MB", str(session.JOINED_BYTES)), ("8m", "8m"), (str(1 << 20), str(1 << 20))):
            spark.conf.set(settings[1], given)
            assert session.fit_partitions(spark, 100 * session.INPUT_BYTES) == 200
            assert spark.conf.get(settings[1]) == kept
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_landing_keeps_a_file_a_month_open(spark, small_folder, monkeypatch, tmp_path):
    """Rows are not sorted by month before they are written (they were, with spills on large tables)."""
    setting, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before = spark.conf.get(setting)
    inner = session.open_writers

    def noted(given):
        seen.append(given)
        return inner(given)

    monkeypatch.setattr(lake_checks, "open_writers", noted)
    w = queries.warehouse(spark, small_folder)
    path = lake_checks.land(w, "sap_isu/DFKKZP", f"{tmp_path}/raw")
    assert seen == [spark] and spark.conf.get(setting) == before
    landed, sent = spark.read.option("header", True).csv(path), w.src["DFKKZP"].selectExpr("date_format(BUDAT, 'yyyy-MM') AS year_month")
    assert landed.selectExpr("cast(year_month AS string)").exceptAll(sent).isEmpty() and landed.count() == sent.count()
    with session.open_writers(spark):
        assert spark.conf.get(setting) == str(session.WRITERS)


def test_publishing_moves_no_row_for_its_files(spark, tmp_path):
    """Each dataset was dealt out anew before it was written."""
    plain = spark.range(0, 1000, 1, 4)
    manifest = publishing.publish(spark, {"plain": plain}, str(tmp_path / "out")).first()
    assert (manifest.rows, manifest.files) == (1000, 4)


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    """They stayed until the driver collected its garbage: at 6 GB those of all datasets together."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {n for n in (disk.getAllFiles().apply(i).getName() for i in range(disk.getAllFiles().size())) if n.startswith("shuffle_")}
    there = held()
    counted = spark.range(0, 10_000, 1, 4).groupBy((F.col("id") % 100).alias("k")).count()
    publishing.publish(spark, {"counted": counted}, str(tmp_path / "out"))
    until = time.time() + 20
    while len(held() - there) > 2 and time.time() < until:  # the manifest's own counts may still be held
        time.sleep(0.2)
    assert len(held() - there) <= 2 and spark.conf.get(setting, None) == before


def test_payment_copies_are_dealt_once_below_a_join(spark):
    """The filter of a later join went into one branch only, and the rows were read, counted and dealt for each branch."""
    df = spark.range(3000).select((F.col("id") % 2000).alias("k"), (F.col("id") % 7).alias("owner"), F.col("id").cast("string").alias("x"))
    owners = spark.range(5).select(F.col("id").alias("owner"), F.lit("n").alias("name"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on tables too large to broadcast
    try:
        done = keep_one_per_key(df, ["k"]).join(owners, "owner").select("k", "x", "name")
        got = done.collect()
        final = done._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    smallest = {}
    for i in range(3000):
        smallest[i % 2000] = min(smallest.get(i % 2000, (9, "")), (i % 7, str(i)))
    assert sorted((r.k, r.x) for r in got) == sorted((k, x) for k, (o, x) in smallest.items() if o < 5)
    whole = [line for line in final.splitlines() if "+- Exchange hashpartitioning(struct(" in line or "+- Exchange hashpartitioning(named_struct(" in line]
    assert len(whole) == 2 and "ReusedExchange" in final  # the rows, and their keys with counts


def test_open_months_are_not_moved_one_by_one(spark):
    """Balances by month from spans equal those from open items, with unknown due dates and owners that are missing or come twice."""
    rng = random.Random(11)
    day = lambda i: date(2024, 6, 1) + timedelta(days=i)
    bills = []
    for i in range(600):
        at = rng.randrange(480)
        due = None if i % 50 == 0 else day(at + rng.choice([-200, 0, 20, 45]))
        bills.append((i, None if i % 40 == 0 else rng.randrange(12), day(at), due, False, Decimal(rng.randrange(1, 200))))
    pays = [(rng.randrange(600), day(rng.randrange(600)), Decimal(rng.choice([-20, 10, 50, 200]))) for _ in range(900)]
    b = spark.createDataFrame(bills, "bill_id int, customer_id int, bill_date date, due_date date, is_reversed boolean, total_amt decimal(14,2)")
    p = spark.createDataFrame(pays, "bill_id int, payment_date date, amount decimal(14,2)")
    who = spark.createDataFrame([(i % 10, f"s{i % 3}", "North") for i in range(11)], "customer_id int, segment string, division string")
    start, end = date(2024, 10, 1), date(2025, 9, 30)
    spans = receivables.open_spans(b, p, start, end)
    items = receivables.open_items(b, p, start, end)
    a, z = receivables.fact_ar_monthly(items, who), receivables.ar_monthly_of_spans(spans, who)
    assert a.dtypes == z.dtypes and not a.isEmpty() and a.exceptAll(z).isEmpty() and z.exceptAll(a).isEmpty()
    at = receivables.items_of_spans(receivables.spans_at(spans, end))
    now = items.filter(F.col("me") == F.lit(end))
    assert at.exceptAll(now).isEmpty() and now.exceptAll(at).isEmpty() and now.count() > 10
    plan = z._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(customer_id#" in plan and " _month#" not in "".join(x for x in plan.splitlines() if "hashpartitioning" in x)


def test_previous_rows_of_equal_order(spark):
    """A piece of rows that are equal in the order: the first of them takes the row of the piece before."""
    rows = [(1, 1, 5, "a"), (1, 2, 6, "b"), (1, 2, 6, "b"), (1, 3, 7, "c"), (None, 1, 1, "d"), (None, 2, 1, "e"), (2, 1, 1, "f")]
    df = spark.createDataFrame(rows, "k int, d int, id int, x string")
    got = previous_values(df, ["k"], ["d", "id"], {"was": "x"}, F.col("d"))
    assert got.columns == ["k", "d", "id", "x", "was"]
    assert sorted((r.x, r.was or "-") for r in got.collect()) == [("a", "-"), ("b", "a"), ("b", "b"), ("c", "b"), ("d", "-"), ("e", "d"), ("f", "-")]


def test_outages_stay_where_they_are(spark):
    """The calendar, a row a day, goes to the outages also where its size is not known."""
    days = spark.range(3).select(F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")).alias("date"), (F.col("id") == 1).alias("is_major_event_day"))
    outages = spark.range(30).select(F.col("id").alias("outage_id"), F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 4).cast("int")).alias("outage_date"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = fact_outage(outages, days)
        assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 23 and out.filter("is_major_event_day").count() == 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
