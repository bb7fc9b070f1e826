"""Ingest, profile, publish and ledger-step queries."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driver_tables.extracts import SETTINGS
from driver_tables.queries import register
from meterstone import Reports, Warehouse
from meterstone.operators.balances import as_of_month_ends, monthly_steps, reached_month
from meterstone.operators.profile import text_widths
from meterstone.plans.quality import key_audit, unique_key_violations
from meterstone.session import open_writers, scratch_path, shuffles_dropped
from meterstone.sources import lake
from meterstone.sources.contracts import EXTRACTS, RULE_OF, columns_of, has_months
from meterstone.plans.reports import PUBLISHED
from meterstone.sources.publish import dataset_sizes, publish
from meterstone.sources.typing import apply_types
from meterstone.sources.zone import Zone
from meterstone.streaming.changes import curate_noted, note_changes
from meterstone.streaming.new_files import curate_new_files

# Month column of the extracts that come in month folders.
_MONTH_OF = {"ERCH": "BUDAT", "DFKKZP": "BUDAT", "AUFK": "ERDAT", "interactions": "CREATED_TS", "daily_reads": "READ_DATE"}


def as_delivered(df: DataFrame) -> DataFrame:
    """Typed extract -> the text the source system sends (SAP dates, 0 for none, lost zeros)."""
    out = []
    for name in df.columns:
        rule, col = RULE_OF.get(name), F.col(name)
        if rule == "sap_date":
            text = F.coalesce(F.date_format(col, "yyyyMMdd"), F.lit("0"))
        elif rule == "sap_time":
            hms = F.floor(col / 3600) * 10000 + F.floor(col % 3600 / 60) * 100 + col % 60
            text = hms.cast("string")
        else:
            text = col.cast("string")
        out.append(text.alias(name))
    return df.select(*out)


def land(w, extract: str, path: str | None = None, without: str | None = None) -> str:
    """Write an extract (``without`` a month) as gzip CSV in month folders where it has them, in the place of what was there; return the folder."""
    name = extract.split("/")[1]
    df = w.src[name].select(*columns_of(extract))
    path = path or scratch_path(w.spark, f"raw-{name}")
    text = as_delivered(df)
    if has_months(extract):
        text = as_delivered(df.withColumn("_m", F.date_format(_MONTH_OF[name], "yyyy-MM"))).withColumnRenamed("_m", "year_month")
    if without:
        text = text.filter(F.col("year_month") != without)
    out = text.write.mode("overwrite").option("header", True).option("compression", "gzip").option("emptyValue", "")
    out = out.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    with open_writers(w.spark):
        (out.partitionBy("year_month") if has_months(extract) else out).csv(path)
    return path


def curated(w, extract: str) -> DataFrame:
    out = scratch_path(w.spark, "curated")
    lake.curate(w.spark, land(w, extract), out, columns_of(extract), has_months(extract))
    return lake.read_curated(w.spark, out)


def _typed(w, name: str) -> DataFrame:
    return apply_types(as_delivered(w.src[name]))


for _e in EXTRACTS:
    _n = _e.split("/")[1]
    register(f"typed_{_n.lower()}", lambda w, n=_n: _typed(w, n), f"SELECT * FROM {_n}",
             " ".join(x for x in columns_of(_e) if RULE_OF.get(x) == "double"))

register("curate_payments", lambda w: curated(w, "sap_isu/DFKKZP"),
         "SELECT *, strftime(BUDAT, '%Y-%m') AS year_month FROM DFKKZP")
register("curate_premises", lambda w: curated(w, "sap_isu/ADRC"), "SELECT * FROM ADRC", "GEO_LAT GEO_LON")
register("curate_pruned_month",
         lambda w: _pruned(w).groupBy("year_month").agg(F.count(F.lit(1)).alias("reads"), F.sum("KWH").alias("kwh")),
         """SELECT strftime(READ_DATE, '%Y-%m') AS year_month, count(*) AS reads, sum(KWH) AS kwh FROM daily_reads
            WHERE strftime(READ_DATE, '%Y-%m') = '2000-02' GROUP BY ALL""", "kwh")


def _pruned(w) -> DataFrame:
    out = scratch_path(w.spark, "curated")
    lake.curate(w.spark, land(w, "ami/daily_reads"), out, columns_of("ami/daily_reads"), True)
    return lake.read_curated(w.spark, out, ["2000-02"])


def reconciled(w) -> DataFrame:
    """Curate every extract and compare the written rows with the source counts."""
    source, got = {}, {}
    for extract in EXTRACTS:
        name = extract.split("/")[1]
        source[extract] = w.src[name].count()
        got[extract] = lake.curate(w.spark, land(w, extract), scratch_path(w.spark, "curated"), columns_of(extract),
                                   has_months(extract))
    manifest = scratch_path(w.spark, "manifest")
    lake.write_manifest(w.spark, manifest, got, source)
    return lake.reconcile(lake.manifest_frame(w.spark, source), lake.read_manifest(w.spark, manifest))


register("reconcile_manifest", reconciled, "\nUNION ALL ".join(
    f"SELECT '{e}' AS table_name, count(*) AS rows_expected, count(*) AS rows_loaded, 'ok' AS status FROM {e.split('/')[1]}"
    for e in EXTRACTS))


def incremental(w) -> DataFrame:
    """Files to load: none of the logged ones, the changed and the new ones (by month folder)."""
    path = land(w, "crm/interactions")
    listing = lake.file_listing(w.spark, path, "*.csv.gz").withColumn("month", F.regexp_extract("path", "year_month=([0-9-]+)", 1))
    log = listing.filter(F.col("month") < "2001-01").select(
        "path", F.when(F.col("month") == "2000-06", F.col("length") + 1).otherwise(F.col("length")).alias("length"))
    return lake.files_to_load(listing, log).select("month").distinct()


register("incremental_ingest", incremental, """
    SELECT DISTINCT strftime(CREATED_TS, '%Y-%m') AS month FROM interactions
    WHERE strftime(CREATED_TS, '%Y-%m') >= '2001-01' OR strftime(CREATED_TS, '%Y-%m') = '2000-06'""")


def streamed(w) -> DataFrame:
    out = scratch_path(w.spark, "stream")
    extract = "sap_isu/ERCH"
    curate_new_files(w.spark, land(w, extract), out, scratch_path(w.spark, "ckpt"), columns_of(extract), True).awaitTermination()
    return lake.read_curated(w.spark, out).groupBy("year_month").agg(
        F.count(F.lit(1)).alias("bills"), F.sum("TOTAL_AMT").alias("total_amt"))


register("stream_new_files", streamed, """
    SELECT strftime(BUDAT, '%Y-%m') AS year_month, count(*) AS bills, sum(TOTAL_AMT)::decimal(24,2) AS total_amt
    FROM ERCH GROUP BY ALL""")


def streamed_changes(w) -> DataFrame:
    """Payments arrive, then June is sent again twice as long and July leaves: both come through the stream of changes."""
    raw, root, journal, checkpoint = (scratch_path(w.spark, x) for x in ("raw", "lake", "journal", "ckpt"))
    extract = "sap_isu/DFKKZP"
    contracts = {extract: (columns_of(extract), True)}
    land(w, extract, f"{raw}/{extract}")
    note_changes(w.spark, raw, [extract], journal)
    curate_noted(w.spark, journal, raw, root, checkpoint, contracts).awaitTermination()
    land(w, extract, f"{raw}/{extract}", without="2000-07")
    _send(_june(w).unionAll(_june(w)), f"{raw}/{extract}/year_month=2000-06")
    note_changes(w.spark, raw, [extract], journal)
    curate_noted(w.spark, journal, raw, root, checkpoint, contracts).awaitTermination()
    return Zone(w.spark, root).read(extract)


register("stream_changed_files", streamed_changes,
         """SELECT *, strftime(BUDAT, '%Y-%m') AS year_month FROM DFKKZP WHERE strftime(BUDAT, '%Y-%m') <> '2000-07'
            UNION ALL SELECT *, strftime(BUDAT, '%Y-%m') AS year_month FROM DFKKZP WHERE strftime(BUDAT, '%Y-%m') = '2000-06'""")

_INGESTED = ("sap_isu/ADRC", "sap_isu/DFKKZP", "crm/interactions")


def _contracts():
    return {e: (columns_of(e), has_months(e)) for e in _INGESTED}


def _send(df: DataFrame, path: str) -> None:
    """Text files in the place of what a raw folder had."""
    (df.write.mode("overwrite").option("header", True).option("compression", "gzip").option("emptyValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def first_load(w) -> tuple[str, str]:
    """Three extracts (a small one, two in months) curated and logged: raw folder and zone."""
    raw, root = scratch_path(w.spark, "raw"), scratch_path(w.spark, "lake")
    counts = {}
    for extract in _INGESTED:
        land(w, extract, f"{raw}/{extract}")
        counts[extract] = w.src[extract.split("/")[1]].count()
    lake.curate_all(w.spark, raw, root, _contracts(), counts)
    return raw, root


def _june(w) -> DataFrame:
    sent = w.src["DFKKZP"].withColumn("_m", F.date_format("BUDAT", "yyyy-MM")).filter("_m = '2000-06'").drop("_m")
    return as_delivered(sent.select(*columns_of("sap_isu/DFKKZP")))


def ingested(w) -> tuple[DataFrame, DataFrame]:
    """A month's file of payments is sent anew, twice as long, and only that month loads again."""
    raw, root = first_load(w)
    _send(_june(w).unionAll(_june(w)), f"{raw}/sap_isu/DFKKZP/year_month=2000-06")
    lake.curate_changed(w.spark, raw, root, _contracts())
    return Zone(w.spark, root).read("sap_isu/DFKKZP"), w.spark.read.parquet(f"{root}/load_log")


def month_removed(w) -> DataFrame:
    """The payments are delivered again without June: its rows leave the next version and stay in the first."""
    raw, root = first_load(w)
    land(w, "sap_isu/DFKKZP", f"{raw}/sap_isu/DFKKZP", without="2000-06")
    lake.curate_changed(w.spark, raw, root, _contracts())
    zone, june = Zone(w.spark, root), F.count_if(F.col("year_month") == "2000-06").alias("june")
    rows = lambda v: zone.read("sap_isu/DFKKZP", version=v).agg(F.lit(v).cast("long").alias("version"), F.count(F.lit(1)).alias("rows"), june, F.sum("BETRZ").alias("amount"))
    return rows(1).unionByName(rows(2))


def load_interrupted(w) -> DataFrame:
    """A load that stops after its data and file log are written, before the commit: the version read is the old one."""
    raw, root = first_load(w)
    zone = Zone(w.spark, root)
    before, load = zone.snapshot(), zone.new_load()
    june = apply_types(_june(w).withColumn("year_month", F.lit("2000-06")))
    zone.stage(load, "sap_isu/DFKKZP", june.unionAll(june))
    zone.log_files(load, zone.files(before), before.version + 1)
    return zone.read("sap_isu/DFKKZP")


_SUMS = "count(*) AS rows, count(*) FILTER (strftime(BUDAT, '%Y-%m') = '2000-06') AS june, sum(BETRZ)::decimal(24,2) AS amount"
register("ingest_removed_month", month_removed,
         f"""SELECT 1::bigint AS version, {_SUMS} FROM DFKKZP
            UNION ALL SELECT 2, {_SUMS} FROM DFKKZP WHERE strftime(BUDAT, '%Y-%m') <> '2000-06'""")
register("ingest_interrupted", load_interrupted, "SELECT *, strftime(BUDAT, '%Y-%m') AS year_month FROM DFKKZP")
register("ingest_payments", lambda w: ingested(w)[0],
         """SELECT *, strftime(BUDAT, '%Y-%m') AS year_month FROM DFKKZP
            UNION ALL SELECT *, strftime(BUDAT, '%Y-%m') AS year_month FROM DFKKZP WHERE strftime(BUDAT, '%Y-%m') = '2000-06'""")
register("load_log", lambda w: ingested(w)[1].select("table_name", "rows_expected", "rows_loaded", "status", (F.col("finished_at") >= F.col("started_at")).alias("in_order")),
         "\nUNION ALL ".join(f"SELECT '{e}' AS table_name, count(*) AS rows_expected, count(*) AS rows_loaded, 'ok' AS status, true AS in_order FROM {e.split('/')[1]}"
                             for e in _INGESTED)
         + "\nUNION ALL SELECT 'sap_isu/DFKKZP', 2 * count(*), 2 * count(*), 'ok', true FROM DFKKZP WHERE strftime(BUDAT, '%Y-%m') = '2000-06'")

_TEXTS = ("TYPE", "BU_GROUP", "NAME_FIRST", "NAME_LAST", "NAME_ORG1", "SMTP_ADDR", "TEL_NUMBER")
register("column_profile", lambda w: text_widths(w.src["BUT000"]), "\nUNION ALL ".join(
    f"""SELECT '{t}' AS column_name, max(length({t}))::int AS max_length,
        least(greatest(8, ceil(greatest(coalesce(max(length({t})), 1), 1) / 10.0) * 10), 8000)::int AS width FROM BUT000""" for t in _TEXTS))

#: What several published datasets are made from.
_SHARED = ("dim_premise", "dim_customer", "owned_payments", "open_spans", "fact_ar_customer")
#: What the datasets made from payments read of them.
_READ = {"owned_payments": ("bill_id", "payment_date", "payment_month", "amount", "channel", "segment", "division")}


def stored_reports(w) -> Reports:
    """Reports over a warehouse whose shared tables are worked out once and read from files."""
    with shuffles_dropped(w.spark):
        stored = Warehouse(w.spark, w.src, w.cfg).store(scratch_path(w.spark, "shared"), _SHARED, only=_READ)
        return Reports(stored).store(scratch_path(w.spark, "shared"), ["revenue_monthly"])


def published(w) -> DataFrame:
    """Every published dataset; an earlier publication's other dataset goes, a foreign folder stays."""
    r, folder = stored_reports(w), scratch_path(w.spark, "published")
    w.spark.range(1).coalesce(1).write.parquet(f"{folder}/not_ours")
    publish(w.spark, {"division": r.division, "rate_list": w.dim_rate}, folder)
    out = publish(w.spark, {n: getattr(r, n) for n in PUBLISHED}, folder)
    left = dataset_sizes(w.spark, folder).filter(F.col("dataset").isin("not_ours", "rate_list")).select(
        "dataset", F.col("files").cast("bigint").alias("rows"), F.lit(-1).alias("columns"))
    return out.select("dataset", "rows", "columns").unionByName(left)


# Check block and number of columns of each published dataset.
_BLOCKS = {
    "dim_period": ("r_period", 9), "date_daily": ("r_date", 19), "division": ("r_division", 4), "revenue_residential_monthly": ("r_revenue_res", 18),
    "revenue_commercial_monthly": ("r_revenue_com", 18), "ar_aging_monthly": ("w_ar_monthly", 9), "ar_top_accounts": ("r_ar_top", 18),
    "payments_monthly": ("r_payments", 6), "digital_adoption_monthly": ("r_adoption", 6), "ami_daily_profile": ("r_ami", 10),
    "reliability_events": ("r_outages", 14), "work_orders_monthly": ("r_work_orders", 12), "work_order_backlog": ("r_backlog", 18),
    "contact_center_daily": ("r_contacts", 16), "collections_orders_monthly": ("r_collections", 9), "moratorium_compliance": ("r_moratorium", 4),
    "payment_plans_monthly": ("r_plans", 10), "billing_exceptions_monthly": ("r_exceptions", 10), "rebills_monthly": ("r_rebills", 3),
    "service_orders_monthly": ("r_service", 10), "customer_360": ("r_customer_360", 31), "customer_bills_recent": ("r_bills_recent", 14), "data_quality": ("r_dq", 7),
}
register("publish_manifest", published, "\nUNION ALL ".join(
    f"SELECT '{n}' AS dataset, count(*) AS rows, {columns}::int AS columns FROM {b}" for n, (b, columns) in _BLOCKS.items())
    + "\nUNION ALL SELECT 'not_ours', 1, -1")

# ledger steps on their own
_steps = lambda w: monthly_steps(w.fact_payment, "bill_id", "payment_date", "amount")
register("payments_cumulative", lambda w: _steps(w).select("bill_id", "me", F.col("cum_paid").cast("decimal(38,2)").alias("cum_paid")),
         "SELECT bill_id, me, cum_paid::decimal(38,2) AS cum_paid FROM w_steps")
register("paid_month", lambda w: reached_month(_steps(w), w.fact_bill, "bill_id", "total_amt", Decimal("0.005")),
         "SELECT bill_id, paid_me FROM w_paid")
register("asof_paid",
         lambda w: as_of_month_ends(_steps(w), "bill_id", SETTINGS.window_start, SETTINGS.window_end)
         .select("bill_id", "month_end", F.col("cum_paid").cast("decimal(38,2)").alias("cum_paid")),
         """SELECT b.bill_id, b.me AS month_end, s.cum_paid::decimal(38,2) AS cum_paid
            FROM (SELECT bill_id, me FROM (SELECT DISTINCT bill_id FROM w_steps) x, w_month_ends) b
            ASOF JOIN w_steps s ON s.bill_id = b.bill_id AND s.me <= b.me""")
register("duplicate_keys", lambda w: unique_key_violations(w.fact_work_order, ["work_order_id"]),
         "SELECT work_order_id, count(*) AS rows FROM w_work_order GROUP BY ALL HAVING count(*) > 1")
_KEYED = {"dim_date": ("w_date", "date"), "dim_rate": ("s_rate", "rate_code"), "dim_premise": ("w_premise", "premise_id"),
          "dim_geography": ("w_geography", "city"), "dim_customer": ("w_customer", "customer_id"),
          "fact_ar_customer": ("w_ar_customer", "customer_id"), "fact_outage": ("w_outage", "outage_id")}
register("key_audit", key_audit, "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows, count(*) - count(DISTINCT {k}) AS violations FROM {b}" for t, (b, k) in _KEYED.items()))
