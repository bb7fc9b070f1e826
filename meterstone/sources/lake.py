"""Raw zone -> curated zone, with reconciliation, audit and incremental listing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from meterstone.sources.contracts import MONTH_FOLDER
from meterstone.sources.typing import apply_types
from meterstone.sources.zone import Snapshot, TableState, Zone

LOG_SCHEMA = (
    "table_name string, source_path string, source_files bigint, rows_expected bigint, rows_loaded bigint, "
    "started_at timestamp_ntz, finished_at timestamp_ntz, status string"
)


class ReconciliationError(RuntimeError):
    """Written rows differ from the manifest."""


def raw_schema(columns: Sequence[str], months: bool) -> StructType:
    names = [*columns, *([MONTH_FOLDER] if months else [])]
    return StructType([StructField(n, StringType()) for n in names])


def raw_options(reader):
    """How raw files are read, in batches and streams alike: text as delivered, a header that must match, no short rows."""
    return (
        reader.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("escape", '"')
    )


def read_raw(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], months: bool, base: str | None = None) -> DataFrame:
    """CSV (gzip or plain) with header, every value text exactly as delivered.

    The header is checked against the given columns. Month folders become the
    text column ``year_month`` and prune by it; for single files ``base`` names
    the folder the month folders lie in.
    """
    reader = raw_options(spark.read.schema(raw_schema(columns, months)))
    return (reader.option("basePath", base) if base else reader).csv(path if isinstance(path, str) else list(path))


def write_curated(df: DataFrame, path: str, months: bool, only_given_months: bool = False) -> None:
    """Replace the table (or only the months present) as zstd Parquet.

    The rebalance hint sizes files at run time and splits a month that holds
    most of the rows, so no task writes a whole month alone.
    """
    if months:
        out = df.hint("rebalance", MONTH_FOLDER).write.partitionBy(MONTH_FOLDER)
        out = out.option("partitionOverwriteMode", "dynamic" if only_given_months else "static")
    else:
        out = df.hint("rebalance").write
    out.mode("overwrite").option("compression", "zstd").parquet(path)


def read_curated(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> DataFrame:
    """Curated table; ``months`` reads only those folders.

    The month stays text (``2024-10``) whatever the session infers for partition
    values.
    """
    found = spark.read.parquet(path).schema
    if MONTH_FOLDER not in found.names:
        return spark.read.schema(found).parquet(path)
    as_text = StructType([StructField(f.name, StringType() if f.name == MONTH_FOLDER else f.dataType) for f in found.fields])
    df = spark.read.schema(as_text).parquet(path)
    return df.filter(F.col(MONTH_FOLDER).isin(*months)) if months else df


def curate(spark: SparkSession, raw_path: str, out_path: str, columns: Sequence[str], months: bool) -> int:
    """Type one extract, replace its curated table, return the rows in the written files."""
    write_curated(apply_types(read_raw(spark, raw_path, columns, months)), out_path, months)
    return spark.read.parquet(out_path).count()


def manifest_frame(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    return spark.createDataFrame(sorted(counts.items()), "table_name string, row_count bigint")


def reconcile(expected: DataFrame, got: DataFrame) -> DataFrame:
    """Expected and written row counts side by side with a status."""
    g = got.withColumnRenamed("row_count", "rows_loaded")
    e = expected.withColumnRenamed("row_count", "rows_expected")
    same = F.coalesce(F.col("rows_loaded") == F.col("rows_expected"), F.lit(False))
    return e.join(g, "table_name", "left").withColumn("status", F.when(same, "ok").otherwise("MISMATCH"))


def require_match(report: DataFrame) -> None:
    wrong = [r.table_name for r in report.filter(F.col("status") != "ok").select("table_name").collect()]
    if wrong:
        raise ReconciliationError(f"row count mismatch: {', '.join(sorted(wrong))}")


def write_manifest(spark: SparkSession, path: str, counts: Mapping[str, int], source: Mapping[str, int]) -> None:
    """One JSON row: {source: {...}, row_counts: {...}}."""
    row = [({k: int(v) for k, v in source.items()}, {k: int(v) for k, v in counts.items()})]
    frame = spark.createDataFrame(row, "source map<string,bigint>, row_counts map<string,bigint>")
    frame.write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema("row_counts map<string,bigint>").json(path)
    return rows.select(F.explode("row_counts").alias("table_name", "row_count"))


def file_listing(spark: SparkSession, folder: str | list[str], pattern: str = "*") -> DataFrame:
    """path, length, modified of every file below a folder (or several). File contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )


def files_to_load(listing: DataFrame, log: DataFrame) -> DataFrame:
    """Files that are new or whose size changed since they were logged."""
    return listing.join(log.select("path", "length"), ["path", "length"], "left_anti")


def append_load_log(spark: SparkSession, path: str, table: str, source: str, files: int, expected: int, loaded: int,
                    started: datetime, finished: datetime) -> DataFrame:
    """Append one audit row and return the log."""
    status = "ok" if expected == loaded else "MISMATCH"
    whole = lambda t: t.replace(microsecond=0)
    row = [(table, source, files, expected, loaded, whole(started), whole(finished), status)]
    spark.createDataFrame(row, LOG_SCHEMA).write.mode("append").parquet(path)
    return spark.read.parquet(path)


Contract = tuple[Sequence[str], bool]


def curate_all(spark: SparkSession, raw: str, root: str, contracts: Mapping[str, Contract], expected: Mapping[str, int]) -> DataFrame:
    """Curate every table, compare with the source counts, write manifest and log; abort on a difference.

    All tables become the next version of the zone (``Zone``) together, and only after all counts match, so a failed run leaves the
    old version. Every load is logged with measured counts and times, failed ones too. The listing of files is
    taken before reading, so a file that changes meanwhile counts as changed afterwards.
    """
    zone = Zone(spark, root)
    before, load = zone.snapshot(), zone.new_load()
    got, states, listings = {}, {}, []
    for table, (columns, months) in contracts.items():
        started = datetime.now()
        files = _listed(spark, raw, table)
        listings += files
        states[table] = zone.stage(load, table, apply_types(read_raw(spark, f"{raw}/{table}", columns, months)))
        got[table] = sum(p.rows for p in states[table].parts.values())
        append_load_log(spark, f"{root}/load_log", table, f"{raw}/{table}", len(files), expected.get(table, -1), got[table], started, datetime.now())
    report = reconcile(manifest_frame(spark, expected), manifest_frame(spark, got))
    require_match(report)
    write_manifest(spark, f"{root}/manifest", got, expected)
    now = spark.createDataFrame(listings, LISTED)
    # files an earlier version knew and this one did not find
    gone = zone.files(before).join(now, ["table", "path"], "left_anti").withColumn("removed", F.lit(True)).select(*now.columns)
    zone.log_files(load, now.unionByName(gone), before.version + 1)
    zone.commit(before, states, load)
    return report


LISTED = "table string, path string, length long, modified timestamp, removed boolean"


def _listed(spark: SparkSession, raw: str, table: str) -> list[tuple]:
    """The files of a table as they are now, as plain rows: names and sizes only, a row a file."""
    return [(table, r.path, r.length, r.modified, False) for r in file_listing(spark, f"{raw}/{table}", "*.csv*").collect()]


def load_months(
    zone: Zone, before: Snapshot, load: str, source: str, table: str, columns: Sequence[str], months: bool, due: Iterable[str]
) -> tuple[TableState, int, int]:
    """Months of a table (the whole table where there are none) read anew from the files they have now, staged below ``load``.

    Returns the table's next state, the rows read and the rows written.
    """
    due = sorted(due)
    rows = read_raw(zone.spark, source, columns, months)
    rows = rows.filter(F.col(MONTH_FOLDER).isin(due)) if months else rows
    expected = rows.count()
    fresh = zone.stage(load, table, apply_types(rows))
    old = before.tables[table].parts if table in before.tables and months else {}
    state = TableState(fresh.schema, {**{k: p for k, p in old.items() if k not in due}, **fresh.parts})
    return state, expected, sum(p.rows for p in fresh.parts.values())


def curate_changed(spark: SparkSession, raw: str, root: str, contracts: Mapping[str, Contract]) -> list[str]:
    """Load what is new, changed or removed since the last version, by whole months (whole tables where there are none).

    A month that any such file belongs to is read anew from the files it has now, so a changed file never adds to what it sent
    before and a month without files is empty. Counts are compared before the next version is committed; a
    difference, or a stop anywhere, leaves the old version, and the next call does the work again. Removed files are
    logged as such, so they count once. Returns the tables touched.
    """
    zone = Zone(spark, root)
    before, load = zone.snapshot(), zone.new_load()
    known = zone.files(before)
    month = F.regexp_extract("path", f"{MONTH_FOLDER}=([^/]+)", 1)
    states, logs = {}, []
    for table, (columns, months) in contracts.items():
        started = datetime.now()
        listing = spark.createDataFrame(_listed(spark, raw, table), LISTED)
        own = known.filter(F.col("table") == table)
        changed = listing.join(own, ["path", "length", "modified"], "left_anti").select(*listing.columns)
        gone = own.join(listing, "path", "left_anti").select("table", "path", "length", "modified", F.lit(True).alias("removed"))
        touched = changed.unionByName(gone).withColumn("month", month).collect()
        if not touched:
            continue
        states[table], expected, loaded = load_months(zone, before, load, f"{raw}/{table}", table, columns, months, {r.month for r in touched})
        append_load_log(spark, f"{root}/load_log", table, f"{raw}/{table}", sum(not r.removed for r in touched), expected, loaded, started, datetime.now())
        if loaded != expected:
            raise ReconciliationError(f"row count mismatch: {table}")
        logs += [tuple(r)[:5] for r in touched]
    if states:
        zone.log_files(load, spark.createDataFrame(logs, LISTED), before.version + 1)
        zone.commit(before, states, load)
    return list(states)
