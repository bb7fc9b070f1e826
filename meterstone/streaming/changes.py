"""A stream of file changes: new, changed and removed files reach the zone batch by batch.

A file stream takes every path once, so a file that is sent again under its old name would be missed. Here changes are
noted in a journal, a folder of small files that only grows, and the stream reads the journal. A batch reads the months its
entries belong to anew from the files they have now, and commits them as one version that carries the batch's number. A batch that
runs again after a crash finds its number in the zone and does nothing, or finds it missing and does the work again
beside what the crash left.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterstone.sources.contracts import MONTH_FOLDER
from meterstone.sources.lake import Contract, ReconciliationError, file_listing, load_months
from meterstone.sources.zone import Zone

ENTRY = "table string, path string, length long, modified timestamp, removed boolean, noted_at timestamp"


def noted(spark: SparkSession, journal: str) -> DataFrame:
    """What the journal says about every file last, removed ones included."""
    try:
        entries = spark.read.schema(ENTRY).json(journal)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        entries = spark.createDataFrame([], ENTRY)
    last = entries.groupBy("table", "path").agg(F.max_by(F.struct("length", "modified", "removed"), "noted_at").alias("v"))
    return last.select("table", "path", "v.*")


def note_changes(spark: SparkSession, raw: str, tables: list[str], journal: str) -> None:
    """Compare the files below ``raw`` with the journal and append what is new, changed or removed as one entry file.

    Files are listed, not read. Safe to run again at any time: without changes nothing is appended that a batch would act on twice.
    """
    known = noted(spark, journal).filter(F.col("table").isin(tables))
    now = None
    for table in tables:
        one = file_listing(spark, f"{raw}/{table}", "*.csv*").select(F.lit(table).alias("table"), "path", "length", "modified")
        now = one if now is None else now.unionByName(one)
    present = known.filter(~F.col("removed"))
    changed = now.join(present, ["table", "path", "length", "modified"], "left_anti").withColumn("removed", F.lit(False))
    gone = present.join(now, ["table", "path"], "left_anti").withColumn("removed", F.lit(True))
    entries = changed.unionByName(gone).withColumn("noted_at", F.current_timestamp())
    if not entries.isEmpty():
        entries.coalesce(1).write.mode("append").json(journal)


def apply_batch(entries: DataFrame, batch: int, raw: str, root: str, contracts: Mapping[str, Contract], stream: str) -> bool:
    """The months that ``entries`` touch, as one version of the zone; False if the zone has this batch already."""
    spark = entries.sparkSession
    zone = Zone(spark, root)
    before, load = zone.snapshot(), zone.new_load()
    if before.marks.get(stream, -1) >= batch:
        return False
    month = F.regexp_extract("path", f"{MONTH_FOLDER}=([^/]+)", 1)
    due: dict[str, set[str]] = {}
    for r in entries.select("table", month.alias("month")).distinct().collect():  # a row a touched month
        due.setdefault(r.table, set()).add(r.month)
    states = {}
    for table, touched in sorted(due.items()):
        columns, months = contracts[table]
        states[table], expected, loaded = load_months(zone, before, load, f"{raw}/{table}", table, columns, months, touched)
        if loaded != expected:
            raise ReconciliationError(f"row count mismatch: {table}")
    zone.log_files(load, entries.select("table", "path", "length", "modified", "removed"), before.version + 1)
    zone.commit(before, states, load, {stream: batch})
    return True


def curate_noted(
    spark: SparkSession, journal: str, raw: str, root: str, checkpoint: str, contracts: Mapping[str, Contract], stream: str | None = None,
    entry_files_per_batch: int = 100,
) -> StreamingQuery:
    """Start a run over all journal entries not yet taken; it stops by itself when done. ``stream`` names it in the zone."""
    name = stream or checkpoint
    entries = spark.readStream.schema(ENTRY).option("maxFilesPerTrigger", entry_files_per_batch).json(journal)
    return (
        entries.writeStream.foreachBatch(lambda rows, batch: apply_batch(rows, batch, raw, root, contracts, name))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
