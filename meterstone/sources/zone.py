"""The curated zone as numbered versions: data folders that never change, and one small record that says which of them count.

    <root>/data/<load>/<table>/part=<month>/...   rows of a load, written once
    <root>/files/<load>/...                       source files of a load, removed ones as tombstones
    <root>/snapshots/<version>/...                one JSON file, a line a table: parts, their rows, loads, schema

A load writes its data beside everything else, compares counts, and then adds the next snapshot. The snapshot is one file
that appears by a single commit, so readers see the old version or the new one, for all tables alike; a load that stops
anywhere before leaves only folders nobody reads. Nothing is renamed or overwritten, which object stores would not do
at once. Two loads at a time get the same version number, and the second one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from meterstone.sources.contracts import MONTH_FOLDER

SNAPSHOT = "version long, table string, schema string, parts array<struct<part: string, folder: string, rows: bigint>>, loads array<string>, marks map<string, bigint>"
FILE_LOG = "table string, path string, length long, modified timestamp, removed boolean, version long"
#: File logs of so many loads are folded into one.
FOLD = 16
WHOLE = "all"


@dataclass(frozen=True)
class Part:
    folder: str
    rows: int


@dataclass(frozen=True)
class TableState:
    schema: StructType
    parts: Mapping[str, Part] = field(default_factory=dict)


@dataclass(frozen=True)
class Snapshot:
    version: int
    tables: Mapping[str, TableState]
    loads: tuple[str, ...]
    marks: Mapping[str, int] = field(default_factory=dict)  # the last batch of each stream that is in this version


class Zone:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The latest version, or an older one. A zone nothing was loaded into is version 0."""
        try:
            lines = self.spark.read.schema(SNAPSHOT).option("recursiveFileLookup", True).json(f"{self.root}/snapshots")
            wanted = version if version is not None else lines.agg(F.max("version")).first()[0]
            rows = lines.filter(F.col("version") == wanted).collect() if wanted else []
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            rows = []
        if version and not rows:
            raise ValueError(f"no version {version}")
        tables = {r.table: TableState(StructType.fromJson(json.loads(r.schema)), {p.part: Part(p.folder, p.rows) for p in r.parts}) for r in rows}
        return Snapshot(rows[0].version if rows else 0, tables, tuple(rows[0].loads) if rows else (), dict(rows[0].marks or {}) if rows else {})

    def read(self, table: str, months: Sequence[str] | None = None, version: int | None = None) -> DataFrame:
        """Rows of a table; ``months`` opens the folders of these months only. A table whose files were all removed is empty."""
        state = self.snapshot(version).tables[table]
        folders = [p.folder for name, p in sorted(state.parts.items()) if months is None or name in months]
        if not folders:
            return self.spark.createDataFrame([], state.schema)
        return self.spark.read.schema(state.schema).parquet(*folders)

    def new_load(self) -> str:
        return uuid.uuid4().hex

    def stage(self, load: str, table: str, rows: DataFrame) -> TableState:
        """Write rows of a table below a load. Nothing reads them before ``commit``. Counts are those of the written files.

        The rebalance hint splits a month that holds most rows, so no task writes a whole month alone.
        """
        path = f"{self.root}/data/{load}/{table}"
        part = F.col(MONTH_FOLDER) if MONTH_FOLDER in rows.columns else F.lit(WHOLE)
        out = rows.withColumn("part", part).hint("rebalance", "part")
        out.write.partitionBy("part").option("compression", "zstd").parquet(path)
        named = StructType([*rows.schema.fields, StructField("part", StringType())])
        found = self.spark.read.schema(named).parquet(path).groupBy("part").count().collect()
        return TableState(rows.schema, {r.part: Part(f"{path}/part={r.part}", r["count"]) for r in found})

    def log_files(self, load: str, files: DataFrame, version: int) -> None:
        """Source files of a load (table, path, length, modified, removed)."""
        files.select("table", "path", "length", "modified", "removed", F.lit(version).cast("long").alias("version")).write.parquet(f"{self.root}/files/{load}")

    def files(self, snapshot: Snapshot) -> DataFrame:
        """Files that a version was loaded from: the last record of each path, without removed ones."""
        if not snapshot.loads:
            return self.spark.createDataFrame([], FILE_LOG)
        log = self.spark.read.schema(FILE_LOG).parquet(*[f"{self.root}/files/{x}" for x in snapshot.loads])
        last = log.groupBy("table", "path").agg(F.max_by(F.struct("length", "modified", "removed", "version"), "version").alias("v"))
        return last.select("table", "path", "v.*").filter(~F.col("removed"))

    def commit(self, before: Snapshot, changed: Mapping[str, TableState], load: str, marks: Mapping[str, int] | None = None) -> Snapshot:
        """Make ``changed`` tables, and the file log of ``load``, part of the next version; other tables stay as they were.

        ``marks`` names the stream and batch the version comes from, so that a batch that runs again can see it was done.
        """
        loads = (*before.loads, load)
        version = before.version + 1
        if len(loads) > FOLD:
            folded = self.new_load()
            known = self.files(Snapshot(version, {}, loads))
            known.write.parquet(f"{self.root}/files/{folded}")
            loads = (folded,)
        tables, marks = {**before.tables, **changed}, {**before.marks, **(marks or {})}
        rows = [(version, name, t.schema.json(), [(k, p.folder, p.rows) for k, p in sorted(t.parts.items())], list(loads), marks) for name, t in sorted(tables.items())]
        one = self.spark.createDataFrame(rows, SNAPSHOT).coalesce(1)
        one.write.mode("error").json(f"{self.root}/snapshots/{version:08d}")  # fails if another load took the number
        return Snapshot(version, tables, loads, marks)
