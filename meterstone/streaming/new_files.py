"""Curate files as they arrive.

The checkpoint remembers which files were taken, so every run loads exactly the
new ones. A file whose content changes under the same path is not taken again;
``streaming.changes`` covers changed and removed files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from meterstone.sources.contracts import MONTH_FOLDER
from meterstone.sources.lake import raw_options, raw_schema
from meterstone.sources.typing import apply_types


def curate_new_files(
    spark: SparkSession, raw_path: str, out_path: str, checkpoint: str, columns: Sequence[str], months: bool,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Start a run over all files present; it stops by itself when done."""
    raw = (
        raw_options(spark.readStream.schema(raw_schema(columns, months)))
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(raw_path)
    )
    out = apply_types(raw).writeStream.format("parquet").option("compression", "zstd")
    if months:
        out = out.partitionBy(MONTH_FOLDER)
    return (
        out.option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .outputMode("append")
        .start()
    )
