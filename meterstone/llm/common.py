"""Helpers shared by the text operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstone.session import scratch_path

#: The separators between words (fixed by the contracts: space, tab to carriage return).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as Parquet in the shared folder, read again: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_" + uuid.uuid4().hex[:4]
    return name


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the executors' Python workers this package, once for each application (``addPyFile`` distributes it)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    to = os.path.join(tempfile.mkdtemp(prefix="package-"), "package.zip")
    with zipfile.ZipFile(to, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith((".py", ".json", ".txt")):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    spark.sparkContext.addPyFile(to)
    _SHIPPED.add(app)


def arrow_map(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` whose workers can import this package."""
    ship(df.sparkSession)
    return df.mapInArrow(work, schema)


def id_type(df: DataFrame, col: str) -> str:
    return df.select(F.col(f"`{col}`")).schema[0].dataType.simpleString()


def slices(batches: Iterable[pa.RecordBatch], text: int = 1, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that column ``text`` holds about ``limit`` bytes a piece (one row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def map_text(df: DataFrame, id_col: str, text_col: str, work: Callable, schema: str) -> DataFrame:
    """``work`` (an iterator of Arrow batches to one of batches) over (id, text); null texts become empty.

    A narrow step: no shuffle, memory bounded by the slices ``work`` takes.
    """
    pair = df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return arrow_map(pair, work, schema)
