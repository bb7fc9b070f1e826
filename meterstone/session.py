"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What every run relies on: UTC naive time, ANSI errors instead of silent NULLs,
# adaptive plans that split skewed join partitions, text partition values.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.compression.codec": "zstd",
}


def local_session(cores: int | str = "*", app: str = "meterstone", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # a run over many datasets has more generated classes than the defaults keep
        .config("spark.sql.codegen.cache.maxEntries", "10000")
        .config("spark.driver.extraJavaOptions", "-XX:ReservedCodeCacheSize=512m")
    )
    for key, value in REQUIRED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Input bytes (as stored) that one shuffle partition stands for, and the shuffled bytes up to which small ones are joined.
INPUT_BYTES, JOINED_BYTES = 8 << 20, 16 << 20


def _bytes(size: str) -> int:
    """A size as Spark's settings give it (``64MB``, ``8m``, ``1024``)."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << (10 * " kmgtp".index(unit or " "))


def fit_partitions(spark: SparkSession, input_bytes: int) -> int:
    """Shuffle partitions of the session by the size of its input, never fewer than were set; returns the number.

    With a fixed number the rows of a task, and so the memory of its sorts and hash tables, grow with the input. Adaptive
    execution joins partitions that turn out small, so a number that is too large costs little; but it joins them up to its
    advisory size, whose default of 64 MB is more than a gigabyte of hash tables, so that size has a bound too.
    """
    setting, advisory = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    given = int(spark.conf.get(setting, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    needed = max(given, -(-input_bytes // INPUT_BYTES))
    if needed > given:
        spark.conf.set(setting, str(needed))
    if input_bytes > JOINED_BYTES and _bytes(spark.conf.get(advisory)) > JOINED_BYTES:
        spark.conf.set(advisory, str(JOINED_BYTES))
    return needed


# Fixed value: folders a task writes into at once.
WRITERS = 200


@contextmanager
def open_writers(spark: SparkSession) -> Iterator[None]:
    """Inside, a task that writes rows into folders keeps a file of each open and sorts only what goes beyond ``WRITERS`` folders.

    Without it every task first sorts all of its rows by folder, and spills them where they are larger than its memory.
    For row formats such as CSV, whose writers hold a small buffer.
    """
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(WRITERS))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it ends.

    Otherwise they stay until the driver happens to collect its garbage, so a job of many queries holds the files of all of them.
    A frame that runs a second time works them out again.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A local master (tests, bench) shares its own disk, so there one is set if none is named;
    on a cluster a missing name is an error, as no folder of the driver's own would be shared.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="meterstone-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"

