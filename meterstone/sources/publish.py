"""Publishing datasets as Parquet with a manifest."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstone.session import shuffles_dropped
from meterstone.sources.lake import file_listing

# Fixed value: no published file may exceed this.
MAX_FILE_MB = 90
MANIFEST = "_manifest"


class FileTooLargeError(RuntimeError):
    """A published file exceeds the limit."""


def publish(spark: SparkSession, datasets: Mapping[str, DataFrame], folder: str, target_mb: int = 60) -> DataFrame:
    """Write every dataset, check file sizes, swap them in, remove what an earlier publication left, return the manifest.

    Manifest: dataset, rows, columns, files, mb; it is stored as ``_manifest`` and names the datasets that
    are this function's own. Everything is written beside the present files and takes its place
    only after all checks, so a failure leaves the old publication. Files are cut by measured bytes: a
    dataset whose first writing has a file above ``target_mb`` is written again with as many rows a file as
    its measured bytes a row allow. The limit is asserted before the swap. No row is moved for the sake of the files, and
    the shuffle files of a dataset go as soon as it is written.
    """
    with shuffles_dropped(spark):
        return _publish(spark, datasets, folder, target_mb)


def _publish(spark: SparkSession, datasets: Mapping[str, DataFrame], folder: str, target_mb: int) -> DataFrame:
    base = folder.rstrip("/")
    fresh = f"{base}/_next"
    widths = []
    for name, df in datasets.items():
        _write(df, f"{fresh}/{name}")
        widths.append((name, len(df.columns)))
    for r in dataset_sizes(spark, fresh).filter(F.col("largest") > target_mb * 1_000_000).collect():
        once = spark.read.parquet(f"{fresh}/{r.dataset}")
        per_file = max(1, int(once.count() * target_mb * 1_000_000 / r.bytes))
        _write(once, f"{fresh}/_cut_{r.dataset}", per_file)
        replace_folder(spark, f"{fresh}/_cut_{r.dataset}", f"{fresh}/{r.dataset}")
    sizes = dataset_sizes(spark, fresh)
    too_large = sizes.filter(F.col("largest") > MAX_FILE_MB * 1_000_000).select("dataset").collect()
    if too_large:
        raise FileTooLargeError(", ".join(sorted(r.dataset for r in too_large)))
    rows = reduce(DataFrame.unionByName, [
        spark.read.parquet(f"{fresh}/{n}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("dataset"), "rows")
        for n in datasets
    ])
    cols = spark.createDataFrame(widths, "dataset string, columns int")
    manifest = rows.join(cols, "dataset").join(sizes, "dataset", "left").select(
        "dataset", "rows", "columns", "files", F.round(F.col("bytes") / 1e6, 2).alias("mb")
    ).collect()
    manifest = spark.createDataFrame(manifest, "dataset string, rows long, columns int, files long, mb double")
    before = own_datasets(spark, base)
    for name in datasets:
        replace_folder(spark, f"{fresh}/{name}", f"{base}/{name}")
    remove(spark, base, before - set(datasets))
    manifest.coalesce(1).write.mode("overwrite").json(f"{base}/{MANIFEST}")
    return manifest


def _write(df: DataFrame, path: str, per_file: int = 0) -> None:
    (df.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", per_file).parquet(path))


def own_datasets(spark: SparkSession, folder: str) -> set[str]:
    """What the last publication wrote, by its stored manifest."""
    if not folder_exists(spark, f"{folder}/{MANIFEST}"):
        return set()
    return {r.dataset for r in spark.read.schema("dataset string").json(f"{folder}/{MANIFEST}").collect()}


def dataset_sizes(spark: SparkSession, folder: str) -> DataFrame:
    listing = file_listing(spark, folder, "*.parquet")
    name = F.element_at(F.split("path", "/"), -2)
    return listing.groupBy(name.alias("dataset")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("length").alias("largest")
    )


def _files(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _moved(files, source, target) -> bool:
    try:
        return files.rename(source, target)
    except Py4JJavaError:  # some file systems raise where others say false
        return False


def replace_folder(spark: SparkSession, fresh: str, old: str) -> None:
    """Puts the folder ``fresh`` in the place of ``old``: two renames, each checked; if the second fails the old folder goes back."""
    files, source = _files(spark, fresh)
    target, aside = _files(spark, old)[1], _files(spark, f"{old}.old")[1]
    files.delete(aside, True)
    had = files.exists(target)
    if had and not _moved(files, target, aside):
        raise OSError(f"{old} could not be set aside")
    if not _moved(files, source, target):
        if had and not _moved(files, aside, target):
            raise OSError(f"{old} could not be replaced; its data is in {old}.old")
        raise OSError(f"{old} could not be replaced and is unchanged")
    files.delete(aside, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, hadoop = _files(spark, path)
    return files.exists(hadoop)


def remove(spark: SparkSession, folder: str, names: set[str]) -> None:
    """Delete these datasets' folders (through the file system of the path); others are never touched."""
    for name in sorted(names):
        files, hadoop = _files(spark, f"{folder}/{name}")
        files.delete(hadoop, True)
