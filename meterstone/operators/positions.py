"""Row positions and exact quantiles of tables of any size, from range partitions and their sizes."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterstone.session import scratch_path


def _fresh(df: DataFrame, name: str) -> str:
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def _ranged(df: DataFrame, keys: Sequence[Column], part: str) -> DataFrame:
    """``df`` cut into ranges of the keys, written with the number of each row's range: what follows sees the same cut again."""
    path = scratch_path(df.sparkSession, "ranges")
    df.repartitionByRange(*keys).withColumn(part, F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def with_positions(df: DataFrame, keys: Sequence[Column], name: str = "position", tie: Sequence[str] = ()) -> DataFrame:
    """``df`` with each row's place (from 1) in the order of ``keys``, then of the columns ``tie`` (all columns if none are named).

    Rows are dealt to ranges of the keys, sorted and numbered inside their range; the sizes of the ranges, a number a
    partition, are all that is put in sequence. No task orders the whole table. Rows equal in all of these columns take the next
    places in any order. Nulls stand where ``keys`` put them. No rows give no rows.
    """
    part, number = _fresh(df, "_range"), _fresh(df, name)
    order = [*keys, *[F.col(f"`{c}`").asc_nulls_last() for c in (tie or df.columns)]]
    ranged = _ranged(df, order, part)
    sizes = sorted(tuple(r) for r in ranged.groupBy(part).count().collect())
    before = [0, *accumulate(n for _, n in sizes)]
    within = F.row_number().over(Window.partitionBy(part).orderBy(*order)).cast("long")
    if not sizes:
        return df.withColumn(number, F.lit(None).cast("long")).limit(0)
    offsets = F.create_map(*[F.lit(x) for (p, _), n in zip(sizes, before) for x in (p, n)])
    return ranged.withColumn(number, within + F.element_at(offsets, F.col(part)).cast("long")).drop(part)


def quantile(df: DataFrame, column: str, share: float) -> DataFrame:
    """One row (``value``): the exact quantile with linear interpolation; null without values.

    Equal values are counted first, so a value that a third of the rows have is one row after. The distinct values are cut into ranges; the
    counts of the ranges tell the one or two ranges that hold the wanted ranks, and only these are numbered.
    NaN counts as the largest value; nulls do not count.
    """
    if not 0 <= share <= 1:
        raise ValueError("share is 0 to 1")
    spark = df.sparkSession
    values = df.select(F.col(f"`{column}`").cast("double").alias("value")).where("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    ranged = _ranged(values, [F.col("value")], "part")
    sizes = sorted(tuple(r) for r in ranged.groupBy("part").agg(F.sum("n")).collect())
    total = sum(n for _, n in sizes)
    if not total:
        return spark.createDataFrame([(None,)], "value double")
    at = share * (total - 1)
    low = int(at)
    ranks = (low, min(low + 1, total - 1))
    before = [0, *accumulate(n for _, n in sizes)]
    wanted = [(p, b) for (p, n), b in zip(sizes, before) if any(b <= r < b + n for r in ranks)]
    offsets = F.create_map(*[F.lit(x) for pair in wanted for x in pair])
    held = ranged.where(F.col("part").isin([p for p, _ in wanted]))
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("value")) + F.element_at(offsets, F.col("part"))
    reach = held.withColumn("upto", upto).withColumn("from", F.col("upto") - F.col("n"))
    has = lambda r: F.max(F.when((F.col("from") <= r) & (F.col("upto") > r), F.col("value")))
    both = reach.agg(has(ranks[0]).alias("a"), has(ranks[1]).alias("b"))
    share_of_next = at - low
    mixed = F.col("a") if share_of_next == 0 else F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("a") + share_of_next * (F.col("b") - F.col("a")))
    return both.select(mixed.alias("value"))
