"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_one_per_key(df: DataFrame, keys: Sequence[str], count_as: str = "dup_rows") -> DataFrame:
    """One row per key plus the number of copies.

    Copies that differ are resolved by the smallest remaining columns in column order, so the result does not depend on row order.
    Equal rows are counted first, by hash and before the shuffle, so a key with a huge number of copies never reaches one
    task as rows. The variants are dealt by key once, and all that follows reads this one exchange: most keys have one variant and are
    done; only the variants of the others, found by a count and a hash join inside the partition, are put in order. The key is a struct,
    which is never null and equal where its fields are equal or both null, so that every step keeps the partitions.
    """
    rest = [c for c in df.columns if c not in keys]
    variants = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(count_as))
    key = F.struct(*keys)
    dealt = variants.repartition(key).withColumn("_key", key)
    # the copies are summed too so that all readers of the variants share one exchange
    found = dealt.groupBy("_key").agg(F.count(F.lit(1)).alias("_variants"), F.sum(count_as).alias("_copies"))
    several = found.filter("_variants > 1 AND _copies > 1").select("_key").hint("shuffle_hash")
    single = dealt.join(several, "_key", "left_anti")
    of_key = Window.partitionBy("_key")
    place = F.row_number().over(of_key.orderBy(*[F.col(c).asc_nulls_first() for c in rest]))
    unlike = dealt.join(several, "_key", "left_semi").withColumns({"_place": place, count_as: F.sum(count_as).over(of_key)})
    one = single.unionByName(unlike.filter("_place = 1").drop("_place"))
    # always true, but no optimizer moves a filter past it: one of a later join would go below the exchange in the first branch
    # only, and both branches would then have an exchange of their own
    return one.filter(F.spark_partition_id() >= 0).select(*keys, *rest, count_as)
