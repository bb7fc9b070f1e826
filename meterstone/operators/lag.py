"""Previous-row lookup that survives a key holding most of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def previous_values(df: DataFrame, keys: Sequence[str], order: Sequence[str], take: Mapping[str, str], piece: Column) -> DataFrame:
    """Add ``take`` = {new column: source column} from the previous row of the key.

    Every key is cut into pieces by ``piece``, which must not fall as ``order`` rises (a
    month of a date, say). The lag runs inside a piece, and the first row of a
    piece takes the last row of the key's previous piece: in a second window only
    the first and last rows of the pieces stand, where that row comes just before.
    So no window holds more than one piece of a key or two rows a piece, at every
    size alike, and nothing runs while the plan is built. All rows move once, by
    key and piece, and the rows at the edges once more. ``order`` must be unique
    within a key and must not be NULL.
    """
    inside = Window.partitionBy(*keys, "_piece").orderBy(*order)
    within = df.withColumn("_piece", piece).select(
        "*",
        *[F.lag(src).over(inside).alias(f"_in_{name}") for name, src in take.items()],
        (F.row_number().over(inside) == 1).alias("_head"),
        F.lead(F.lit(True)).over(inside).isNull().alias("_tail"),
    )
    # rows equal in the order stand as in their piece, first row first
    across = Window.partitionBy(*keys).orderBy(*order, F.col("_head").desc())
    edges = within.filter(F.col("_head") | F.col("_tail")).select(
        *df.columns,
        *[F.when(F.col("_head"), F.lag(src).over(across)).otherwise(F.col(f"_in_{name}")).alias(name) for name, src in take.items()],
    )
    others = within.filter(~F.col("_head") & ~F.col("_tail")).select(*df.columns, *[F.col(f"_in_{name}").alias(name) for name in take])
    return edges.unionByName(others)
