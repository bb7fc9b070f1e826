"""Column profile: needed text width per column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Width rounding and limits.
WIDTH_STEP, WIDTH_MIN, WIDTH_MAX = 10, 8, 8000


def text_widths(df: DataFrame) -> DataFrame:
    """One pass over all text columns: column_name, max_length, width."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    longest = df.agg(*[F.max(F.length(c)).alias(c) for c in names])
    pairs = [x for c in names for x in (F.lit(c), F.col(f"`{c}`"))]
    long = longest.select(F.stack(F.lit(len(names)), *pairs).alias("column_name", "max_length"))
    size = F.greatest(F.coalesce("max_length", F.lit(1)), F.lit(1))
    stepped = F.ceil(size / WIDTH_STEP) * WIDTH_STEP
    return long.withColumn("width", F.least(F.greatest(F.lit(WIDTH_MIN), stepped), F.lit(WIDTH_MAX)).cast("int"))
