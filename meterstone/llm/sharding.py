"""Sharding by a permutation-filled lookup table.

Every shard has a preference order over the slots of a table of prime size: it begins at an offset and
goes on by a skip, both from a digest of its name. Shards take turns and each claims the next slot of
its order that is free, so shares differ by one slot at most (by weight, if weights are given), and a
shard that leaves or joins moves few keys besides its own. A row's slot is a digest of its key modulo
the table size; a broadcast of the table, whose size is this parameter and not the data's, places every
row in constant time without a shuffle.

Results for odd input: null keys are placed by a digest of the empty text and the row's other
columns are ignored; equal keys go to the same shard; extra columns stay, and ``slot`` and ``shard``
replace columns of that name; no rows give no rows; no shards, repeated names, negative or all-zero
weights or a size that is no prime above the number of shards raise.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstone.llm.common import fresh

SIZE = 65537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _digest(text: str, mark: str) -> int:
    return int(hashlib.md5(f"{mark}{text}".encode()).hexdigest()[:15], 16)


def fill(shards: tuple[str, ...] = SHARDS, size: int = SIZE, weights: dict[str, float] | None = None) -> list[int]:
    """For each slot the place of its shard in ``shards``."""
    if not shards or len(set(shards)) < len(shards) or size <= len(shards) or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("shards need distinct names and a prime number of slots above their number")
    share = [1.0 if weights is None else float(weights[s]) for s in shards]
    if min(share) < 0 or max(share) <= 0:
        raise ValueError("weights must not be negative, nor all zero")
    share = [w / max(share) for w in share]
    at = [_digest(s, "offset:") % size for s in shards]
    skip = [_digest(s, "skip:") % (size - 1) + 1 for s in shards]
    table, credit, left = [-1] * size, [0.0] * len(shards), size
    while True:
        for i, w in enumerate(share):
            credit[i] += w
            if credit[i] < 1 - 1e-12:
                continue
            credit[i] -= 1
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % size
            table[at[i]] = i
            left -= 1
            if not left:
                return table


def slot(key: Column, size: int = SIZE) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long") % size


def place(df: DataFrame, key: str = "doc_id", shards: tuple[str, ...] = SHARDS, size: int = SIZE, weights: dict[str, float] | None = None) -> DataFrame:
    """``df`` with columns slot and shard."""
    taken = fresh(df, "taken")
    names = df.sparkSession.createDataFrame([(i, shards[s]) for i, s in enumerate(fill(shards, size, weights))], f"{taken} long, shard string")
    rows = df.drop("slot", "shard") if key not in ("slot", "shard") else df
    rows = rows.withColumn("slot", slot(F.col(f"`{key}`"), size))
    return rows.join(F.broadcast(names), F.col("slot") == F.col(taken)).drop(taken)


def write(df: DataFrame, folder: str, **how) -> None:
    """A folder for each shard. Rows are rebalanced by shard, so a large shard is dealt to several tasks and files."""
    place(df, **how).hint("rebalance", "shard").write.partitionBy("shard").parquet(folder)
