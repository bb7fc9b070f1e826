"""Connected components of a link table, by hooking and pointer jumping in Spark rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstone.llm.common import written


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node of its component.

    Each round takes the smallest root among a node's neighbours, hands it to the node and to the
    node's present root, and replaces every root by its own root, so the number of rounds grows with
    the logarithm of the component size. A node with many links is met only in joins, whose skewed
    partitions adaptive execution splits, and in minima that are combined before the shuffle. Only
    the number of changed roots reaches the driver; each round's table is written to the shared folder.
    Self links and repeated links are harmless; no links give no rows. Links with a null end are ignored.
    """
    one = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    both = written(one.unionByName(one.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    roots = written(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("root")), "roots")
    while True:
        near = (both.join(roots, both.v == roots.node).groupBy("u").agg(F.min("root").alias("near"))
                .join(roots, F.col("u") == roots.node).select("node", "root", "near"))
        offers = near.select("node", F.least("root", "near").alias("root")).unionByName(near.select(F.col("root").alias("node"), F.col("near").alias("root")))
        hooked = offers.groupBy("node").agg(F.min("root").alias("root"))
        up = hooked.select(F.col("node").alias("root"), F.col("root").alias("top"))
        after = written(hooked.join(up, "root").select("node", F.least("root", "top").alias("root")), "roots")
        changed = after.join(roots.withColumnRenamed("root", "before"), "node").where("root <> before").limit(1).count()
        roots = after
        if not changed:
            return roots
