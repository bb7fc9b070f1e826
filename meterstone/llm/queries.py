"""Registered queries of the text operators, and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterstone.llm import bpe, context_tree, hilbert, linededup, mixing, periods, pii, quality, sharding, simhash, spelling, toxicity, warc
from meterstone.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hilbert": lambda spark, d: hilbert.neighbours(table(spark, d, "embeddings"), table(spark, d, "embeddings").where("vec_id % 100 = 0")),
    "op2_mixing": lambda spark, d: mixing.mix(table(spark, d, "documents")),
    "op3_simhash": lambda spark, d: simhash.near_duplicates(table(spark, d, "documents")),
    "op10_line_chunks": lambda spark, d: linededup.drop_repeated(table(spark, d, "documents"), removed_col="chunks_removed").select("doc_id", "text", "chunks_removed"),
    "op4_warc": lambda spark, d: warc.round_trip(table(spark, d, "pages")),
    "op5_bpe": lambda spark, d: bpe.digests(table(spark, d, "documents")),
    "op6_pii": lambda spark, d: pii.find(table(spark, d, "documents")),
    "op7_sharding": lambda spark, d: sharding.place(table(spark, d, "documents")).select("doc_id", "slot", "shard"),
    "op8_toxicity": lambda spark, d: toxicity.score(table(spark, d, "documents"), table(spark, d, "labels")),
    "op9_quality": lambda spark, d: quality.assess(table(spark, d, "documents")),
    "op11_spelling": lambda spark, d: spelling.variants(table(spark, d, "documents"), spoil=True),
    "op12_periods": lambda spark, d: periods.find(table(spark, d, "documents"), tails=True),
    "op13_context_tree": lambda spark, d: context_tree.score(table(spark, d, "documents")),
}
SQL: dict[str, str] = {
    "op2_mixing": mixing.sql(),
    "op4_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) ELSE page_id END AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       nullif(first, page_id) AS refers_to FROM f""",
    "op10_line_chunks": linededup.SQL,
}
