"""The corpus pipeline over ``documents``: every stage takes all that its predecessor kept.

Toxic documents go, passages that an earlier document has are cut, one document of each near-duplicate
group stays, sources are mixed to their target weights by sampling, and what is left is tokenised
(and decoded again, as a check of the ids). All stages but the last return the columns of documents.
Stages keep the conventions of their operators for nulls, empty texts and repeated rows; a document
whose lines were all cut stays as an empty text until the near-duplicate stage, and other columns go along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstone.llm import bpe, linededup, mixing, simhash, toxicity
from meterstone.llm.common import table, written

#: The grammar, fingerprints and merges have no SQL form: tests hold each stage against a brute-force version.
ORACLE_SQL: str | None = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = linededup.drop_repeated(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, percent=simhash.PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, report=False)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the executors still hold what the stages before took, so a task remembers fewer words than in op5
    return bpe.digests(docs, ids=True, kept=100_000, piece=1 << 20)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", cut_repeated_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.split()[0])
    return docs
