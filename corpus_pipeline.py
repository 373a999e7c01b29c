"""The corpus pipeline: stages over documents, each built on one operator of clientele.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
reread as the next one's docs. Except for the last, stages return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clientele.llm.decontaminate import drop_contaminated
from clientele.llm.minhash_dedup import keep_first
from clientele.llm.mixing import take_mix
from clientele.llm.quality import filter_quality, fit_quality
from clientele.llm.sharding import shard_documents
from clientele.llm.staging import Staging, dropped_after, read_table

TARGET_BYTES = 128 << 20


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    return filter_quality(docs, fit_quality(docs, read_table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return take_mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents of the mix with shard and slot; shards of about TARGET_BYTES of text."""
    return shard_documents(docs, target_bytes=TARGET_BYTES)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

# Classifier, graph components and balancing are iterative: checked against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Staging(spark, "pipeline")
    docs, before = read_table(spark, sf_dir, "documents"), []
    for name, step in STAGES:
        with dropped_after():
            docs = stage.put(step(spark, docs, sf_dir), name)
        stage.drop(*before)
        before = [name]
    return docs
