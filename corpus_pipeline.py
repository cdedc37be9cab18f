"""The corpus pipeline: five stages over documents, each one operator of ``stratascore.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratascore.llm import decontamination, language_id, mixing, sharding, simhash_dedup
from stratascore.llm.common import read
from stratascore.session import materialize, release


def language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in no learned language go."""
    return language_id.keep_known(docs)


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash_dedup.keep_one_of_each(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.keep_clean(docs, read(spark, folder, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in the order of the training run, as often as the mix takes them."""
    return mixing.mixed_order(docs)


def shards(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each row with its shard."""
    return sharding.shard(docs)


STAGES = [("language_id", language), ("simhash_dedup", near_copies), ("decontamination", benchmark_free),
          ("mixing", mix), ("sharding", shards)]
ORACLE_SQL = None  # language models and fingerprints have no SQL form; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written to the shared folder and read again by the next."""
    docs, last = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if last is not None:
            release(last)  # the stage that read it is written
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
