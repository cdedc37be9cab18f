"""The registered queries, one per operator, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratascore.llm import (
    bpe, decontamination, language_id, lm_scoring, merkle, mixing, sharding, simhash_dedup, substring_dedup, token_counts, url_rules,
    vector_search, whitening,
)
from stratascore.llm.common import read


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeated_passages(read(spark, folder, "documents"))


def op2_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_dedup.simhash_groups(read(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, folder, "documents"), token_counts.load_pieces())


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_positions(read(spark, folder, "documents"))


def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score_texts(read(spark, folder, "documents"))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(read(spark, folder, "documents"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op8_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    return vector_search.nearest_vectors(read(spark, folder, "embeddings"))


def op9_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge(read(spark, folder, "pages"))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return sharding.shard(docs).select("doc_id", sharding.bytes_of(F.col("text")).alias("n_bytes"), "shard", "shard_bytes")


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened_components(read(spark, folder, "embeddings"))


def op12_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(read(spark, folder, "documents"), bpe.load_tokenizer(public_tokenizers.path("byte_bpe_50k.json")))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.verified_manifest(read(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_simhash_dedup, op3_token_counts, op4_mixing, op5_lm_scoring,
                                 op6_language_id, op7_decontamination, op8_vector_search, op9_url_rules, op10_sharding,
                                 op11_whitening, op12_bpe, op13_merkle_manifest)}
ORACLES = {"op4_mixing": mixing.MIX_SQL, "op10_sharding": sharding.SHARD_SQL.format(limit=sharding.LIMIT),
           "op13_merkle_manifest": merkle.MERKLE_SQL}
