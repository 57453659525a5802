"""Registered queries of the numbered operators, each over its whole table, and their SQL where SQL can tell the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import ann, bpe, decontaminate, language_id, merkle, near_dedup, resampling, sharding, substring_dedup, token_counts, token_files, toxicity, warc
from tessera.llm.oracle import ORACLE
from tessera.llm.stage import table


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component and kept flag of every document (MinHash near-duplicates)."""
    return near_dedup.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's token ids, read back from Arrow sequence files."""
    return token_files.round_trip(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text decoded from them."""
    encoded = bpe.encode(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), decoded=True)
    return bpe.digests(encoded)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document (PPM code lengths)."""
    return language_id.identify(spark, table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's WARC record, read back from ZIP archives by range."""
    found = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat 50 words of a document with a smaller id, and a digest of the rest."""
    return substring_dedup.digests(substring_dedup.substring_dedup(spark, table(spark, sf_dir, "documents")))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found for every hundredth vector (adaptive dimension scan)."""
    return ann.search(spark, table(spark, sf_dir, "embeddings"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document (Feistel permutation of row numbers)."""
    return sharding.shard(spark, table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability and verdict of every document for each category of the classifier chain."""
    return toxicity.classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a 10-word window of a benchmark item, and those items."""
    return decontaminate.digests(decontaminate.contamination(
        spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and its verdict of every document (postorder append log)."""
    return merkle.manifest(spark, table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document (whole-token shortcut)."""
    return token_counts.count_tokens(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document in a draw towards the benchmark's distribution."""
    return resampling.resample(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_token_files": op2_token_files,
    "op3_bpe": op3_bpe,
    "op4_language_id": op4_language_id,
    "op5_warc": op5_warc,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_ann": op7_ann,
    "op8_sharding": op8_sharding,
    "op9_toxicity": op9_toxicity,
    "op10_decontaminate": op10_decontaminate,
    "op11_merkle": op11_merkle,
    "op12_token_counts": op12_token_counts,
    "op13_resampling": op13_resampling,
}

__all__ = ["ORACLE", "QUERIES"]
