"""Registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aerolake.llm import bpe, caps, languages, lines, minhash, packing, quality, sharding, spelling, tokenfile, toxicity, tries, vptree
from aerolake.llm.common import ready
from aerolake.llm.oracle import oracle_sql  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(_table(spark, sf_dir, "documents"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=3, similarity=85)


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_vectors(_table(spark, sf_dir, "embeddings"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_vp_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(_table(spark, sf_dir, "embeddings"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digest(_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), added=packing.added_path())


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.language_digest(_table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digest(_table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.token_digest(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_sharding, op2_minhash_dedup, op3_embedding_dedup, op4_toxicity, op5_quality, op6_vp_trees, op7_line_dedup, op8_packing,
        op9_language_id, op10_byte_bpe, op11_spelling, op12_prefix_trie, op13_token_file,
    )
    return {f.__name__: f for f in named}
