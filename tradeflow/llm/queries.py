"""The queries of this package and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradeflow.llm import oracles
from tradeflow.llm.conversation_trie import conversation_trie
from tradeflow.llm.embedding_links import link_embeddings
from tradeflow.llm.language import identify_languages
from tradeflow.llm.licenses import LEAST_DICE, TEMPLATES, scan_licenses
from tradeflow.llm.merkle import verify_manifest
from tradeflow.llm.mixing import mix_sources
from tradeflow.llm.near_duplicates import near_duplicate_classes
from tradeflow.llm.packing import pack_documents
from tradeflow.llm.quality import judge_quality
from tradeflow.llm.sharding import shard_by_bytes
from tradeflow.llm.storage import Store, documents
from tradeflow.llm.token_counts import token_report
from tradeflow.llm.token_files import token_files
from tradeflow.llm.url_filter import judge_urls

Query = Callable[[SparkSession, str], DataFrame]


def op1_shard_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(documents(spark, sf_dir), Store(spark))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir), Store(spark))


def op3_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), Store(spark))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), Store(spark))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(documents(spark, sf_dir))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(documents(spark, sf_dir), Store(spark))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_report(documents(spark, sf_dir))


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), Store(spark))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify_manifest(documents(spark, sf_dir), Store(spark))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(documents(spark, sf_dir), Store(spark))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), Store(spark))


QUERIES: dict[str, Query] = {
    q.__name__: q for q in (
        op1_shard_bytes,
        op2_mix_sources,
        op3_embedding_links,
        op4_quality,
        op5_url_trust,
        op6_language,
        op7_license_scan,
        op8_near_duplicates,
        op9_token_counts,
        op10_pack,
        op11_merkle_manifest,
        op12_token_files,
        op13_prefix_trie,
    )
}

ORACLES: dict[str, str] = {
    "op1_shard_bytes": oracles.shard(),
    "op2_mix_sources": oracles.MIX,
    "op5_url_trust": oracles.URLS,
    "op7_license_scan": oracles.licenses(TEMPLATES, LEAST_DICE),
    "op11_merkle_manifest": oracles.merkle(),
    "op13_prefix_trie": oracles.TRIE,
}
