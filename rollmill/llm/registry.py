"""Queries of this subpackage: each operator over its whole table, reduced to digest columns."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmill.llm.bpe import encode_documents
from rollmill.llm.classlm import score_texts
from rollmill.llm.common import read
from rollmill.llm.decontaminate import contamination
from rollmill.llm.langid import identify
from rollmill.llm.line_dedup import dedup_lines
from rollmill.llm.mtree import top_k
from rollmill.llm.pii import find_personal_data
from rollmill.llm.credentials import find_secrets
from rollmill.llm.runs import find_runs, rotated, run_digests
from rollmill.llm.sharding import shard_by_bytes
from rollmill.llm.simhash import near_duplicates
from rollmill.llm.sql import ORACLE_SQL
from rollmill.llm.trie import shared_start_trie
from rollmill.llm.urls import RULES, filter_urls

__all__ = ["ORACLE_SQL", "QUERIES"]


def sha256(c) -> F.Column:
    return F.sha2(c.cast("binary"), 256)


def op1_histogram_shards(spark: SparkSession, root: str) -> DataFrame:
    placed = shard_by_bytes(read(spark, root, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_mtree(spark: SparkSession, root: str) -> DataFrame:
    return top_k(read(spark, root, "embeddings"))


def op3_secrets(spark: SparkSession, root: str) -> DataFrame:
    found = find_secrets(read(spark, root, "documents"))
    return found.withColumn("base_sha256", sha256(F.col("base"))).drop("base")


def op4_language(spark: SparkSession, root: str) -> DataFrame:
    return identify(read(spark, root, "documents"))


def op5_simhash(spark: SparkSession, root: str) -> DataFrame:
    found = near_duplicates(read(spark, root, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_decontaminate(spark: SparkSession, root: str) -> DataFrame:
    found = contamination(read(spark, root, "documents"), read(spark, root, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        sha256(F.array_join("items", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_class_lm(spark: SparkSession, root: str) -> DataFrame:
    return score_texts(read(spark, root, "documents"))


def op8_byte_bpe(spark: SparkSession, root: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = encode_documents(read(spark, root, "documents"), ranks, public_tokenizers.PATTERN)
    return found.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_line_dedup(spark: SparkSession, root: str) -> DataFrame:
    found = dedup_lines(read(spark, root, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", sha256(F.col("text")).alias("kept_sha256"))


def op10_personal_data(spark: SparkSession, root: str) -> DataFrame:
    found = find_personal_data(read(spark, root, "documents"))
    return found.withColumn("base_sha256", sha256(F.col("base"))).drop("base")


def op11_periodic_runs(spark: SparkSession, root: str) -> DataFrame:
    return run_digests(find_runs(read(spark, root, "documents"), rewrite=rotated))


def op12_prefix_trie(spark: SparkSession, root: str) -> DataFrame:
    return shared_start_trie(read(spark, root, "conversations"))


def op13_url_filter(spark: SparkSession, root: str) -> DataFrame:
    found = filter_urls(read(spark, root, "pages"), RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_histogram_shards,
        op2_mtree,
        op3_secrets,
        op4_language,
        op5_simhash,
        op6_decontaminate,
        op7_class_lm,
        op8_byte_bpe,
        op9_line_dedup,
        op10_personal_data,
        op11_periodic_runs,
        op12_prefix_trie,
        op13_url_filter,
    )
} | {"pipeline": corpus_pipeline.run}
