"""A training corpus from raw documents: five stages, each over all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmill.llm.bpe import encode_documents
from rollmill.llm.common import keyed, read, rejoin, written
from rollmill.llm.decontaminate import contamination
from rollmill.llm.langid import identify
from rollmill.llm.line_dedup import dedup_lines
from rollmill.llm.simhash import near_duplicates

def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents that it rejects go (`und`: NULL or without a letter). Copies and NULL ids are rows like any other."""
    found = identify(docs, rows=True).where("lang_pred != 'und'")
    return found.select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: texts lose the lines that other documents repeat; n_chars follows. No document goes, NULL text becomes empty."""
    found = dedup_lines(docs, rows=True)
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast(docs.schema["n_chars"].dataType)}
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-dedup by SimHash (three-word shingles, two bits): of each component the smallest id stays, of rows repeated in full one.

    NULL ids come last; texts without words are copies of each other."""
    found = near_duplicates(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")).alias("first")
    chosen = found.groupBy("root").agg(first).select("first.doc_id", "first.row_key")
    return rejoin(keyed(docs, rows=True), chosen, "left_semi").select("row.*").dropDuplicates(["doc_id", "text"])


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a window of a benchmark item go. Without items, or with NULL text, all stay."""
    found = contamination(docs, read(spark, sf_dir, "benchmark")).where("n_hit > 0").select("doc_id", "row_key")
    return rejoin(keyed(docs, rows=True), found.distinct(), "left_anti").select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: doc_id, n_tokens, ids (little-endian unsigned 32-bit), and digests of ids and decoded bytes. NULL text has no tokens."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(docs, ranks, public_tokenizers.PATTERN).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("simhash_dedup", near_copies),
    ("decontamination", benchmark),
    ("byte_bpe", encode),
]

#: The first and the last stage are models and tokenizers, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
