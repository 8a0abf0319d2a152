"""Line dedup: explode normalised lines, hash, count documents per hash, drop, reassemble by position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.llm.common import ascii_lower, keyed, rejoin
from rollmill.plans.scale import attach

SPACE = " \t\n\x0b\x0c\r"


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    rows: bool = False,
) -> DataFrame:
    """Columns doc_id, text (the lines that stay), n_lines, n_dropped (with `rows`, also row: the input row); one row per input row.

    A line's key is the line without white space at its ends, A-Z in lower case.
    Keys of `min_chars` code points or more that `min_docs` documents or more hold
    lose their lines in all documents but the one with the largest id.

    NULL and empty texts are one empty line. Documents are told apart by id: rows that
    share an id count as one document, NULL is an id and the smallest one. Two 64-bit
    hashes stand for a key. Other columns are not read. Empty tables give no rows.
    """
    base = keyed(docs, id_col, text_col, rows)
    split = F.split(F.coalesce(F.col("row")[text_col], F.lit("")), "\n")
    lines = base.select("doc_id", "row_key", F.posexplode(split).alias("pos", "line"))
    lines = lines.withColumn("key", ascii_lower(F.btrim("line", F.lit(SPACE))))
    hashed = lines.where(F.char_length("key") >= min_chars).select(
        "doc_id", "row_key", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )
    holders = hashed.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
    shared = holders.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
    shared = shared.where(F.col("n") >= min_docs).drop("n")
    dropped = attach(hashed, shared, ["h1", "h2"], "inner").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    # positions of one document: never more than it has lines
    by_doc = dropped.groupBy("doc_id", "row_key").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    # true at dropped positions, so that each line is looked up by index
    mask = F.expr(
        "flatten(transform(gone, (p, i) -> concat("
        "array_repeat(false, p - 1 - coalesce(get(gone, i - 1), -1)), array(true))))"
    )
    met = rejoin(base, by_doc).select("doc_id", "row", split.alias("line"), mask.alias("mask"), F.size("gone").alias("n_gone"))
    kept = F.expr("filter(line, (x, i) -> not coalesce(get(mask, i), false))")
    return met.select(
        "doc_id",
        F.array_join(kept, "\n").alias("text"),
        F.size("line").cast("bigint").alias("n_lines"),
        F.coalesce("n_gone", F.lit(0)).cast("bigint").alias("n_dropped"),
        *["row"] * rows,
    )
