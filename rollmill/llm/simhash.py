"""SimHash near-dedup by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.llm.common import map_texts, texts, written
from rollmill.llm.graph import components
from rollmill.plans.scale import attach

SEED = 42
BITS = 64
#: Two bits spoil two of three parts at most: three segments, and three parts of what lies beside each of them.
PARTS = 3
CHUNK = 1 << 16


def shingle_hash_bytes(text: str | None, width: int) -> Iterator[bytes]:
    """XXH64 digests (big-endian, joined) of all runs of `width` words, CHUNK shingles at a time."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(width, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_digest
    for at in range(0, len(starts), CHUNK):
        some = zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=True)
        yield b"".join([digest(joined[s:e], SEED) for s, e in some])


def fingerprint(text: str | None, width: int = 3) -> int:
    """64 bits, each set if over half of the shingles' hashes have it; 0 without words."""
    total, n = np.zeros(64, np.int64), 0
    for block in shingle_hash_bytes(text, width):
        rows = np.frombuffer(block, np.uint8).reshape(-1, 8)
        total += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
        n += len(rows)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, row_key (hash of id and text), fp"""

    def work(batches):
        for ids, found in batches:
            yield {"row": ids, "fp": [fingerprint(t, width) for t in found]}

    rows = docs.select(F.struct("doc_id", F.xxhash64("doc_id", "text").alias("row_key")).alias("doc_id"), "text")
    marked = map_texts(rows, work, "row struct<doc_id:bigint,row_key:bigint>, fp bigint")
    return marked.select("row.doc_id", "row.row_key", "fp")


def table_masks() -> list[int]:
    """The bits of the nine tables' keys: a segment and a part of the other bits, as signed 64-bit integers."""
    masks = []
    for segment in np.array_split(np.arange(BITS), PARTS):
        for part in np.array_split(np.setdiff1d(np.arange(BITS), segment), PARTS):
            masks.append(int(np.bitwise_or.reduce(np.uint64(1) << np.concatenate([segment, part]).astype(np.uint64)).astype(np.int64)))
    return masks


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all of `prints` (distinct fp bigint) with 2 or fewer differing bits, and nothing else.

    Multi-index hashing: two fingerprints within 2 bits agree in one of three segments, and in a third of the other bits:
    the ball to enumerate in a segment has radius 2 div 3 = 0, one value, and every fingerprint has one row
    in each of nine tables, keyed by 35 or 36 of its bits. A bucket of two is its own pair. Fuller ones belong to families of near
    copies, where all pairs of a bucket would be too many: `ball_links` connects their members. The
    complete distance of every link is verified.
    """
    spark = prints.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = prints.select("fp").repartition(tasks, "fp")
    keys = ", ".join(f"named_struct('t', {i}, 'key', fp & {m}L)" for i, m in enumerate(table_masks()))
    tables = dealt.select("fp", F.inline(F.expr(f"array({keys})")))
    buckets = tables.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1")
    buckets = written(buckets, "buckets")
    pairs = buckets.where((F.col("n") == 2) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)).select("a", "b")
    full = attach(tables, buckets.where("n > 2").select("t", "key"), ["t", "key"], "left_semi").select("fp").distinct()
    return pairs.union(ball_links(full.repartition(tasks, "fp")))


def ball_links(prints: DataFrame) -> DataFrame:
    """`links` by balls of radius 1 over all bits: two fingerprints within 2 bits share an entry, as one flips the first
    differing bit, the other the second. An entry holds 65 fingerprints at most, whatever the size of the family, and all are
    within 2 bits of each other; each is linked with the smallest.
    """
    flips = f"transform(sequence(0, {BITS - 1}), i -> fp ^ shiftleft(1L, i))"
    table = prints.select("fp", F.explode(F.expr(f"concat(array(fp), {flips})")).alias("entry"))
    heads = table.groupBy("entry").agg(F.min("fp").alias("a"), F.max("fp").alias("last"))
    met = table.join(heads.where("a < last").drop("last"), "entry").where("a != fp")
    return met.where(F.bit_count(F.col("a").bitwiseXOR(F.col("fp"))) <= 2).select("a", F.col("fp").alias("b"))


def near_duplicates(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, row_key, fp, root (bigint), component_id (smallest doc_id reachable); one row per input row.

    Fingerprints of `width`-word shingles, repeats included, link at 2 or fewer differing bits. A text with fewer words is
    one shingle; NULL, empty and blank texts have fingerprint 0, which links like any other.
    NULL ids are never the smallest; a group of NULL ids alone has component_id NULL. Rows that repeat
    an id are rows of their own with one label each. row_key is a hash of id and text, root the smallest
    fingerprint reachable. Other columns are not read. Empty tables give no rows.

    Equal fingerprints are one node, so copies add nothing to the tables or the graph.
    """
    marked = written(fingerprints(texts(docs, id_col, text_col), width), "prints")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(nodes.select("fp")))
    labelled = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    named = attach(labelled.select("fp", "root"), smallest, ["root"])
    return attach(marked, named, ["fp"]).select("doc_id", "row_key", "fp", "root", "component_id")
