"""Sharding by histogram sort: exact byte counts below probes, refined until splitters fit, then one exchange."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.llm.common import texts, written

BITS = 10  # a round cuts the range around each splitter with 2**BITS probes
BLOCK_ROWS = 4096
HALF = 1 << 63


@dataclass(frozen=True)
class Edge:
    """A boundary between values in unsigned order: `at` and above lie beyond it. `below`: exact bytes before it."""

    at: int
    below: int
    inside: int = 0  # bytes of the value `at` itself, if no probe fits closer than either side of it


def unsigned(column: str) -> str:
    """A bigint hash with its sign bit flipped: bits in unsigned order."""
    return f"({column} ^ (-9223372036854775807L - 1L))"


def refine(rows: DataFrame, column: str, targets: dict[int, tuple[int, int]], slack: float) -> dict[int, Edge]:
    """Edges of `column` whose bytes below meet their targets.

    targets: {splitter: (bytes before all rows, bytes wanted below)}. Every round is one aggregation for all
    splitters; the driver gets 2**BITS counts for each at most.
    """
    u, shift, found = unsigned(column), 64, {}
    active = {i: (0, start) for i, (start, _) in targets.items()}  # range prefix, bytes below it
    while active:
        finer = max(0, shift - BITS)
        near = rows
        if shift < 64:
            near = rows.where(F.expr(f"shiftrightunsigned({u}, {shift})").isin([p for p, _ in active.values()]))
        counts: dict[int, list[tuple[int, int]]] = {}
        probes = near.groupBy(F.expr(f"shiftrightunsigned({u}, {finer})").alias("probe")).agg(F.sum("size").alias("n"))
        for row in probes.collect():
            probe = row.probe % (1 << 64)
            counts.setdefault(probe >> (shift - finer), []).append((probe, int(row.n)))
        deeper = {}
        for i, (prefix, below) in active.items():
            target = targets[i][1]
            ordered = sorted(counts.get(prefix, []))
            for probe, n in ordered:
                if below + n >= target or (probe, n) == ordered[-1]:
                    edges = Edge(probe << finer, below), Edge((probe + 1) << finer, below + n)
                    best = min(edges, key=lambda e: abs(e.below - target))
                    if abs(best.below - target) <= slack or not below < target < below + n:
                        found[i] = best
                    elif finer:
                        deeper[i] = (probe, below)
                    else:
                        found[i] = Edge(probe, below, n)
                    break
                below += n
            else:
                found[i] = Edge(0, below)
        active, shift = deeper, finer
    return found


def splitters(rows: DataFrame, n: int, tolerance: float) -> list[tuple[int, int]]:
    """n - 1 ordered pairs (key, tie): rows with at least that pair lie beyond the splitter.

    rows: key bigint, tie bigint, size bigint. The bytes below a splitter miss their target by at most `tolerance` of
    a shard. The probes move over `key` first, so that rows of one key stay together; where one key
    alone holds more, they move over `tie` inside that key.
    """
    total = int(rows.agg(F.sum("size").alias("n")).first().n or 0)
    slack = total / n * tolerance
    targets = {i: (0, total * i // n) for i in range(1, n)}
    edges = refine(rows, "key", targets, slack)
    cuts = {i: (e.at, 0) for i, e in edges.items()}
    heavy: dict[int, list[int]] = {}
    for i, e in edges.items():
        if e.inside:
            heavy.setdefault(e.at, []).append(i)
    for key, members in heavy.items():  # n - 1 keys at most
        group = rows.where(F.col("key") == F.lit(key - HALF))
        within = {i: (edges[i].below, targets[i][1]) for i in members}
        for i, e in refine(group, "tie", within, slack).items():
            cuts[i] = (key, e.at)
    return sorted(cuts.values())


def beyond(cut: tuple[int, int]) -> Column:
    key, tie = cut
    if key >= 2 * HALF:
        return F.lit(False)
    above, at = F.col("key") > F.lit(key - HALF), F.col("key") == F.lit(key - HALF)
    return above | (at & (F.col("tie") >= F.lit(tie - HALF)) if tie < 2 * HALF else F.lit(False))


def shard_by_bytes(
    docs: DataFrame, n: int = 24, id_col: str = "doc_id", text_col: str = "text", tolerance: float = 0.01
) -> DataFrame:
    """Columns doc_id, text, size, text_crc32, shard, slot: `n` shards of nearly equal bytes in hash order of the texts.

    size is the UTF-8 length plus 8 (NULL text: 8). Equal texts share a shard unless a group of copies is too
    large for a splitter to pass it within `tolerance` of a shard; it is then cut by the hashes of the ids.
    slot counts a shard's rows from 0 without gaps. A row larger than a shard makes its shard larger.
    NULL texts are a group of copies, NULL ids are ids. Rows that are equal in id and text
    are never parted; they take slots in any order. Other columns are not read. Empty
    tables give no rows; with fewer rows than shards some shards are empty.

    The rows move once, to (shard, block): a block is a hash of the row and holds about BLOCK_ROWS
    rows, numbered inside the block and shifted by the rows of the shard's earlier blocks.
    """
    base = texts(docs, id_col, text_col).select(
        "*",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("key"),
        F.xxhash64(F.lit(7), "doc_id").alias("tie"),
    )
    narrow = written(base.select("key", "tie", "size"), "shard-keys")
    shard = F.lit(0)
    for cut in splitters(narrow, n, tolerance):
        shard = shard + beyond(cut).cast("int")
    blocks = max(1, narrow.count() // (n * BLOCK_ROWS))
    block = F.pmod(F.xxhash64(F.lit(11), "key", "tie"), F.lit(blocks)).cast("int")
    counts = narrow.groupBy(shard.alias("_s"), block.alias("_b")).agg(F.count(F.lit(1)).alias("rows"))
    offsets = counts.selectExpr("_s", "_b", "sum(rows) over (partition by _s order by _b) - rows as off")
    placed = base.select("*", shard.alias("shard"), block.alias("block"))
    numbered = placed.withColumn("i", F.expr("row_number() over (partition by shard, block order by key, tie) - 1"))
    met = numbered.join(offsets, (F.col("shard") == F.col("_s")) & (F.col("block") == F.col("_b")), "left")
    return met.select(
        "doc_id", "text", "size", "text_crc32", "shard", (F.col("i") + F.col("off")).cast("bigint").alias("slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; rows keep their slot."""
    sharded.write.partitionBy("shard").parquet(path)
