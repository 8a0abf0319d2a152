"""Benchmark decontamination: a prefix-filtered set join of word shingles, verified over item-sized windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.llm.common import ascii_lower, keyed, rejoin, written

# Fixed value: what separates words once A-Z are in lower case.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLE = 3
#: A benchmark's shingle hashes are broadcast up to this many (8 bytes each); beyond it Spark shuffles both sides.
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP), "")


def shingle_hashes(n: int) -> str:
    """SQL: hashes of all runs of `n` words of the array `w`, in order."""
    parts = ", ".join(f"w[i + {k}]" for k in range(n))
    return f"case when size(w) >= {n} then transform(sequence(0, size(w) - {n}), i -> xxhash64({parts})) end"


def bounded(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it has BROADCAST_ROWS rows at most, else left to Spark's joins."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def benchmark_windows(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """win (its words, joined), size, item_id: `window` words each, or the whole item if it has fewer."""
    w = benchmark.select(F.col(item_col).alias("item_id"), words(F.col(text_col)).alias("w")).where("size(w) > 0")
    cut = (
        f"transform(sequence(0, greatest(size(w) - {window}, 0)), "
        f"i -> struct(array_join(slice(w, i + 1, {window}), ' ') as win, least(size(w), {window}) as size))"
    )
    return w.select("item_id", F.explode(F.expr(cut)).alias("x")).select("item_id", "x.win", "x.size").distinct()


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Columns doc_id, row_key (hash of id and text), n_words, n_hit, items (sorted array of item ids as strings); one row per input row.

    A window is `window` consecutive words of an item; a shorter item is one window. n_hit counts the document's
    words inside any occurrence of a window, items the benchmark rows with a window that occurs.
    Texts without words, NULL and empty ones too, have no windows and no hits. Rows with one id and
    different texts are judged apart, repeated rows alike; items that repeat an id count once, a NULL item
    id never shows in `items`. Other columns are not read. Empty tables: no rows, or no hits.

    1. Every window is a set of shingles of three words (fewer, if it is shorter). All must occur
       in a containing document, so one is a sufficient prefix: the rarest over the corpus.
    2. Occurrences of benchmark shingles are found in one pass and written; their counts give the rarity.
    3. An occurrence of a prefix shingle fixes where its window starts; windows that would
       leave the document (position, length) go.
    4. The words at each remaining place are compared with the window's.
    """
    windows = written(benchmark_windows(benchmark, window, item_col, item_text_col), "windows")
    distinct = windows.select("win", "size").distinct()
    as_words = distinct.withColumn("w", F.split("win", " ")).withColumn("n", F.least("size", F.lit(SHINGLE)))
    lengths = sorted(r.n for r in as_words.select("n").distinct().collect())  # 1, 2, 3 at most
    cases = " ".join(f"when {n} then {shingle_hashes(n)}" for n in lengths) or "when 0 then array(0L)"
    tokens = as_words.select("win", "size", "n", F.posexplode(F.expr(f"case n {cases} end")).alias("off", "h"))

    base, text = keyed(docs, id_col, text_col), F.col("row")[text_col]
    split = base.select("doc_id", "row_key", words(text).alias("w"))
    streams = []
    for n in lengths:
        every = split.select("doc_id", "row_key", F.size("w").alias("n_words"), F.posexplode(F.expr(shingle_hashes(n))))
        every = every.toDF("doc_id", "row_key", "n_words", "pos", "h")
        streams.append(every.join(bounded(tokens.where(f"n = {n}").select("h").distinct()), "h", "left_semi"))
    if not streams:
        return split.select(
            "doc_id",
            "row_key",
            F.size("w").cast("bigint").alias("n_words"),
            F.lit(0).cast("bigint").alias("n_hit"),
            F.array().cast("array<string>").alias("items"),
        )
    found = streams[0]
    for more in streams[1:]:
        found = found.union(more)
    found = written(found, "shingles")

    counts = found.groupBy("h").agg(F.count(F.lit(1)).alias("rarity"))
    # a shingle that never occurs has no count, and its window cannot occur
    ranked = tokens.join(counts, "h", "left")
    prefix = ranked.groupBy("win", "size").agg(
        F.min(F.struct(F.coalesce("rarity", F.lit(0)).alias("rarity"), "h", "off")).alias("best")
    )
    prefix = prefix.where("best.rarity > 0").select("win", "size", F.col("best.h").alias("h"), F.col("best.off").alias("off"))
    placed = found.join(prefix, "h").withColumn("start", F.col("pos") - F.col("off"))
    placed = placed.where("start >= 0 and start + size <= n_words")
    # a document's own places: as many as its words times the windows that share a prefix
    by_doc = placed.groupBy("doc_id", "row_key").agg(F.collect_set(F.struct("start", "size", "win")).alias("places"))
    met = rejoin(base, by_doc).select("doc_id", "row_key", "places", words(text).alias("w"))
    hits = F.expr("filter(places, p -> array_join(slice(w, p.start + 1, p.size), ' ') = p.win)")
    met = met.select("doc_id", "row_key", F.size("w").cast("bigint").alias("n_words"), hits.alias("hits"))
    covered = "array_distinct(flatten(transform(hits, p -> sequence(p.start, p.start + p.size - 1))))"
    judged = written(
        met.select(
            "doc_id",
            "row_key",
            "n_words",
            F.expr(f"cast(coalesce(size({covered}), 0) as bigint)").alias("n_hit"),
            F.expr("array_distinct(transform(hits, p -> p.win))").alias("wins"),
        ),
        "judged",
    )
    pairs = judged.where("n_hit > 0").select("doc_id", "row_key", F.explode("wins").alias("win"))
    pairs = pairs.join(windows.select("win", "item_id"), "win")
    items = pairs.groupBy("doc_id", "row_key").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    return rejoin(judged.drop("wins"), items).select(
        "doc_id", "row_key", "n_words", "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )
