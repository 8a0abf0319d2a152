"""What the operators of this subpackage share."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmill.plans.session import shared_dir


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    plain = F.octet_length(c) == F.char_length(c)
    return F.when(plain, F.lower(c)).otherwise(F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id and text alone, whatever else the table holds."""
    return docs.select(*named(id_col, text_col))


def named(id_col: str, text_col: str) -> list[Column]:
    return [F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")]


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: bool = False) -> DataFrame:
    """Columns doc_id, row_key (a hash of id and text), row (a struct of the text, or with `rows` of the whole input row).

    Documents meet again on (doc_id, row_key), null-safe: ids that are NULL or repeat with
    another text stay apart, rows repeated in full share one result.
    """
    whole = F.struct("*") if rows else F.struct(F.col(text_col).alias(text_col))
    named = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), whole.alias("row"))
    return named.withColumn("row_key", F.xxhash64("doc_id", F.col("row")[text_col]))


def rejoin(rows: DataFrame, facts: DataFrame, how: str = "left") -> DataFrame:
    """`facts` (at most one row per document) back on the documents made by `keyed`."""
    right = facts.withColumnsRenamed({"doc_id": "_id", "row_key": "_k"})
    met = (F.col("row_key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return rows.join(right, met, how).drop("_id", "_k")


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder: later readers survive lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_texts(
    docs: DataFrame, work: Callable[[Iterator[tuple[list, list]]], Iterator[dict[str, list]]], schema: str
) -> DataFrame:
    """Arrow batches of (ids, texts) through `work`, which gives columns; NULL text comes as None.

    A column `row` of `docs` goes along unseen; `work` must then keep batches as they are.
    """
    carried = "row" in docs.columns
    frame = docs.select("doc_id", "text", *["row"] * carried)
    if carried:
        schema += f", row {docs.schema['row'].dataType.simpleString()}"
    arrow = arrow_schema(frame.sparkSession, schema)

    def run(batches):
        rows = []

        def pairs():
            for b in small(batches):
                rows.append(b)
                yield b.column(0).to_pylist(), b.column(1).to_pylist()

        for columns in work(pairs()):
            if carried:
                columns["row"] = rows[-1].column(2)
            yield pa.RecordBatch.from_pydict(columns, schema=arrow)
            rows.clear()

    return frame.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def small(batches, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in batches that stay small even when texts are long."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def hash_sample(docs: DataFrame, rows: int) -> DataFrame:
    """About `rows` documents by the hash of their ids (all, if there are fewer), wherever they lie."""
    n = docs.count()
    return docs.where(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1_000_000)) < 1_000_000 * rows // n) if n > rows else docs


def join_spans(spans: list[tuple[int, int, str]], order: dict[str, int]) -> str:
    """kind:start:end, comma-joined, by start and then by kind as listed."""
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], order[x[2]], x[1])))


def clear_of(spans: list[tuple[int, int, str]], taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Those of `spans` that overlap none of `taken`, nor an earlier one of their own."""
    kept, at, last = [], 0, -1
    reach = sorted((s, e) for s, e, _ in taken)
    furthest = -1  # end of all taken spans that begin before the current one
    for s, e, k in sorted(spans):
        while at < len(reach) and reach[at][0] < e:
            furthest = max(furthest, reach[at][1])
            at += 1
        if s >= furthest and s >= last:
            kept.append((s, e, k))
            last = e
    return kept
