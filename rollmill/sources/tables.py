"""Reading the engine's inputs (S11) and writing its datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The column names trainers expect, per dataset kind.
EXPORT_COLUMNS = {
    "sft": ("prompt", "response"),
    "preference": ("prompt", "chosen", "rejected"),
    "unpaired": ("prompt", "completion", "label"),
    "prompts": ("prompt",),
}

ROLLOUT_SCHEMA = (
    "run_id string, step bigint, prompt_id bigint, prompt string, gold bigint, "
    "sample_id bigint, response string, reward double"
)
TOKEN_LOG_SCHEMA = "sample_id bigint, tokens array<string>, lp array<double>, entropy array<double>"


# Schemas of the given tables, so that planning a query reads no file footers.
TABLES = {
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{root}/{name}.parquet")


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Hash a bare scan by a unique key if it has fewer splits than the cluster has cores.

    Meant for work that grows inside the row, such as splitting texts. A large
    table has splits enough and is left alone.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, key) if scan.rdd.getNumPartitions() < cores else scan


def read_log(spark: SparkSession, path: str, schema: str = ROLLOUT_SCHEMA, fmt: str = "parquet") -> DataFrame:
    """Rollout, label or token logs; JSON and Parquet, schema given, never inferred. With `fmt` 'table' `path` is a registered table,
    whose buckets spare later shuffles."""
    if fmt == "table":
        return spark.table(path).to(StructType.fromDDL(schema))
    return spark.read.schema(schema).format(fmt).load(path)


def checked_log(spark: SparkSession, path: str, schema: str, aligned: Sequence[str] = ()) -> DataFrame:
    """JSON log rows with `raw` (the line, if it could not be read in full) and `defect`.

    'malformed': no JSON, or a value of another type than the schema's (the other values of the row are kept). 'ragged': the array columns
    `aligned` differ in length, or only some are NULL. 'none': a good row. Blank lines are no rows; columns that the schema does not name are not read.
    """
    rows = spark.read.schema(f"{schema}, raw string").option("columnNameOfCorruptRecord", "raw").json(path)
    sizes = [F.coalesce(F.size(a), F.lit(-1)) for a in aligned]
    ragged = F.greatest(*sizes) != F.least(*sizes) if len(sizes) > 1 else F.lit(False)
    return rows.withColumn("defect", F.when(F.col("raw").isNotNull(), "malformed").when(ragged, "ragged").otherwise("none"))


def quarantine_log(
    spark: SparkSession, path: str, home: str, schema: str, aligned: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Good rows of a JSON log, and the rows set apart with their `defect`.

    The log is parsed once and written to `home`, a folder per defect, so that either side reads its own files alone.
    """
    checked = checked_log(spark, path, schema, aligned)
    checked.write.partitionBy("defect").parquet(home)
    both = spark.read.schema(checked.schema).parquet(home)
    return both.where("defect = 'none'").drop("raw", "defect"), both.where("defect != 'none'")


def arrays_to_long(df: DataFrame, ids: Sequence[str], arrays: Mapping[str, str], pos: str = "pos") -> DataFrame:
    """One row per position of parallel array columns (`arrays`: array column -> value name).

    Shorter arrays are padded with NULL, as in a ragged log.
    """
    zipped = F.arrays_zip(*[F.col(a).alias(v) for a, v in arrays.items()])
    return df.select(*ids, F.posexplode(zipped).alias(pos, "_z")).select(
        *ids, F.col(pos).cast("bigint").alias(pos), *[F.col("_z")[v].alias(v) for v in arrays.values()]
    )


def export_rows(df: DataFrame, kind: str, by: Sequence[str] = ()) -> DataFrame:
    """Project to the export names of `kind`; unpaired labels become booleans."""
    if kind not in EXPORT_COLUMNS:
        raise ValueError(f"no export kind {kind!r}; known: {sorted(EXPORT_COLUMNS)}")
    cols = [F.col(c).cast("boolean") if c == "label" else F.col(c) for c in EXPORT_COLUMNS[kind]]
    return df.select(*by, *[c.alias(n) for c, n in zip(cols, EXPORT_COLUMNS[kind], strict=True)])


def write_dataset(
    df: DataFrame, kind: str, path: str, fmt: str = "json", by: Sequence[str] = (), mode: str = "errorifexists"
) -> None:
    """Export for training, one folder per value of `by`."""
    writer = export_rows(df, kind, by).write.mode(mode).format(fmt)
    if by:
        writer = writer.partitionBy(*by)
    writer.save(path)
