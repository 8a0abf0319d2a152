"""Sessions for local runs, and the shared folder for written state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "rollmill", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benches; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's `spark.checkpoint.dir`.

    A local session that names none gets a temporary folder; on a cluster the
    executors would each write to their own disk, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """`df` as a table in the shared folder, for plans that read it more than once; later readers survive lost executors.

    `compression`: Parquet's, if not the session's."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
