"""Rollout logs arriving as streams (T1-T4). The caller owns source, sink and trigger.

T1 and T4 are plain streaming plans. T2 and T3 run the batch operators on every
micro-batch (`drain_batches`), so a run or group of any size is split as in a batch job.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rollmill.functions.verifiers import first_int_reward
from rollmill.operators.advantages import SIGMA_EPS, group_stats, has_signal
from rollmill.plans.scale import attach, dense_index, linear_scan
from rollmill.plans.session import shared_dir


def reward_windows(
    stream: DataFrame,
    time: str = "ts",
    by: Sequence[str] = (),
    reward: str = "reward",
    width: str = "1 hour",
    slide: str | None = None,
    gap: str | None = None,
    late: str = "10 minutes",
) -> DataFrame:
    """Mean reward, count and whether all rewards are equal, per time window.

    Tumbling by default, sliding with `slide`, session windows with `gap`.
    Rows later than the watermark are dropped by Spark.
    """
    span = F.session_window(time, gap) if gap else F.window(time, width, slide)
    return (
        stream.withWatermark(time, late)
        .groupBy(span.alias("w"), *by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(reward).alias("mean_reward"),
            (F.min(reward) == F.max(reward)).alias("no_signal"),
        )
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n", "mean_reward", "no_signal")
    )


#: Rows of a micro-batch and the state before it, None at first -> rows to return and the state after it.
Step = Callable[[DataFrame, DataFrame | None], tuple[DataFrame, DataFrame]]


def ema_baseline_step(run: Sequence[str], order: str, reward: str = "reward", alpha: float = 0.9) -> Step:
    """Per step, its mean reward and the run's baseline before and after it, as A7 has them.

    State: one row per run with its last step, baseline and number of steps.
    `order` is an integer. Steps arrive whole and in order: one at or before its run's last step is an error,
    since later baselines have been reported already.
    """
    run = list(run)

    def step(batch: DataFrame, state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        means = batch.groupBy(*run, order).agg(F.avg(reward).alias("step_mean"))
        facts = means.groupBy(*run).agg(F.min(order).alias("_first"), F.max(order).alias("_end"), F.count(F.lit(1)).alias("_n"))
        if state is None:
            facts = facts.selectExpr("*", "0D as _start", "0L as _seen")
        else:
            known = state.withColumnsRenamed({"last": "_last", "baseline": "_start", "seen": "_seen"})
            late = "case when _first <= _last then raise_error('a step came after a later step of its run') else _first end"
            facts = attach(facts, known, run).withColumns(
                {"_first": F.expr(late), "_start": F.expr("coalesce(_start, 0D)"), "_seen": F.expr("coalesce(_seen, 0L)")}
            )
        # the run's baseline enters with its first new step, which the scan then carries on
        gain = f"{1.0 - alpha!r}D * step_mean + case when {order} = _first then {alpha!r}D * _start else 0D end"
        steps = attach(means, facts, run).withColumn("_gain", F.expr(gain))
        steps = dense_index(steps, run, order, "_at")
        scanned = linear_scan(steps, run, "_at", alpha, "_gain", "baseline_next", dense=True).selectExpr(
            *run,
            order,
            "step_mean",
            "case when _at = 0 then _start else baseline_next_prev end as baseline",
            "baseline_next",
            "_seen + _at + 1 as seen",
            f"{order} = _end as _ends",
        )
        ends = scanned.where("_ends").selectExpr(*run, f"{order} as last", "baseline_next as baseline", "seen")
        if state is not None:
            moved = ends.select(*run, F.lit(True).alias("_moved"))
            ends = ends.unionByName(attach(state, moved, run).where("_moved is null").drop("_moved"))
        return scanned.drop("_ends"), ends

    return step


def group_advantage_step(
    keys: Sequence[str],
    time: str,
    sample: str = "sample_id",
    reward: str = "reward",
    k: int = 4,
    kind: str = "grpo",
    wait: str = "1 hour",
) -> Step:
    """Advantages as soon as k samples of a group have arrived, in order of the integer `sample`.

    State: the samples of groups that are still short, fewer than k a group. They come out
    with complete = false once an event `wait` later than the group's last one is seen; samples that come
    after that, or after the k-th, start a new group. A group without any time is not held. `signal` tells the groups that A4 (grpo) or A6 (rloo)
    keep; without it adv is 0 or next to it.
    """
    if kind not in ("grpo", "rloo"):
        raise ValueError(f"kind is 'grpo' or 'rloo', not {kind!r}")
    chunk = [*keys, "_chunk"]
    if kind == "grpo":
        adv = f"({reward} - mu) / (sqrt(var) + {SIGMA_EPS!r}D)"
    else:
        adv = f"coalesce({reward} - (r_sum - {reward}) / nullif(k - 1, 0), 0D)"

    def step(batch: DataFrame, state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        rows = batch.select(*keys, time, sample, reward)
        if state is not None:
            rows = state.unionByName(rows)
        rows = dense_index(rows, keys, sample, "_at").withColumn("_chunk", F.expr(f"_at div {k}"))
        stats = attach(
            group_stats(rows, chunk, reward).withColumn("signal", has_signal("var" if kind == "grpo" else "equal")),
            rows.groupBy(*chunk).agg(F.max(time).alias("_latest")),
            chunk,
        )
        now = rows.agg(F.max(time)).scalar()
        stats = stats.select(
            *chunk, "k", "mu", "var", "r_sum", "signal",
            (F.col("k") == k).alias("complete"),
            F.coalesce(F.col("_latest") + F.expr(f"interval {wait}") <= now, F.lit(True)).alias("_over"),
        )
        judged = attach(rows, stats, chunk).withColumn("adv", F.expr(adv))
        held = judged.where("not complete and not _over").select(*keys, time, sample, reward)
        done = judged.where("complete or _over")
        return done.select(*keys, sample, reward, "k", "adv", "signal", "complete"), held

    return step


def rejection_stream(
    stream: DataFrame, text: Column, gold: Column, ids: Sequence[str], time: str = "ts", late: str = "10 minutes"
) -> DataFrame:
    """T4: verified rows, each id once even if the log repeats it within the watermark."""
    return (
        stream.where(first_int_reward(text, gold) == 1.0)
        .withWatermark(time, late)
        .dropDuplicatesWithinWatermark(list(ids))
    )


def parquet_stream(spark: SparkSession, folder: str, pattern: str, per_batch: int | None = None) -> DataFrame:
    """A Parquet table of `folder`, one file or a folder of them, as a stream; its schema comes from the footers.

    A bare file is no stream source, a pattern that matches it is: the last character becomes a class of one.
    """
    path = f"{folder}/{pattern[:-1]}[{pattern[-1]}]"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(path)


def drain(stream: DataFrame, name: str) -> DataFrame:
    """Process everything available into a table in the shared folder, and read that table."""
    spark = stream.sparkSession
    home = shared_dir(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{home}/rows")
        .option("checkpointLocation", f"{home}/state")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{home}/rows")


def drain_batches(stream: DataFrame, name: str, step: Step, home: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Process everything available batch by batch; the returned rows of all batches, and the state after the last.

    `home` is a folder that executors share (default: a new one in the shared folder). Started again with the same one, by
    another session too, the stream goes on after the last batch that was finished: Spark's log there knows what was read, and

    * rows of batch n lie in rows/batch_number=n;
    * state after batch n lies in state/0 or state/1, by turns, so that the state before a batch outlives it and no older one is kept;
    * batches/batch_number=n, written last, has the schemas of both.

    A batch that is run again writes the same once more.
    """
    spark = stream.sparkSession
    home = (home or shared_dir(spark, name)).rstrip("/")
    schemas = {}

    def state_after(session: SparkSession, number: int) -> DataFrame:
        return session.read.schema(schemas["state"]).parquet(f"{home}/state/{number % 2}")

    def run(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        if number and not schemas:
            schemas.update(finished(session, home, number - 1))
        rows, after = step(batch, state_after(session, number - 1) if number else None)
        rows.write.mode("overwrite").parquet(f"{home}/rows/batch_number={number}")
        after.write.mode("overwrite").parquet(f"{home}/state/{number % 2}")
        marker = [(rows.schema.json(), after.schema.json())]
        session.createDataFrame(marker, MARKER).coalesce(1).write.mode("overwrite").json(f"{home}/batches/batch_number={number}")
        schemas.update(rows=rows.schema, state=after.schema, last=number)

    query = (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", f"{home}/log")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    schemas = schemas or finished(spark, home)
    if not schemas:  # a source without files runs no batch
        return step(spark.createDataFrame([], stream.schema), None)
    read = spark.read.schema(StructType([*schemas["rows"], StructField("batch_number", LongType())]))
    rows = read.parquet(f"{home}/rows").where(F.col("batch_number") <= schemas["last"]).drop("batch_number")
    return rows, state_after(spark, schemas["last"])


MARKER = "rows string, state string"


def finished(spark: SparkSession, home: str, number: int | None = None) -> dict:
    """Schemas (`rows`, `state`) and number (`last`) of batch `number`, or of the last one; empty if there is none."""
    try:
        found = spark.read.schema(f"{MARKER}, batch_number bigint").json(f"{home}/batches")
        wanted = F.lit(True) if number is None else F.col("batch_number") == number
        last = found.where(wanted).orderBy(F.desc("batch_number")).first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        last = None
    if last is None:
        if number is not None:
            raise ValueError(f"the log in {home} is at batch {number + 1}, but batch {number} left no state there")
        return {}
    return {"last": last.batch_number} | {k: StructType.fromJson(json.loads(last[k])) for k in ("rows", "state")}
