"""Evaluation and training monitors (M1-M7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.operators.advantages import KEYS, group_facts, group_stats, has_signal
from rollmill.plans.scale import attach
from rollmill.sources.layout import PART, Grouped


def accuracy(rows: DataFrame, by: Sequence[str] = ("phase",), reward: str = "reward") -> DataFrame:
    """M1: mean reward per phase (and split, if listed in `by`)."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(reward).alias("accuracy"))


def length_eval(rows: DataFrame, by: Sequence[str], reward: str, correct: str, n_tok: str) -> DataFrame:
    """M2: mean reward, accuracy and answer length."""
    return rows.groupBy(*by).agg(
        F.avg(reward).alias("mean_reward"), F.avg(correct).alias("accuracy"), F.avg(n_tok).alias("mean_tokens")
    )


def log_rows(metrics: DataFrame, every: int = 6, run: Sequence[str] = ("run_id",), order: str = "step") -> DataFrame:
    """M3: about `every` evenly spaced steps per run, and its last step."""
    last = metrics.groupBy(*run).agg(F.max(order).alias("_last"))
    stride = F.greatest(F.lit(1), F.floor((F.col("_last") + 1) / F.lit(every)))
    due = (F.col(order) % stride == 0) | (F.col(order) == F.col("_last"))
    return attach(metrics, last, run).where(due).drop("_last")


def entropy_track(rows: DataFrame, arm: str = "arm", order: str = "step", entropy: str = "mean_h") -> DataFrame:
    """M4: mean entropy per arm and step."""
    return rows.groupBy(arm, order).agg(F.count(F.lit(1)).alias("n"), F.avg(entropy).alias("entropy"))


def entropy_drift(track: DataFrame, arm: str = "arm", order: str = "step") -> DataFrame:
    """M4: first and last entropy of each arm and the change between them."""
    return (
        track.groupBy(arm)
        .agg(F.min_by("entropy", order).alias("first"), F.max_by("entropy", order).alias("last"))
        .withColumn("delta", F.col("last") - F.col("first"))
    )


def arm_compare(
    track: DataFrame, control: str, treatment: str, arm: str = "arm", order: str = "step"
) -> DataFrame:
    """M5: both arms side by side per step.

    A difference need not be one factor's doing: in an entropy-bonus arm the
    sampling temperature usually differs too.
    """
    at = {n: F.max(F.when(F.col(arm) == v, F.col("entropy"))) for n, v in (("control", control), ("treatment", treatment))}
    return (
        track.groupBy(order)
        .agg(*[c.alias(n) for n, c in at.items()])
        .withColumn("difference", F.col("treatment") - F.col("control"))
    )


def step_report(
    rollouts: DataFrame | Grouped,
    keys: Sequence[str] = KEYS,
    by: Sequence[str] = ("run_id", "step"),
    reward: str = "reward",
    mode: str = "var",
) -> DataFrame:
    """M6: what a training step prints: samples, rewards, kept and skipped groups; `by` is among `keys`.

    Rewards come as mean, deviation, range and count of correct ones; `reward_pages` lists them. Grouped rows are read once:
    each knows its group's statistics and counts as its share of the group.
    """
    r = F.col(reward)
    facts = [
        F.count(r).alias("samples"),
        F.count_if(r == 1.0).alias("n_correct"),
        F.avg(r).alias("mu"),
        F.min(r).alias("r_min"),
        F.max(r).alias("r_max"),
    ]
    # straight from the rewards: mean squares less squared means would cancel
    spread = F.stddev_pop(r).alias("sigma")
    names = {"kept": has_signal(mode), "skipped": ~has_signal(mode)}
    if isinstance(rollouts, Grouped):
        # facts keep apart from the rows' own columns that share a name
        rows = Grouped(rollouts.rows.select(*keys, r, PART), rollouts.keys, rollouts.hot).with_facts(group_facts(reward))
        groups = [F.round(F.sum(F.when(r.isNotNull() & met, 1 / F.col("k")).otherwise(0.0))).cast("bigint").alias(n) for n, met in names.items()]
        return rows.groupBy(*by).agg(*facts, *groups, spread)
    stats = group_stats(rollouts, keys, reward).groupBy(*by).agg(*[F.count_if(met).alias(n) for n, met in names.items()])
    return attach(rollouts.groupBy(*by).agg(*facts, spread), stats, by)


def reward_pages(
    rollouts: DataFrame, keys: Sequence[str] = KEYS, reward: str = "reward", position: str = "sample_id", size: int = 1024
) -> DataFrame:
    """M6: the rewards themselves: keys, page, rewards. `position` counts a group's samples, each page holds `size` of them at
    most, in order, so that no list grows with its group."""
    page = F.floor(F.col(position) / F.lit(size)).alias("page")
    listed = F.sort_array(F.collect_list(F.struct(F.col(position).alias("at"), F.col(reward).alias("r"))))
    return rollouts.groupBy(*keys, page).agg(F.transform(listed, lambda x: x["r"]).alias("rewards"))


def metric_history(report: DataFrame, ids: Sequence[str], names: Sequence[str]) -> DataFrame:
    """A report as long metric rows: ids, name, value."""
    values = [F.col(n).cast("double").alias(n) for n in names]
    return report.select(*ids, *values).unpivot(list(ids), list(names), "name", "value")


def any_correct_at_k(
    rollouts: DataFrame,
    ks: Sequence[int] = (1, 2, 4),
    keys: Sequence[str] = KEYS,
    by: Sequence[str] = ("run_id",),
    reward: str = "reward",
    position: str = "sample_id",
) -> DataFrame:
    """M7: share of groups with a correct answer among their first k, for several k in one pass."""
    hit = [F.max(F.when((F.col(position) < k) & (F.col(reward) == 1.0), 1.0).otherwise(0.0)).alias(f"at_{k}") for k in ks]
    return (
        rollouts.groupBy(*keys)
        .agg(*hit)
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("groups"), *[F.avg(f"at_{k}").alias(f"at_{k}") for k in ks])
    )
