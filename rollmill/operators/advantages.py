"""Group statistics, baselines and advantages.

A group is the set of samples of one prompt at one step. Its statistics are
built by partial aggregation and joined back, so a group of any size is
reduced on the map side and its rows are never gathered in one task. Rows that are
known to lie by group (`Grouped`) take them from windows, hot groups by partial aggregation still.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.functions.numerics import clip
from rollmill.plans.scale import attach, linear_scan, running_total
from rollmill.plans.session import written
from rollmill.sources.layout import Grouped

KEYS = ("run_id", "step", "prompt_id")

# Added to the deviation after the root; variance taken as zero; tolerance on a difference.
SIGMA_EPS = 1e-6
ZERO_VAR = 1e-12
ZERO_ADV = 1e-9


def group_facts(reward: str = "reward") -> dict[str, Column]:
    """The aggregates of A1; variance over the population."""
    r = F.col(reward)
    return {
        "k": F.count(r),
        "r_sum": F.sum(r),
        "mu": F.avg(r),
        "var": F.var_pop(r),
        "r_min": F.min(r),
        "r_max": F.max(r),
        "n_correct": F.count_if(r == 1.0),
    }


def group_stats(rollouts: DataFrame | Grouped, keys: Sequence[str] = KEYS, reward: str = "reward") -> DataFrame:
    """A1: one row per group."""
    rows = rollouts.rows if isinstance(rollouts, Grouped) else rollouts
    return with_sigma(rows.groupBy(*keys).agg(*[c.alias(n) for n, c in group_facts(reward).items()]))


def with_sigma(stats: DataFrame) -> DataFrame:
    return stats.withColumn("sigma", F.sqrt("var") + F.lit(SIGMA_EPS))


def has_signal(mode: str) -> Column:
    """A2: whether a group (A1 columns) can move the policy. The tests differ on purpose.

    equal: rewards not all equal; var: variance not negligible; all01: neither
    all 1 nor all 0; tol: some reward away from the mean.
    """
    lo, hi = F.col("r_min"), F.col("r_max")
    tests = {
        "equal": lo != hi,
        "var": F.col("var") >= ZERO_VAR,
        "all01": ~((lo == hi) & lo.isin(0.0, 1.0)),
        "tol": F.greatest(hi - F.col("mu"), F.col("mu") - lo) >= ZERO_ADV,
    }
    if mode not in tests:
        raise ValueError(f"no signal test {mode!r}; known: {sorted(tests)}")
    return tests[mode]


def with_group_stats(
    rollouts: DataFrame | Grouped, keys: Sequence[str] = KEYS, reward: str = "reward", mode: str | None = None
) -> DataFrame:
    """Rows with their group's statistics; `mode` drops groups without signal.

    Grouped rows take them from a window over what lies together anyway; of other tables the statistics are aggregated
    and joined back, groups without signal being dropped before the join.
    """
    if isinstance(rollouts, Grouped):
        found = with_sigma(rollouts.with_facts(group_facts(reward)))
        return found if mode is None else found.where(has_signal(mode))
    stats = group_stats(rollouts, keys, reward)
    if mode is None:
        return attach(rollouts, stats, keys)
    return attach(rollouts, stats.where(has_signal(mode)), keys, "inner")


def drop_no_signal(
    rollouts: DataFrame | Grouped, mode: str = "equal", keys: Sequence[str] = KEYS, reward: str = "reward"
) -> DataFrame:
    """A2: the rows of groups with signal."""
    if isinstance(rollouts, Grouped):
        return with_group_stats(rollouts, keys, reward, mode).drop(*group_facts(reward), "sigma")
    kept = group_stats(rollouts, keys, reward).where(has_signal(mode)).select(*keys)
    return attach(rollouts, kept, keys, "inner")


def centred(reward: str = "reward") -> Column:
    return F.col(reward) - F.col("mu")


def adv_mean(rollouts: DataFrame | Grouped, keys: Sequence[str] = KEYS, reward: str = "reward") -> DataFrame:
    """A3: reward less the group mean; rows with no advantage are dropped."""
    return with_group_stats(rollouts, keys, reward, "equal").withColumn("adv", centred(reward)).where("adv != 0")


def adv_grpo(rollouts: DataFrame | Grouped, keys: Sequence[str] = KEYS, reward: str = "reward") -> DataFrame:
    """A4: z-score within the group."""
    return with_group_stats(rollouts, keys, reward, "var").withColumn("adv", centred(reward) / F.col("sigma"))


def adv_dr_grpo(rollouts: DataFrame | Grouped, keys: Sequence[str] = KEYS, reward: str = "reward") -> DataFrame:
    """A5: reward less the group mean, without the deviation; zero rows stay."""
    return with_group_stats(rollouts, keys, reward, "equal").withColumn("adv", centred(reward))


def adv_rloo(rollouts: DataFrame | Grouped, keys: Sequence[str] = KEYS, reward: str = "reward") -> DataFrame:
    """Reward less the mean of the other samples."""
    others = (F.col("r_sum") - F.col(reward)) / F.nullif(F.col("k") - 1, F.lit(0))
    return with_group_stats(rollouts, keys, reward, "equal").withColumn("adv", F.col(reward) - others).where("adv != 0")


def ema_baseline(
    rollouts: DataFrame,
    run: Sequence[str] = ("run_id",),
    order: str = "step",
    alpha: float = 0.9,
    reward: str = "reward",
    dense: bool = False,
) -> DataFrame:
    """Per step, the running baseline before (`baseline`) and after (`baseline_next`) that step.

    `dense` promises that every run's steps are consecutive integers. The steps' means are written, as several levels read them.
    """
    means = written(rollouts.groupBy(*run, order).agg(F.avg(reward).alias("step_mean")), "steps")
    gains = means.withColumn("_gain", F.lit(1.0 - alpha) * F.col("step_mean"))
    scanned = linear_scan(gains, run, order, alpha, "_gain", "baseline_next", dense=dense)
    return scanned.withColumnRenamed("baseline_next_prev", "baseline").drop("_gain")


def adv_reinforce_pp(
    rollouts: DataFrame,
    keys: Sequence[str] = KEYS,
    reward: str = "reward",
    bound: float = 5.0,
    run: Sequence[str] = ("run_id",),
    order: str = "step",
    alpha: float = 0.9,
    dense: bool = False,
) -> DataFrame:
    """Reward less the running baseline, standardised in the group, clipped.

    The baseline is constant within a group and cancels in the z-score; it is
    kept as a column because its drift is worth watching.
    """
    base = ema_baseline(rollouts, run, order, alpha, reward, dense).select(*run, order, "baseline")
    stats = attach(group_stats(rollouts, keys, reward).where(has_signal("var")), base, [*run, order])
    shifted = F.col(reward) - F.col("baseline")
    centre = F.col("mu") - F.col("baseline")
    return attach(rollouts, stats, keys, "inner").withColumn(
        "adv", clip((shifted - centre) / F.col("sigma"), -bound, bound)
    )


def adv_lcpo(rollouts: DataFrame | Grouped, keys: Sequence[str] = KEYS, reward: str = "reward") -> DataFrame:
    """Length-charged reward less the group mean; near-zero rows are dropped."""
    return (
        with_group_stats(rollouts, keys, reward, "tol")
        .withColumn("adv", centred(reward))
        .where(F.abs("adv") >= ZERO_ADV)
    )


def skip_report(
    rollouts: DataFrame,
    keys: Sequence[str] = KEYS,
    run: Sequence[str] = ("run_id",),
    order: str = "step",
    reward: str = "reward",
    mode: str = "all01",
) -> DataFrame:
    """A10: groups and skipped groups per step, and the run's skips so far."""
    per_step = (
        group_stats(rollouts, keys, reward)
        .groupBy(*run, order)
        .agg(F.count(F.lit(1)).alias("groups"), F.count_if(~has_signal(mode)).alias("skipped"))
    )
    return running_total(written(per_step, "steps"), run, order, "skipped", "skipped_so_far")


def dynamic_sampling(rollouts: DataFrame, keys: Sequence[str] = KEYS, reward: str = "reward") -> tuple[DataFrame, DataFrame]:
    """A10: the rows of mixed groups, and the skip report."""
    return drop_no_signal(rollouts, "all01", keys, reward), skip_report(rollouts, keys, reward=reward)


def gae(
    steps: DataFrame,
    keys: Sequence[str],
    time: str,
    reward: str = "reward",
    value: str = "value",
    gamma: float = 1.0,
    lam: float = 0.95,
    keep: Sequence[str] = (),
    dense: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """Generalised advantage estimates and returns; the value after the last step is 0.

    Summing the discounted errors r_t + gamma * V_(t+1) - V_t by parts leaves two
    reverse scans (in -time) with coefficient gamma * lam: S of the rewards and W of
    the values give S_t - V_t + gamma * (1 - lam) * W_(t+1), without a division.
    `dense` promises that every trajectory's times are consecutive integers; `parts` are the partitions of the steps' shuffle.
    """
    steps = steps.select(*keys, time, reward, value, *keep)
    backward = steps.withColumn("_back", -F.col(time))
    scanned = linear_scan(backward, keys, "_back", gamma * lam, (reward, value), ("_of_r", "_of_v"), dense=dense, parts=parts)
    adv = F.expr(f"_of_r - {value} + {gamma * (1.0 - lam)!r}D * _of_v_prev")
    found = scanned.withColumn("adv", adv).drop("_back", "_of_r", "_of_r_prev", "_of_v", "_of_v_prev")
    return found.withColumn("returns", F.col("adv") + F.col(value))
