"""Policy-gradient objectives as logged metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.functions.losses import (
    cispo_weight,
    is_clipped,
    seq_ratio,
    token_ratio,
)

STEP = ("run_id", "step")


def step_loss(rows: DataFrame, loss: Column, by: Sequence[str] = STEP, **extra: Column) -> DataFrame:
    """Loss summed per step, with any further aggregates in the same pass."""
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(loss).alias("loss"), *[c.alias(n) for n, c in extra.items()]
    )


def align_tokens(a: DataFrame, b: DataFrame, ids: Sequence[str] = ("sample_id",), pos: str = "pos") -> DataFrame:
    """Two token logs of the same samples over the positions both have."""
    return a.join(b, [*ids, pos])


def zip_logs(
    a: DataFrame, b: DataFrame, lp_a: str, lp_b: str, ids: Sequence[str] = ("sample_id",), pos: str = "pos"
) -> DataFrame:
    """Two logs with one array per sample (`lp_a` in `a`, `lp_b` in `b`) as tokens, over the positions both have.

    The logs meet once, sample by sample, and are cut to the shorter array inside the row; tokens are never joined.
    A sample that either log lacks, or has no array for, gives no tokens.
    """
    met = a.select(*ids, lp_a).join(b.select(*ids, lp_b), list(ids))
    both = F.least(F.size(lp_a), F.size(lp_b))
    zipped = F.arrays_zip(*[F.slice(c, F.lit(1), both).alias(c) for c in (lp_a, lp_b)])
    cells = met.where(both > 0).select(*ids, F.posexplode(zipped).alias(pos, "_z"))
    return cells.select(*ids, F.col(pos).cast("bigint").alias(pos), *[F.col("_z")[c].alias(c) for c in (lp_a, lp_b)])


def cispo_loss(
    tokens: DataFrame,
    advantages: DataFrame,
    ids: Sequence[str] = ("sample_id",),
    lp: str = "lp_new",
    lp_old: str = "lp_old",
    eps_high: float = 0.30,
    eps_low: float | None = None,
    scale: float = 5.0,
) -> DataFrame:
    """Per sample -adv * sum(w * lp) / (scale * L).

    The advantage is constant within a sample, so tokens are summed first and
    meet it as one row per sample.
    """
    weight = cispo_weight(F.col(lp), F.col(lp_old), eps_high, eps_low)
    clipped = is_clipped(token_ratio(F.col(lp), F.col(lp_old)), None if eps_low is None else 1 - eps_low, 1 + eps_high)
    sums = tokens.groupBy(*ids).agg(
        F.count(F.lit(1)).alias("n_overlap"),
        F.sum(weight * F.col(lp)).alias("weighted_lp"),
        F.max(weight).alias("max_weight"),
        F.count_if(clipped).alias("n_clipped"),
    )
    return sums.join(advantages, list(ids)).withColumn(
        "loss", -F.col("adv") * F.col("weighted_lp") / (F.lit(float(scale)) * F.col("n_overlap"))
    )


def opd_reverse_kl(
    tokens: DataFrame, ids: Sequence[str], lp_student: str, lp_teacher: str, scale: float = 5.0
) -> DataFrame:
    """Sampled reverse KL and distillation loss per rollout; the teacher's edge is the token advantage."""
    s = F.col(lp_student)
    adv = F.col(lp_teacher) - s
    return tokens.groupBy(*ids).agg(
        F.count(F.lit(1)).alias("n_overlap"),
        (-F.avg(adv)).alias("mean_reverse_kl"),
        (-F.sum(adv * s) / (F.lit(float(scale)) * F.count(F.lit(1)))).alias("loss"),
    )


def entropy_bonus_loss(
    scored: DataFrame, advantages: DataFrame, ids: Sequence[str], beta: float = 0.05, scale: float = 5.0
) -> DataFrame:
    """Policy loss less an entropy bonus.

    `scored` has sum_lp and mean_h per sample. Samples of groups without
    signal are absent from `advantages`: they keep their entropy, loss NULL.
    """
    loss = -F.col("adv") * F.col("sum_lp") / F.lit(float(scale)) - F.lit(float(beta)) * F.col("mean_h")
    return scored.join(advantages, list(ids), "left").withColumn("loss", loss)


def ratio_report(
    rows: DataFrame,
    by: Sequence[str] = STEP,
    lp: str = "lp_new",
    lp_old: str = "lp_old",
    n_tok: str = "n_tok",
    plain_eps: tuple[float, float] = (0.2, 0.28),
    seq_eps: float = 0.10,
) -> DataFrame:
    """O9 over summed logs: a sequence's plain and length-normalised importance ratios, side by side."""
    plain = token_ratio(F.col(lp), F.col(lp_old))
    normed = seq_ratio(F.col(lp), F.col(lp_old), F.col(n_tok))
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for name, ratio, lo, hi in (
        ("plain", plain, 1 - plain_eps[0], 1 + plain_eps[1]),
        ("seq", normed, 1 - seq_eps, 1 + seq_eps),
    ):
        aggs += [
            F.avg(ratio).alias(f"{name}_mean"),
            F.min(ratio).alias(f"{name}_min"),
            F.max(ratio).alias(f"{name}_max"),
            F.avg(is_clipped(ratio, lo, hi).cast("double")).alias(f"{name}_clipped"),
        ]
    return rows.groupBy(*by).agg(*aggs)


def token_ratio_report(
    tokens: DataFrame,
    ids: Sequence[str],
    by: Sequence[str],
    lp: str = "lp_new",
    lp_old: str = "lp_old",
    token_eps: tuple[float, float] = (0.2, 0.28),
    seq_eps: float = 0.10,
) -> DataFrame:
    """O9 over a token log: ratios token by token next to one length-normalised ratio per sample.

    Tokens are summed per sample first, so a slice of any size meets as one row per sample.
    """
    ratio = token_ratio(F.col(lp), F.col(lp_old))
    sums = tokens.groupBy(*ids, *by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(lp).alias("_lp"),
        F.sum(lp_old).alias("_old"),
        F.sum(ratio).alias("_sum"),
        F.min(ratio).alias("_min"),
        F.max(ratio).alias("_max"),
        F.count_if(is_clipped(ratio, 1 - token_eps[0], 1 + token_eps[1])).alias("_cut"),
    )
    seq = seq_ratio(F.col("_lp"), F.col("_old"), F.col("n"))
    return sums.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("n").alias("n_tok"),
        (F.sum("_sum") / F.sum("n")).alias("token_mean"),
        F.min("_min").alias("token_min"),
        F.max("_max").alias("token_max"),
        (F.sum("_cut") / F.sum("n")).alias("token_clipped"),
        F.avg(seq).alias("seq_mean"),
        F.min(seq).alias("seq_min"),
        F.max(seq).alias("seq_max"),
        F.avg(is_clipped(seq, 1 - seq_eps, 1 + seq_eps).cast("double")).alias("seq_clipped"),
    )
