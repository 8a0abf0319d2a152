"""Preference datasets: anchors, reports and linear scorers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.functions.losses import (
    dpo_loss,
    ipo_loss,
    ipo_target,
    log_ratio,
    orpo_odds_loss,
    orpo_sft_loss,
    pair_margin,
    simpo_loss,
    simpo_target,
)
from rollmill.functions.numerics import neg_log_sigmoid, sigmoid, words
from rollmill.plans.scale import attach

PAIR_LPS = ("lp_c", "lp_r", "lpref_c", "lpref_r")
#: Hash slots of a scorer's words. A fit holds a few vectors of this length in the driver and in each task.
SLOTS = 1 << 18


def dpo_metrics(pairs: DataFrame, beta: float = 0.1) -> DataFrame:
    """Margin, loss and strict accuracy per pair."""
    cols = [F.col(c) for c in PAIR_LPS]
    margin = pair_margin(*cols)
    return (
        pairs.withColumn("margin", margin)
        .withColumn("loss", dpo_loss(*cols, beta))
        .withColumn("correct", (margin > 0).cast("bigint"))
    )


def kto_z0(df: DataFrame, scope: str = "global", lp: str = "lp", ref: str = "ref", batch: Sequence[str] = ()) -> DataFrame:
    """The anchor z0, the mean log-ratio over everything or per batch."""
    mean = F.avg(log_ratio(F.col(lp), F.col(ref))).alias("z0")
    if scope == "global":
        return df.withColumn("z0", df.agg(mean).scalar())
    if scope == "batch":
        return attach(df, df.groupBy(*batch).agg(mean), batch)
    raise ValueError(f"scope is 'global' or 'batch', not {scope!r}")


def report_figures(beta: float, simpo_beta: float, gamma: float, lambda_: float) -> dict[str, Column]:
    """What P8 averages, per pair."""
    lps = [F.col(c) for c in PAIR_LPS]
    margin = pair_margin(*lps)
    mean_c = F.col("lp_c") / F.greatest("n_c", F.lit(1))
    mean_r = F.col("lp_r") / F.greatest("n_r", F.lit(1))
    sft = orpo_sft_loss(F.col("lp_c"), F.col("n_c"))
    odds = orpo_odds_loss(mean_c, mean_r, lambda_)
    above = (mean_c - mean_r) > F.lit(simpo_target(simpo_beta, gamma))
    return {
        "dpo_loss": dpo_loss(*lps, beta),
        "margin": margin,
        "accuracy": (margin > 0).cast("double"),
        "ipo_loss": ipo_loss(*lps, beta),
        "ipo_gap": margin - F.lit(ipo_target(beta)),
        "orpo_sft": sft,
        "orpo_odds": odds,
        "orpo_loss": sft + odds,
        "simpo_loss": simpo_loss(mean_c, mean_r, simpo_beta, gamma),
        "mean_lp_gap": mean_c - mean_r,
        "simpo_above": above.cast("double"),
    }


def preference_report(
    pairs: DataFrame,
    by: Sequence[str],
    beta: float = 0.1,
    simpo_beta: float = 2.5,
    gamma: float = 1.4,
    lambda_: float = 0.5,
) -> DataFrame:
    """Every preference loss and margin, averaged per slice in one pass."""
    figures = report_figures(beta, simpo_beta, gamma, lambda_)
    return pairs.groupBy(*by).agg(F.count(F.lit(1)).alias("n_pairs"), *[F.avg(c).alias(n) for n, c in figures.items()])


def preference_rollup(
    pairs: DataFrame,
    by: Sequence[str],
    beta: float = 0.1,
    simpo_beta: float = 2.5,
    gamma: float = 1.4,
    lambda_: float = 0.5,
) -> DataFrame:
    """P8 at every level of `by`: its slices, each shorter prefix of it, and the whole table.

    Columns: level (grouping_id: 0 for the slices, all bits set for the total), `by` (NULL where a level has none), n_pairs, figures.
    Only one row per slice is expanded over the levels: pairs are summed once, and NULL figures are left out as in an average.
    """
    figures = report_figures(beta, simpo_beta, gamma, lambda_)
    parts = [c for n, x in figures.items() for c in (F.sum(x).alias(f"{n}_sum"), F.count(x).alias(f"{n}_n"))]
    slices = pairs.groupBy(*by).agg(F.count(F.lit(1)).alias("_pairs"), *parts)
    averages = [(F.sum(f"{n}_sum") / F.nullif(F.sum(f"{n}_n"), F.lit(0))).alias(n) for n in figures]
    return slices.rollup(*by).agg(F.grouping_id().alias("level"), F.sum("_pairs").alias("n_pairs"), *averages)


@dataclass(frozen=True)
class MarginScorer:
    """Weights of pair features at the optimum of a convex loss, and the gradient's norm there."""

    weights: dict[str, float]
    gradient_norm: float
    steps: int

    def margin(self, features: Mapping[str, Column]) -> Column:
        return reduce(add, [F.lit(w) * features[n] for n, w in self.weights.items()])


def fit_margin_scorer(
    pairs: DataFrame,
    features: Mapping[str, Column],
    kind: str = "bt",
    beta: float = 0.1,
    l2: float = 1e-3,
    tolerance: float = 1e-9,
    most_steps: int = 100,
) -> MarginScorer:
    """P9 with a certificate: a linear scorer of a few pair features, fitted by Newton steps whose sums come from the cluster.

    `features` are differences between chosen and rejected. 'bt' minimises the Bradley-Terry loss, 'ls' half the squared
    distance to IPO's target, both per pair, with `l2` / 2 times the squared weights added. A step is one aggregate over the pairs: loss,
    gradient and Hessian as column sums, one row to the driver whatever the table's size; a step that does not lower the loss is halved. It ends
    when the gradient is at most `tolerance`, an error otherwise. Pairs with a NULL feature take no part; without pairs all weights are 0.
    """
    if kind not in ("bt", "ls"):
        raise ValueError(f"kind is 'bt' or 'ls', not {kind!r}")
    names, d = list(features), len(features)
    corner = [(i, j) for i in range(d) for j in range(i, d)]
    x = pairs.select(*[features[n].cast("double").alias(f"x{i}") for i, n in enumerate(names)]).dropna()
    col = [F.col(f"x{i}") for i in range(d)]

    def sums(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        z = reduce(add, [F.lit(float(v)) * c for v, c in zip(w, col, strict=True)])
        if kind == "bt":
            wrong = sigmoid(-z)
            loss, slope, bend = neg_log_sigmoid(z), -wrong, wrong * (F.lit(1.0) - wrong)
        else:
            off = z - F.lit(ipo_target(beta))
            loss, slope, bend = off * off / 2, off, F.lit(1.0)
        facts = x.select(*col, loss.alias("loss"), slope.alias("slope"), bend.alias("bend"))
        row = facts.agg(
            F.avg("loss"),
            *[F.avg(F.col("slope") * c) for c in col],
            *[F.avg(F.col("bend") * col[i] * col[j]) for i, j in corner],
        ).first()
        got = np.array([v or 0.0 for v in row])
        hessian = np.zeros((d, d))
        for (i, j), v in zip(corner, got[d + 1 :], strict=True):
            hessian[i, j] = hessian[j, i] = v
        return got[0] + l2 / 2 * float(w @ w), got[1 : d + 1] + l2 * w, hessian + l2 * np.eye(d)

    w = np.zeros(d)
    loss, gradient, hessian = sums(w)
    for step in range(most_steps):
        norm = float(np.sqrt(gradient @ gradient))
        if norm <= tolerance:
            return MarginScorer(dict(zip(names, map(float, w), strict=True)), norm, step)
        move = np.linalg.solve(hessian, gradient)
        size, ahead = 1.0, sums(w - move)
        while ahead[0] > loss + 1e-12 * abs(loss) and size > 1e-6:
            size /= 2
            ahead = sums(w - size * move)
        w = w - size * move
        loss, gradient, hessian = ahead
    raise ArithmeticError(f"gradient {norm} after {most_steps} steps, above {tolerance}")


def pair_features(pairs: DataFrame, dim: int) -> DataFrame:
    """Hashed word counts of both answers, each word marked with its side, as sparse `x`; with the sides changed, as `mirror`."""

    def marked(text: str, sign: str):
        return F.transform(words(F.coalesce(F.col(text), F.lit(""))), lambda w: F.concat(F.lit(sign), w))

    for out, (first, second) in {"x": ("chosen", "rejected"), "mirror": ("rejected", "chosen")}.items():
        pairs = pairs.withColumn("_t", F.concat(marked(first, "+"), marked(second, "-")))
        pairs = HashingTF(numFeatures=dim, inputCol="_t", outputCol=out).transform(pairs).drop("_t")
    return pairs


def fit_preference_scorer(pairs: DataFrame, kind: str = "bt", beta: float = 0.1, dim: int = SLOTS):
    """A linear reward model from pairs, over `dim` hash slots.

    'bt' maximises the Bradley-Terry likelihood (DPO's loss for a linear
    scorer); 'ls' regresses the margin on IPO's target. Every pair also
    enters mirrored, so both classes exist and no intercept is needed.
    NULL answers are empty. No iteration sees the texts again: Spark caches their sparse counts.
    """
    if kind not in ("bt", "ls"):
        raise ValueError(f"kind is 'bt' or 'ls', not {kind!r}")
    goal = 1.0 if kind == "bt" else ipo_target(beta)
    mirrored_goal = 0.0 if kind == "bt" else -goal
    both = F.array(
        F.struct(F.col("x").alias("features"), F.lit(goal).alias("label")),
        F.struct(F.col("mirror").alias("features"), F.lit(mirrored_goal).alias("label")),
    )
    rows = pair_features(pairs, dim).select(F.inline(both))
    model = LogisticRegression if kind == "bt" else LinearRegression
    return model(fitIntercept=False, standardization=False, regParam=1e-3, maxIter=50).fit(rows)


def score_pairs(model, pairs: DataFrame, dim: int = SLOTS) -> DataFrame:
    """Margin of chosen over rejected under a fitted scorer, and whether it is positive.

    Half the difference between a pair and its mirror: changed sides change the sign and nothing else.
    """
    rows = pair_features(pairs, dim)
    for features, out in (("x", "_m"), ("mirror", "_w")):
        rows = model.transform(rows, {model.featuresCol: features})
        if isinstance(model, LogisticRegressionModel):
            rows = rows.withColumn(out, vector_to_array("rawPrediction")[1]).drop("rawPrediction", "probability", "prediction")
        else:
            rows = rows.withColumnRenamed("prediction", out)
    margin = (F.col("_m") - F.col("_w")) / 2
    return rows.select(*pairs.columns, margin.alias("margin"), (margin > 0).cast("bigint").alias("correct"))
