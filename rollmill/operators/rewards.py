"""Rewards that come from elsewhere, and principle checks (V5, V6)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.functions.verifiers import violated_principles
from rollmill.plans.scale import attach


def constitution_check(rows: DataFrame, principles: Sequence[tuple[int, str]], text: str = "response") -> DataFrame:
    """V5: all violated principles, the first one, and a critique naming it."""
    return (
        rows.withColumn("violations", violated_principles(F.col(text), principles))
        .withColumn("principle_id", F.try_element_at("violations", F.lit(1)))
        .withColumn("critique", F.concat(F.lit("违反原则#"), F.col("principle_id").cast("string")))
    )


def outcome_reward(
    rollouts: DataFrame,
    outcomes: DataFrame,
    keys: Sequence[str] = ("prompt_id", "sample_id"),
    outcome: str = "passed",
    need: str = "all",
) -> DataFrame:
    """V6: tool or unit-test outcomes as reward; a sample with none gets 0.

    Several outcomes of one sample are reduced first: all or any must pass.
    """
    if need not in ("all", "any"):
        raise ValueError(f"need is 'all' or 'any', not {need!r}")
    reduce = F.min if need == "all" else F.max
    per_sample = outcomes.groupBy(*keys).agg(reduce(F.col(outcome).cast("double")).alias("_r"))
    return (
        attach(rollouts, per_sample, keys)
        .withColumn("reward", F.coalesce("_r", F.lit(0.0)))
        .drop("_r")
    )


def user_verifier(fn: Callable[[pd.Series, pd.Series], pd.Series]) -> Callable[[Column, Column], Column]:
    """Wrap a vectorised Python verifier (text, gold) -> score for use as a column."""

    def score(text: pd.Series, gold: pd.Series) -> pd.Series:
        return fn(text, gold).astype("float64")

    return F.pandas_udf(score, "double")
