"""Choosing and synthesising training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollmill.functions.numerics import is_blank
from rollmill.operators.ngram import token_rows
from rollmill.operators.rewards import constitution_check
from rollmill.plans.scale import attach, running_total
from rollmill.plans.session import written
from rollmill.sources.layout import Grouped, grouped

KEYS = ("run_id", "step", "prompt_id")

# Fixed value: stands in for a blank generation.
BLANK = "（空）"


def rejection_sample(rollouts: DataFrame, reward: str = "reward") -> DataFrame:
    """Fully rewarded samples become fine-tuning rows."""
    return rollouts.where(F.col(reward) == 1.0)


def rejection_report(
    rollouts: DataFrame, run: Sequence[str] = ("run_id",), order: str = "step", reward: str = "reward"
) -> DataFrame:
    """Sampled and kept per step, and kept by the run so far."""
    per_step = rollouts.groupBy(*run, order).agg(
        F.count(F.lit(1)).alias("sampled"), F.count_if(F.col(reward) == 1.0).alias("kept")
    )
    return running_total(written(per_step, "steps"), run, order, "kept", "kept_so_far")


def top_k_per_prompt(
    rollouts: DataFrame, k: int, score: str = "reward", keys: Sequence[str] = KEYS, tie: str = "sample_id"
) -> DataFrame:
    """The k best answers per group. The limit also runs before the shuffle,
    so a task receives at most k rows per group from each map task."""
    w = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(tie))
    return rollouts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def star_rounds(
    rollouts: DataFrame,
    round_col: str = "round",
    by: Sequence[str] = ("run_id",),
    reward: str = "reward",
    start: DataFrame | None = None,
) -> DataFrame:
    """D3: kept, accuracy and change per round, with the trajectory so far.

    `start` (by, reward) holds answers from before the first round: their accuracy begins the trajectory, and the first
    change is measured from it. The ordered part works on one row per round.
    """
    w = Window.partitionBy(*by).orderBy(round_col)
    facts = rollouts.groupBy(*by, round_col).agg(
        F.count(F.lit(1)).alias("sampled"),
        F.count_if(F.col(reward) == 1.0).alias("kept"),
        F.avg(reward).alias("accuracy"),
    )
    if start is None:
        facts = facts.withColumn("_start", F.lit(None).cast("double"))
    else:
        facts = attach(facts, start.groupBy(*by).agg(F.avg(reward).alias("_start")), by)
    before = F.coalesce(F.lag("accuracy").over(w), F.when(F.row_number().over(w) == 1, F.col("_start")))
    return (
        facts.withColumn("delta", F.col("accuracy") - before)
        .withColumn("trajectory", F.concat_ws(" -> ", _percent("_start"), F.array_join(F.collect_list(_percent("accuracy")).over(w), " -> ")))
        .drop("_start")
    )


def _percent(share: str) -> Column:
    return F.concat(F.round(F.col(share) * 100 + F.lit(1.7e-9)).cast("bigint").cast("string"), F.lit("%"))


def star_refit(
    rollouts: DataFrame,
    ids: Sequence[str],
    round_col: str = "round",
    prompt: str = "prompt",
    answer: str = "response",
    reward: str = "reward",
    n: int = 2,
    add_k: float = 0.5,
) -> DataFrame:
    """Fit on what round r kept, score round r + 1.

    The round is a key: of n-grams, contexts and vocabulary sizes, so that any number of rounds is fitted and scored in
    one pass, whatever their numbers. Columns ids, round, n_tok, sum_lp. A sample is returned if the table has rows of the round before its
    own; one that kept nothing knows the unknown word alone, of probability 1. NULL rounds take no part.
    """
    known = rollouts.where(F.col(round_col).isNotNull()).withColumn("_fit", F.col(round_col).cast("bigint"))
    words = token_rows(known.where(F.col(reward) == 1.0), ["_fit"], answer, prompt, n).where("w is not null")
    ngrams = words.groupBy("_fit", "ctx", "w").agg(F.count(F.lit(1)).alias("_n"))
    contexts = ngrams.groupBy("_fit", "ctx").agg(F.sum("_n").alias("_all"))
    sizes = ngrams.groupBy("_fit", "w").agg(F.lit(1).alias("_one")).groupBy("_fit").agg((F.count("_one") + 1).alias("_v"))
    # rounds that kept nothing have no size of their own
    rounds = attach(known.select("_fit").distinct(), sizes, ["_fit"]).select("_fit", F.coalesce("_v", F.lit(1)).alias("_v"))

    later = known.withColumn("_fit", F.col("_fit") - 1)
    tokens = token_rows(later, [*ids, round_col, "_fit"], answer, prompt, n)
    # rounds meet the distinct n-grams, never the tokens: these would lie in one task per round. An empty answer is one of NULLs
    needed = attach(tokens.select("_fit", "ctx", "w").distinct(), rounds, ["_fit"], "inner")
    counts = attach(attach(needed, ngrams, ["_fit", "ctx", "w"]), contexts, ["_fit", "ctx"])
    k = f"{float(add_k)!r}D"
    scored = counts.selectExpr("_fit", "ctx", "w", f"if(w is null, null, ln((coalesce(_n, 0) + {k}) / (coalesce(_all, 0) + {k} * _v))) as _lp")
    met = attach(tokens, scored, ["_fit", "ctx", "w"], "inner")
    return met.groupBy(*ids, round_col).agg(
        F.greatest(F.count("w"), F.lit(1)).alias("n_tok"), F.coalesce(F.sum("_lp"), F.lit(0.0)).alias("sum_lp")
    )


def best_worst(
    rollouts: DataFrame | Grouped,
    score: str,
    keys: Sequence[str] = ("prompt_id",),
    payload: Sequence[str] = ("response",),
    tie: str = "sample_id",
) -> DataFrame:
    """Structs `best` (first of the highest scores) and `worst` (last of the lowest) per group.

    Both are ends of one order, so one sort of each group's rows finds them, with their payload; hot groups are
    reduced slice by slice. NULL scores take no part.
    """
    groups = rollouts if isinstance(rollouts, Grouped) else grouped(rollouts, keys)
    scored = Grouped(groups.rows.where(F.col(score).isNotNull()), tuple(keys), groups.hot)
    columns = [tie, *[c for c in dict.fromkeys((score, *payload)) if c != tie]]
    found = scored.ends([F.col(score).desc(), F.col(tie).asc()], columns)
    return found.select(
        *keys,
        F.col("first").alias("best"),
        F.col("last").alias("worst"),
        F.col("first")[score].alias("best_score"),
        F.col("last")[score].alias("worst_score"),
    )


def best_worst_pairs(
    rollouts: DataFrame | Grouped,
    score: str,
    keys: Sequence[str] = ("prompt_id",),
    text: str = "response",
    tie: str = "sample_id",
    judge: str | None = None,
) -> DataFrame:
    """Judge-scored candidates to preference pairs; a tie still gives a pair, flagged.

    `judge` names the scorer in a column of that name.
    """
    pairs = best_worst(rollouts, score, keys, (text,), tie).select(
        *keys,
        F.col("best")[text].alias("chosen"),
        F.col("worst")[text].alias("rejected"),
        F.col("best")[tie].alias("chosen_id"),
        F.col("worst")[tie].alias("rejected_id"),
        "best_score",
        "worst_score",
        (F.col("best_score") == F.col("worst_score")).alias("tied"),
    )
    return pairs if judge is None else pairs.withColumn("judge", F.lit(judge))


def spin_pairs(gold: DataFrame, generations: DataFrame, keys: Sequence[str], round_: int = 0) -> DataFrame:
    """The gold answer against the previous model's own answer."""
    own = F.col("generation")
    return gold.join(generations, list(keys)).select(
        *keys,
        F.lit(round_).cast("bigint").alias("round"),
        "prompt",
        F.col("response").alias("chosen"),
        F.when(is_blank(own), F.lit(BLANK)).otherwise(own).alias("rejected"),
    )


def critique_revise(rows: DataFrame, principles: Sequence[tuple[int, str]], revised: Column, text: str = "response") -> DataFrame:
    """Violating answers as (prompt, initial, critique, revised) records."""
    return (
        constitution_check(rows, principles, text)
        .where("principle_id is not null")
        .withColumn("revised", revised)
        .withColumnRenamed(text, "initial")
        .drop("violations")
    )


def distill_set(rollouts: DataFrame, teacher: Column, reward: str = "reward") -> DataFrame:
    """One source model's verified answers as fine-tuning rows."""
    return rejection_sample(rollouts.where(teacher), reward)


def mine_hard_pairs(
    rollouts: DataFrame | Grouped, keys: Sequence[str] = KEYS, reward: str = "reward", text: str = "response"
) -> DataFrame:
    """A right and a wrong answer from every group that has both."""
    pairs = best_worst_pairs(rollouts, reward, keys, text)
    return pairs.where((F.col("best_score") == 1.0) & (F.col("worst_score") < 1.0)).drop("tied")
