"""Rewards, verifiers and judges as column expressions (V1-V4, V7)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollmill.functions.numerics import n_words

# Sentence marks and length range the rule judge accepts.
JUDGE_MARKS = ("。", "！")
JUDGE_MIN_CHARS = 10
JUDGE_MAX_CHARS = 80


def first_int(text: Column) -> Column:
    """First integer in the text, NULL if there is none or it exceeds 38 digits."""
    return F.nullif(F.regexp_extract(text, "-?[0-9]+", 0), F.lit("")).try_cast("decimal(38,0)")


def first_int_reward(text: Column, gold: Column) -> Column:
    """V1: 1.0 if the first integer equals gold, else 0.0; never NULL."""
    return F.when(first_int(text) == gold, F.lit(1.0)).otherwise(F.lit(0.0))


def overlength_penalty(n_tok: Column, target: int = 4, alpha: float = 0.5) -> Column:
    over = F.greatest(n_tok - F.lit(target), F.lit(0)).cast("double")
    return F.lit(float(alpha)) * over / F.lit(float(max(1, target)))


def length_reward(text: Column, gold: Column, target: int = 4, alpha: float = 0.5) -> Column:
    """V2: correctness less a charge per token over target; may fall below 0."""
    return first_int_reward(text, gold) - overlength_penalty(n_words(text), target, alpha)


def rule_judge(
    text: Column,
    marks: Sequence[str] = JUDGE_MARKS,
    lo: int = JUDGE_MIN_CHARS,
    hi: int = JUDGE_MAX_CHARS,
) -> Column:
    """V3: 1.0 if any mark occurs and the text has lo..hi characters."""
    marked = reduce(lambda a, b: a | b, [F.contains(text, F.lit(m)) for m in marks])
    return F.when(marked & F.char_length(text).between(lo, hi), F.lit(1.0)).otherwise(F.lit(0.0))


def signature_hit(text: Column, signature: str, prefix: int | None = None) -> Column:
    """V4: 1 if the text contains the signature, or its first `prefix` characters."""
    wanted = signature if prefix is None else signature[:prefix]
    return F.when(F.contains(text, F.lit(wanted)), F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def composite_reward(weights: Mapping[str, float]) -> Column:
    """V7: weighted sum of reward columns."""
    return reduce(lambda a, b: a + b, [F.col(c) * F.lit(float(w)) for c, w in weights.items()])


def violated_principles(text: Column, principles: Sequence[tuple[int, str]]) -> Column:
    """V5: ids of the violated principles, ascending.

    Principles are code-sized (a list in the job), so they become one
    expression per pattern instead of a join: no shuffle, no pair explosion.
    """
    hits = [
        F.when(text.rlike(pattern), F.lit(int(pid)).cast("bigint"))
        for pid, pattern in sorted(principles)
    ]
    return F.array_compact(F.array(*hits))
