"""Building training datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.functions.numerics import is_blank
from rollmill.plans.scale import attach, dense_index, next_row

# The ChatML rendering of one message and of the answer header.
CHATML = ("<|im_start|>", "\n", "<|im_end|>\n")


def adjacent_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, prompt, response) where an assistant turn follows a user turn."""
    paired = next_row(conversations.select("conv_id", "turn", "role", "text"), ["conv_id"], "turn", ["role", "text"])
    return paired.where("role = 'user' and next_role = 'assistant'").select(
        "conv_id", "turn", F.col("text").alias("prompt"), F.col("next_text").alias("response")
    )


def sft_examples(conversations: DataFrame) -> DataFrame:
    """Adjacent turns with the conversation's first system message."""
    system = (
        conversations.where("role = 'system'")
        .groupBy("conv_id")
        .agg(F.min_by("text", "turn").alias("system"))
    )
    return attach(adjacent_turns(conversations), system, ["conv_id"])


def messages(system: Column, prompt: Column) -> Column:
    """The chat messages of one example: an optional system message, then the user's."""
    user = F.struct(F.lit("user").alias("role"), prompt.alias("content"))
    sys = F.struct(F.lit("system").alias("role"), system.alias("content"))
    return F.when(F.coalesce(system, F.lit("")) == "", F.array(user)).otherwise(F.array(sys, user))


def render_chat(
    msgs: Column, template: tuple[str, str, str] = CHATML, add_generation_prompt: bool = True
) -> Column:
    """ARRAY<STRUCT<role, content>> to one prompt string, ending at the answer header."""
    opening, after_role, closing = (F.lit(t) for t in template)
    body = F.array_join(
        F.transform(msgs, lambda m: F.concat(opening, m["role"], after_role, m["content"], closing)), ""
    )
    if not add_generation_prompt:
        return body
    return F.concat(body, opening, F.lit("assistant"), after_role)


def explode_candidates(df: DataFrame, candidates: str = "candidates", keep: Sequence[str] = ("prompt_id",)) -> DataFrame:
    """S3: one row per candidate; its position is the sample_id."""
    return df.select(*keep, F.posexplode(candidates).alias("sample_id", "response")).withColumn(
        "sample_id", F.col("sample_id").cast("bigint")
    )


def arith_prompts(df: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Prompt text and gold answer of an addition task."""
    text = F.concat(F.col(a).cast("string"), F.lit("+"), F.col(b).cast("string"), F.lit("=?"))
    return df.withColumn("prompt", text).withColumn("gold", (F.col(a) + F.col(b)).cast("bigint"))


def attach_prompts(rollouts: DataFrame, prompts: DataFrame, key: str = "prompt_id") -> DataFrame:
    """Prompt text and gold onto samples; a prompt may own any share of them."""
    return rollouts.join(prompts, key)


def _blank(c: str) -> Column:
    return is_blank(F.col(c))


def validate_pairs(pairs: DataFrame, key: str = "pair_id") -> DataFrame:
    """A `reason` per pair: null, blank, identical, duplicate, or NULL for valid ones.

    Copies are found on a digest of the triple; the row kept is looked up by
    the unique `key`, so a triple with any number of copies stays spread out.
    """
    p, c, r = "prompt", "chosen", "rejected"
    digest = F.sha2(F.to_json(F.struct(p, c, r)), 256)
    defect = (
        F.when(F.col(p).isNull() | F.col(c).isNull() | F.col(r).isNull(), "null")
        .when(_blank(p) | _blank(c) | _blank(r), "blank")
        .when(F.col(c) == F.col(r), "identical")
    )
    checked = pairs.withColumn("reason", defect)
    firsts = (
        checked.where("reason is null")
        .groupBy(digest.alias("_d"))
        .agg(F.min(key).alias(key))
        .select(key, F.lit(True).alias("_first"))
    )
    again = F.col("reason").isNull() & F.col("_first").isNull()
    return (
        checked.join(firsts, key, "left")
        .withColumn("reason", F.when(again, "duplicate").otherwise(F.col("reason")))
        .drop("_first")
    )


def valid_pairs(pairs: DataFrame, key: str = "pair_id") -> DataFrame:
    return validate_pairs(pairs, key).where("reason is null").drop("reason")


def pairs_to_unpaired(pairs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Each pair gives a desirable (1) and an undesirable (0) completion."""
    both = F.array(
        F.struct(F.col("chosen").alias("completion"), F.lit(1).alias("label")),
        F.struct(F.col("rejected").alias("completion"), F.lit(0).alias("label")),
    )
    return pairs.select(*keep, "prompt", F.inline(both))


def kto_from_labels(docs: DataFrame, labels: DataFrame, key: str, prompt: str, completion: str, label: str) -> DataFrame:
    """Labelled completions from a text table and a label table."""
    return docs.join(labels, key).select(
        F.col(key),
        F.col(prompt).alias("prompt"),
        F.col(completion).alias("completion"),
        F.col(label).cast("int").alias("label"),
    )


def step_schedule(
    df: DataFrame, order: str, cols: Sequence[str], steps: int | None = None, epochs: int | None = None
) -> DataFrame:
    """The example used at step s is row s mod n in `order` (unique integer).

    With `epochs` every row states its own steps. With `steps`, the steps are
    generated in parallel and find their example by an equi-join.
    """
    if (steps is None) == (epochs is None):
        raise ValueError("give either steps or epochs")
    n = df.agg(F.count(F.lit(1))).scalar()
    examples = dense_index(df.select(order, *cols), [], order, "_i")
    if epochs is not None:
        passes = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(epochs - 1).cast("bigint")))
        out = examples.withColumn("_e", passes).withColumn("step", F.col("_i") + F.col("_e") * n)
        return out.drop("_i", "_e")
    # an example beyond the last step is never used, so it need not travel
    return (
        df.sparkSession.range(steps)
        .select(F.col("id").alias("step"), (F.col("id") % n).alias("_i"))
        .join(examples.where(F.col("_i") < steps), "_i")
        .drop("_i")
    )
