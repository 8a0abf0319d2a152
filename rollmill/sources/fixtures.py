"""Post-training tables derived from the driver's parquet tables (FIXTURES.md).

Same rows as the SQL there, planned without a window over a whole run, source or table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmill.functions.verifiers import first_int_reward
from rollmill.operators.datasets import adjacent_turns
from rollmill.operators.selection import best_worst
from rollmill.plans.scale import dealt, dense_index, hot_hashes, next_row, row_index, task_parts
from rollmill.plans.session import written
from rollmill.sources.layout import Grouped, grouped, store_grouped
from rollmill.sources.tables import spread, table

RUN_KEYS = ("run_id", "step", "prompt_id")

GOLD = "o_orderkey % 10 + o_custkey % 10"
LP = "-(l_extendedprice / 10000)"
ROLLOUT_COLUMNS = (
    "o_orderpriority as run_id",
    "step",
    "o_orderkey as prompt_id",
    "concat(cast(o_orderkey % 10 as string), '+', cast(o_custkey % 10 as string), '=?') as prompt",
    f"{GOLD} as gold",
    "sample_id",
    f"""case when l_returnflag = 'N' then concat('答案是', cast({GOLD} as string))
             when l_returnflag = 'A' then cast({GOLD} + 1 + l_linenumber % 3 as string)
             when l_quantity < 25 then '不知道。'
             else concat(cast({GOLD} as string), repeat(' ok', l_linenumber)) end as response""",
    "cast(case when l_returnflag = 'R' and l_quantity >= 25 then 1 + l_linenumber else 1 end as bigint) as n_tok",
    f"{LP} as lp_new",
    f"{LP} + (l_discount - 0.05D) as lp_old",
    f"{LP} + (l_tax - 0.04D) as lp_ref",
)


def run_steps(orders: DataFrame, lined: DataFrame) -> DataFrame:
    """Orders with lines, numbered within their priority; which orders have lines is written, as three levels of blocks read it."""
    used = written(orders.join(lined, orders.o_orderkey == lined.l_orderkey, "left_semi"), "orders")
    return dense_index(used, ["o_orderpriority"], "o_orderkey", "step")


def hot_orders(spark: SparkSession, root: str) -> list[int]:
    return hot_hashes(table(spark, root, "lineitem").where("l_orderkey is not null"), ["l_orderkey"])


def line_parts(spark: SparkSession, root: str) -> int | None:
    """Partitions that hold about TASK_ROWS lines each; the number of lines comes from the files' footers."""
    return task_parts(spark, table(spark, root, "lineitem").count())


def samples(spark: SparkSession, root: str, hot: list[int] | None = None) -> DataFrame:
    """Lines with `sample_id`, their number within their order."""
    lines = table(spark, root, "lineitem").where("l_orderkey is not null")
    lines = dealt(lines, line_parts(spark, root), ["l_orderkey"])
    order = (
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    coarse = "shiftleft(cast(l_linenumber as bigint), 32) + shiftright(l_partkey, 10)"  # part keys below 2**42
    return row_index(lines, ["l_orderkey"], order, coarse, "sample_id", hot)


def arith_rollouts(spark: SparkSession, root: str, hot: list[int] | None = None) -> DataFrame:
    """one order is a prompt and a step of its run, one line is a sample."""
    lined = table(spark, root, "lineitem").select("l_orderkey").distinct()
    orders = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return (
        samples(spark, root, hot).withColumnRenamed("l_orderkey", "o_orderkey")
        .join(run_steps(orders, lined), "o_orderkey")
        .selectExpr(*ROLLOUT_COLUMNS)
    )


def verified_rollouts(spark: SparkSession, root: str, hot: list[int] | None = None) -> DataFrame:
    """F1 with the verifier's reward."""
    return arith_rollouts(spark, root, hot).withColumn("reward", first_int_reward(F.col("response"), F.col("gold")))


def grouped_rollouts(spark: SparkSession, root: str, stored: bool = False) -> Grouped:
    """F1 with the verifier's reward, by group; `stored` writes it first. A group is an order: hot ones show in its lines."""
    hot = hot_orders(spark, root)
    groups = grouped(verified_rollouts(spark, root, hot), RUN_KEYS, ["prompt_id"], hot)
    return store_grouped(groups, buckets=line_parts(spark, root)) if stored else groups


def scored_pairs(spark: SparkSession, root: str) -> DataFrame:
    """first correct against last wrong sample of every mixed group."""
    pairs = best_worst(
        grouped_rollouts(spark, root),
        "reward",
        RUN_KEYS,
        ("prompt", "response", "lp_new", "lp_ref", "n_tok"),
    ).where("best_score > worst_score")
    return pairs.select(
        *RUN_KEYS,
        F.col("best.prompt").alias("prompt"),
        F.col("best.response").alias("chosen"),
        F.col("worst.response").alias("rejected"),
        F.col("best.lp_new").alias("lp_c"),
        F.col("worst.lp_new").alias("lp_r"),
        F.col("best.lp_ref").alias("lpref_c"),
        F.col("worst.lp_ref").alias("lpref_r"),
        F.col("best.n_tok").alias("n_c"),
        F.col("worst.n_tok").alias("n_r"),
    )


def sft_turns(spark: SparkSession, root: str) -> DataFrame:
    """user turns answered by the assistant."""
    return adjacent_turns(table(spark, root, "conversations"))


def doc_rollouts(spark: SparkSession, root: str) -> DataFrame:
    """labelled documents as answers, grouped by source."""
    docs = spread(table(spark, root, "documents").select("doc_id", "text", "lang", "source"), "doc_id")
    labels = table(spark, root, "labels")
    return docs.join(labels, "doc_id").select(
        F.col("source").alias("prompt_id"),
        F.col("doc_id").alias("sample_id"),
        "lang",
        F.col("text").alias("response"),
        F.col("quality").cast("double").alias("reward"),
        F.col("toxic"),
    )


def spin_generations(spark: SparkSession, root: str) -> DataFrame:
    """the next answer in (conv_id, turn) order stands in for a generation.

    Within a conversation that is the next row; a conversation's last turn
    takes the first answer of the next conversation.
    """
    turns = sft_turns(spark, root)
    inside = next_row(turns, ["conv_id"], "turn", ["response"])
    first = turns.groupBy("conv_id").agg(F.min_by("response", "turn").alias("response"))
    after = next_row(first, [], "conv_id", ["response"], prefix="after_").select("conv_id", "after_response")
    return inside.join(after, "conv_id").select(
        "conv_id", "turn", F.coalesce("next_response", "after_response", F.lit("  ")).alias("generation")
    )


def labelled_documents(spark: SparkSession, root: str, mark: str | None = None) -> DataFrame:
    """All documents with their labels where they have some; `mark` names a column that is true there and else NULL."""
    labels = table(spark, root, "labels").select("doc_id", "quality", "toxic", *([F.lit(True).alias(mark)] if mark else []))
    docs = spread(table(spark, root, "documents").select("doc_id", "text"), "doc_id")
    return docs.join(labels, "doc_id", "left")


def model_filters():
    """Which documents each n-gram model is fitted on."""
    good = F.coalesce(F.col("quality") == 1, F.lit(False))
    clean = F.coalesce(F.col("toxic") == 0, F.lit(False))
    return {
        "policy": good & clean,
        "ref": F.lit(True),
        "old": F.col("doc_id") % 2 == 0,
        "teacher": good,
    }
