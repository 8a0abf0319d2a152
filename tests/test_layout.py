"""Rows by group: windows for ordinary groups, slices for hot ones, and the stored form that spares the shuffle."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rollmill.operators import advantages as A
from rollmill.operators import selection as S
from rollmill.plans import scale
from rollmill.sources import fixtures as fx
from rollmill.sources.layout import PART, Grouped, grouped, store_grouped


@pytest.fixture(scope="module")
def rollouts(spark):
    """Groups of 1 to 6 rows, a NULL key, NULL rewards, and one group with a third of all rows."""
    rnd = random.Random(2)
    rows, n = [], 0
    for g in [*range(120), None]:
        for _ in range(rnd.randint(1, 6) if g != 7 else 220):
            n += 1
            rows.append((g, n, rnd.choice((0.0, 0.5, 1.0, None)), f"answer {rnd.randint(0, 9)}"))
    return spark.createDataFrame(rows, "prompt_id bigint, sample_id bigint, reward double, response string").repartition(3).cache()


@pytest.fixture(scope="module")
def hot(spark, rollouts):
    return scale.hot_hashes(rollouts, ["prompt_id"], hot_rows=100)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_the_sketch_names_the_hot_group_alone(spark, hot):
    assert hot == [spark.range(1).select(F.xxhash64(F.lit(7).cast("bigint"))).first()[0]]


def test_slices_spread_a_hot_group(rollouts, hot):
    groups = grouped(rollouts, ["prompt_id"], hot=hot)
    parts = groups.rows.groupBy("prompt_id").agg(F.countDistinct(PART).alias("n"), F.min(PART).alias("low")).collect()
    assert all((r.n > 50 and r.low > 0) if r.prompt_id == 7 else (r.n, r.low) == (1, 0) for r in parts)


@pytest.mark.parametrize("kind", ["plain", "sliced", "stored", "stored slices"])
def test_grouped_rows_give_the_joined_results(rollouts, hot, kind):
    groups = grouped(rollouts, ["prompt_id"], hot=hot if "slice" in kind else [])
    if "stored" in kind:
        groups = store_grouped(groups)
    keys = ["prompt_id"]
    for fn in (A.adv_mean, A.adv_grpo, A.adv_dr_grpo, A.adv_rloo, A.adv_lcpo, A.drop_no_signal):
        out = fn(groups, keys=keys)
        digits = [F.round(c, 9).alias(c) if t == "double" else c for c, t in out.dtypes]
        want = fn(rollouts, keys=keys).select(*digits)
        assert same(out.select(*digits), want.select(*out.columns)), fn.__name__


@pytest.mark.parametrize("sliced", [False, True])
def test_best_and_worst_are_the_ends_of_one_order(rollouts, hot, sliced):
    got = S.best_worst(grouped(rollouts, ["prompt_id"], hot=hot if sliced else []), "reward")
    scored = [r for r in rollouts.collect() if r.reward is not None]
    want = {}
    for g in {r.prompt_id for r in scored}:
        rows = sorted((r for r in scored if r.prompt_id == g), key=lambda r: (-r.reward, r.sample_id))
        want[g] = (rows[0].sample_id, rows[-1].sample_id, rows[0].response, rows[-1].response, rows[0].reward, rows[-1].reward)
    found = {
        r.prompt_id: (r.best.sample_id, r.worst.sample_id, r.best.response, r.worst.response, r.best_score, r.worst_score) for r in got.collect()
    }
    assert found == want


def test_row_index_cuts_hot_keys_alone(rollouts, hot):
    w = Window.partitionBy("prompt_id").orderBy("sample_id")
    want = rollouts.withColumn("i", F.row_number().over(w).cast("bigint") - 1)
    assert same(scale.row_index(rollouts, ["prompt_id"], ["sample_id"], "shiftright(sample_id, 3)", "i", hot), want)
    assert same(scale.row_index(rollouts, ["prompt_id"], ["sample_id"], "sample_id", "i"), want)
    every = rollouts.withColumn("i", F.row_number().over(Window.orderBy("sample_id")).cast("bigint") - 1)
    assert same(scale.row_index(rollouts, [], ["sample_id"], "shiftright(sample_id, 3)", "i"), every)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_rows_do_not_move(spark, root, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    groups = fx.grouped_rollouts(spark, root, stored=True)
    assert not groups.hot
    plan = plan_of(A.adv_grpo(groups))
    assert "Exchange" not in plan and plan.count("FileScan") == 1 and "Bucketed: true" in plan
    assert "Exchange" not in plan_of(A.group_stats(groups))
    assert "Exchange" not in plan_of(S.mine_hard_pairs(groups))
    # two stored tables meet without a shuffle too
    left, right = groups.rows, fx.grouped_rollouts(spark, root, stored=True).rows.select(*groups.keys, F.col("reward").alias("other"))
    joined = plan_of(left.join(right, list(groups.keys)))
    assert "SortMergeJoin" in joined and "Exchange" not in joined


def test_group_queries_read_their_rows_once(spark, root):
    """Four scans (lines, and three block levels over the orders that have lines), no sort-based aggregate."""
    for df in (A.adv_grpo(fx.grouped_rollouts(spark, root)), S.mine_hard_pairs(fx.grouped_rollouts(spark, root)), fx.scored_pairs(spark, root)):
        plan = plan_of(df)
        assert plan.count("FileScan") <= 4 and plan.count("Exchange hashpartitioning") <= 9 and "SortAggregate" not in plan


def test_grouped_holds_its_parts(spark):
    df = spark.createDataFrame([], "prompt_id bigint, sample_id bigint, reward double, response string")
    groups = grouped(df, ["prompt_id"])
    assert isinstance(groups, Grouped) and not groups.hot
    assert A.adv_grpo(groups, ["prompt_id"]).count() == 0 and S.best_worst(groups, "reward").count() == 0
