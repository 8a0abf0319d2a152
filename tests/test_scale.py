"""Plans: what they shuffle, and that one huge key neither changes results nor lands in one task."""

import math
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as spec
from rollmill import catalog
from rollmill.operators import advantages as A
from rollmill.operators import ngram as L
from rollmill.operators import selection as S
from rollmill.plans import scale
from rollmill.sources import fixtures as fx


@pytest.fixture(scope="module")
def gappy(spark):
    """Keys of very different size, integer order with gaps and negatives."""
    rng = random.Random(7)
    rows = []
    for key, n in (("hot", 400), ("warm", 30), (None, 1)):
        for o in rng.sample(range(-900, 900), n):
            rows.append((key, o, rng.randint(-5, 5), rng.random()))
    return spark.createDataFrame(rows, "key string, o bigint, v bigint, x double").cache()


CUTS = [(), (3,), (3, 3), (3, 3, 3), scale.CUTS]


@pytest.mark.parametrize("cuts", CUTS)
def test_running_total_equals_the_window(gappy, cuts):
    w = Window.partitionBy("key").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    want = gappy.select("key", "o", F.sum("v").over(w).alias("s"))
    got = scale.running_total(gappy, ["key"], "o", "v", "s", cuts=cuts).select("key", "o", "s")
    order = lambda rows: sorted(rows, key=lambda r: (r.key or "", r.o))
    assert order(got.collect()) == order(want.collect())


@pytest.mark.parametrize("cuts", CUTS[1:])
def test_dense_index_without_keys(gappy, cuts):
    one = gappy.where("key = 'hot'")
    got = [r.i for r in scale.dense_index(one, [], "o", "i", cuts=cuts).orderBy("o").collect()]
    assert got == list(range(400))


@pytest.mark.parametrize("cuts", CUTS)
def test_next_row_equals_lead(gappy, cuts):
    gappy = gappy.withColumn("v", F.when(F.col("v") > 0, F.col("v")))  # a NULL value is still the next row's value
    w = Window.partitionBy("key").orderBy("o")
    want = gappy.select("key", "o", F.lead("v").over(w).alias("next_v"), F.lead("x").over(w).alias("next_x"))
    got = scale.next_row(gappy, ["key"], "o", ["v", "x"], cuts=cuts).select("key", "o", "next_v", "next_x")
    order = lambda rows: sorted(rows, key=lambda r: (r.key or "", r.o))
    assert order(got.collect()) == order(want.collect())


@pytest.mark.parametrize("coef", [0.0, 1e-250, 1e-90, 1e-6, 0.3, 0.9, 0.999, 0.999999, 1.0])
@pytest.mark.parametrize("bits", [1, 3, 12])
def test_linear_scan_equals_the_loop(gappy, coef, bits):
    got = scale.linear_scan(gappy, ["key"], "o", coef, "x", "y", bits=bits)
    found = {(r.key, r.o): (r.v, r.y_prev, r.y) for r in got.collect()}
    seen = 0
    for key in ("hot", "warm", None):
        y = 0.0
        for r in gappy.where(F.col("key").eqNullSafe(key)).orderBy("o").collect():
            before, y = y, coef * y + r.x
            v, y_prev, y_now = found[key, r.o]
            assert v == r.v and (y_prev, y_now) == pytest.approx((before, y), rel=1e-9, abs=1e-12)
            seen += 1
    assert seen == len(found)


def test_linear_scan_of_a_long_key_stays_exact(spark):
    """Many blocks, and a coefficient whose memory spans several of them."""
    n, coef = 20_000, 0.9995
    df = spark.range(n).select(F.lit("k").alias("key"), "id", F.sin("id").alias("x"))
    got = [r.y for r in scale.linear_scan(df, ["key"], "id", coef, "x", "y", bits=8, dense=True).orderBy("id").collect()]
    y, want = 0.0, []
    for i in range(n):
        y = coef * y + math.sin(i)
        want.append(y)
    assert got == pytest.approx(want, abs=1e-9)


def test_linear_scan_refuses_a_growing_recurrence(gappy):
    with pytest.raises(ValueError, match="between 0 and 1"):
        scale.linear_scan(gappy, ["key"], "o", 1.1, "x", "y")


def test_samples_are_numbered_as_by_one_window(spark, root):
    by = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
          "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    got = fx.samples(spark, root)
    want = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*by)) - 1
    assert got.withColumn("_want", want).where("sample_id <> _want").isEmpty()
    assert got.count() == spark.read.parquet(f"{root}/lineitem.parquet").count()


def test_sparse_orders_fill_no_large_block(spark, conf):
    """Orders spaced by 2**40, and NULL keys: every window, at any level, sees few rows of a key."""
    df = spark.range(3000).selectExpr("if(id % 2 = 0, null, 'k') as key", "(id - 1500) * pow(2, 40) as o", "1D as x")
    df = df.withColumn("o", F.col("o").cast("bigint"))
    first = df.groupBy("key", F.shiftright("o", scale.CUTS[0])).count().agg(F.max("count")).first()[0]
    second = df.groupBy("key", F.shiftright("o", sum(scale.CUTS))).count().agg(F.max("count")).first()[0]
    assert first == second == 1
    assert 64 - sum(scale.CUTS) <= 24  # what the top window can hold, whatever the orders
    rows = scale.dense_index(df, ["key"], "o", "i").collect()
    assert sorted((r.key or "", r.i) for r in rows) == sorted((k, i) for k in ("", "k") for i in range(1500))


def test_a_null_order_is_an_error(spark):
    df = spark.createDataFrame([("k", 1, 1.0), ("k", None, 1.0)], "key string, o bigint, x double")
    for out in (
        scale.running_total(df, ["key"], "o", "x", "s"),
        scale.next_row(df, ["key"], "o", ["x"]),
        scale.linear_scan(df, ["key"], "o", 0.5, "x", "y"),
        scale.linear_scan(df, ["key"], "o", 0.5, "x", "y", dense=True),
    ):
        with pytest.raises(Exception, match="order column holds NULL"):
            out.collect()


def final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def skewed(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10k",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10k",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500)
    return spark.range(0, 60_000, numPartitions=8).select(
        key.alias("prompt_id"), F.col("id").alias("sample_id"), (F.col("id") % 7 / 7).alias("reward")
    )


def test_a_group_with_a_third_of_the_rows_is_split(skewed):
    df = A.adv_grpo(skewed, ["prompt_id"])
    plan = final_plan(df)
    assert "SortMergeJoin(skew=true)" in plan
    assert df.count() == skewed.count()


def test_a_token_with_a_third_of_the_text_is_split(spark, skewed):
    text = F.concat_ws(" ", F.lit("the"), F.lit("the"), F.lit("the"), F.col("sample_id").cast("string"))
    docs = skewed.select("sample_id", text.alias("response"))
    lm = L.fit_ngram_lm(docs, "response")
    df = L.seq_logp(lm, docs, ["sample_id"], prompt=None)
    assert "SortMergeJoin(skew=true)" in final_plan(df)
    assert df.count() == 60_000


def test_groups_are_reduced_before_the_shuffle(spark, root):
    plan = planned(A.group_stats(fx.verified_rollouts(spark, root)))
    assert re.search(r"Exchange hashpartitioning\(run_id[^\n]*\n[^\n]*HashAggregate[^\n]*partial_count", plan)


def test_top_k_limits_before_the_shuffle(spark, root):
    plan = planned(S.top_k_per_prompt(fx.verified_rollouts(spark, root), 2))
    assert plan.count("WindowGroupLimit") == 2
    assert re.search(r"Exchange[^\n]*\n[^\n]*WindowGroupLimit[^\n]*Partial", plan)


EAGER = {"p9_word_scorer_bt", "p9_word_scorer_ls", "p9_scorer_report"}
PYTHON = {"v1_user_verifier"}  # whose feature it is to call the user's function
BATCH = sorted(n for n in catalog.queries() if not n.startswith("t") and n not in EAGER | PYTHON)


@pytest.mark.parametrize("name", BATCH)
def test_batch_plans_stay_on_the_jvm(spark, root, name):
    plan = planned(spec.queries()[name](spark, root))
    for node in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "ExternalRDD"):
        assert node not in plan


def test_scans_read_only_what_a_query_needs(spark, root):
    plan = planned(spec.queries()["s4_arith_prompts"](spark, root))
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>", plan)
    plan = planned(spec.queries()["d8_distill_set"](spark, root))
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan


def test_losses_share_one_projection_and_one_shuffle(spark, root):
    pairs = fx.scored_pairs(spark, root)
    from rollmill.operators.preference import preference_report

    extra = planned(preference_report(pairs, ["run_id"])).count("Exchange hash") - planned(pairs).count("Exchange hash")
    assert extra == 1


def test_counts_are_shuffled_once_for_all_their_readers(spark, root):
    """Fitting happens once although n-grams, contexts and vocabulary read it."""
    df = spec.queries()["l3_seq_logp"](spark, root)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    documents = re.findall(r"FileScan parquet \[doc_id#\d+L,text#\d+\]", text.split("== Initial Plan ==")[0])
    assert len(documents) <= 1
