"""How much one task gets: rows per partition, carries of a scan, rounds of a refit (round 3)."""

from pyspark.sql import functions as F

from rollmill.operators import advantages as A
from rollmill.operators import selection as S
from rollmill.plans import scale
from rollmill.sources import fixtures as fx


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_dealt_by_their_number_and_move_once(spark, root, monkeypatch):
    groups = fx.grouped_rollouts(spark, root)
    before = sorted(map(str, A.adv_grpo(groups).collect()))
    monkeypatch.setattr(scale, "TASK_ROWS", 500)
    parts = fx.line_parts(spark, root)
    assert parts == -(-fx.table(spark, root, "lineitem").count() // 500)
    found = A.adv_grpo(fx.grouped_rollouts(spark, root))
    assert sorted(map(str, found.collect())) == before
    # the lines by order, and no second time for the join or the groups' windows
    text = plan(found)
    assert "hashpartitioning(l_orderkey#" in text and f", {parts}), REPARTITION_BY_NUM" in text
    assert "hashpartitioning(run_id" not in text and "_key.l_orderkey" not in text


def test_partitions_follow_rows_beyond_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    assert scale.task_parts(spark, cores * 10, 10) is None
    assert scale.task_parts(spark, cores * 10_000, 10) == cores * 1_000


def test_carries_end_with_the_last_block(spark):
    """A short trajectory sends one row on, to its own first step, instead of one for each block within reach."""
    steps = spark.range(300).selectExpr("id div 3 as k", "id % 3 as t", "double(id % 7) as reward", "double(id % 5) as value")
    found = A.gae(steps, ["k"], "t", gamma=0.99, lam=0.95, dense=True)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in text.split("Generate explode")[1].split("\n")[0]
    rows = {(r.k, r.t): r for r in found.collect()}
    for k in range(100):
        adv, after = 0.0, 0.0
        for t in (2, 1, 0):
            r = rows[k, t]
            adv = r.reward + 0.99 * after - r.value + 0.99 * 0.95 * adv
            after = r.value
            assert abs(r.adv - adv) < 1e-9 and abs(r.returns - adv - r.value) < 1e-9


def test_refit_moves_no_tokens_by_round_alone(spark, monkeypatch):
    rows = [(i, i % 3, f"p{i % 4}", "a b" if i % 5 else ["", None][i % 2], float(i % 2)) for i in range(60)]
    df = spark.createDataFrame([*rows, (60, None, "p", "a", 1.0)], "sample_id bigint, round int, prompt string, response string, reward double")
    joins, attach = [], S.attach
    monkeypatch.setattr(S, "attach", lambda rows, facts, keys, how="left": joins.append((list(keys), rows.columns)) or attach(rows, facts, keys, how))
    found = S.star_refit(df, ["sample_id"])
    assert [columns for keys, columns in joins if keys == ["_fit"]]
    assert all("sample_id" not in columns for keys, columns in joins if keys == ["_fit"])
    got = {r.sample_id: (r.round, r.n_tok, r.sum_lp) for r in found.collect()}
    assert set(got) == {i for i in range(60) if i % 3}  # no round before the first, none without a number
    assert all(got[i][1:] == (1, 0.0) for i in got if i % 5 == 0)
    assert all(got[i][1] == 2 and got[i][2] < 0 for i in got if i % 5)
