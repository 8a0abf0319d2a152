"""Queries over evaluation and monitoring (M1-M3, M6, M7) and the flagship report."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollmill.catalog.entries import STATS, VERIFIED, Entry, r, rounded_cols
from rollmill.catalog.grouped import N_WORDS, charged
from rollmill.functions.numerics import n_words, rounded
from rollmill.operators import advantages as A
from rollmill.operators import monitor as M
from rollmill.operators.objectives import step_loss
from rollmill.functions.losses import pg_loss
from rollmill.sources import fixtures as fx


def run_report(spark, root):
    """Per run: groups, share without signal, accuracy, mean size of the advantage."""
    rollouts = fx.verified_rollouts(spark, root)
    stats = A.group_stats(rollouts)
    # |r - mu| / sigma summed over a 0/1 group needs its counts only
    right, k = F.col("n_correct"), F.col("k")
    size = (right * (1 - F.col("mu")) + (k - right) * F.col("mu")) / F.col("sigma")
    live = A.has_signal("var")
    return stats.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("groups"),
        rounded(F.avg((~live).cast("double"))).alias("no_signal_share"),
        rounded(F.sum("r_sum") / F.sum("k")).alias("accuracy"),
        rounded(F.sum(F.when(live, size)) / F.sum(F.when(live, k))).alias("mean_abs_adv"),
    )


def m1(spark, root):
    last = F.when(F.col("step") % 2 == 0, F.lit("before")).otherwise(F.lit("after"))
    by_phase = fx.verified_rollouts(spark, root).withColumn("phase", last)
    return rounded_cols(M.accuracy(by_phase, ["run_id", "phase"]), ["accuracy"])


def m2(spark, root):
    rows = charged(spark, root).withColumn("n", n_words(F.col("response")))
    out = M.length_eval(rows, ["run_id"], "reward", "correct", "n")
    return rounded_cols(out, ["mean_reward", "accuracy", "mean_tokens"])


def m3(spark, root):
    report = M.step_report(fx.grouped_rollouts(spark, root)).select("run_id", "step", "mu")
    return rounded_cols(M.log_rows(report, 8), ["mu"])


def m6(spark, root):
    return rounded_cols(M.step_report(fx.grouped_rollouts(spark, root)), ["mu", "sigma", "r_min", "r_max"])


def m6_rewards(spark, root):
    """Every group's rewards in the order of its samples."""
    pages = M.reward_pages(fx.verified_rollouts(spark, root))
    return pages.withColumn("rewards", F.array_join(F.transform("rewards", lambda r: r.cast("int").cast("string")), ","))


def m6_history(spark, root):
    report = M.step_report(fx.grouped_rollouts(spark, root))
    return rounded_cols(M.metric_history(report, ["run_id", "step"], ["mu", "sigma", "kept", "skipped"]), ["value"])


def m6_loss(spark, root):
    """The loss column of the step report, from the group-baseline advantage."""
    adv = A.adv_dr_grpo(fx.verified_rollouts(spark, root))
    return rounded_cols(step_loss(adv, pg_loss(F.col("adv"), F.col("lp_new"))), ["loss"])


def m7(spark, root):
    return rounded_cols(M.any_correct_at_k(fx.verified_rollouts(spark, root)), ["at_1", "at_2", "at_4"])


ENTRIES = {
    "run_report": Entry(
        run_report,
        f"""with {STATS}, n as (select run_id, count(*) as groups, avg(case when var < 1e-12 then 1 else 0 end) as ns
        from s group by run_id),
        w as (select run_id, avg(reward) as acc, avg(case when var >= 1e-12 then abs(reward - mu) / sigma end) as ma
        from g group by run_id)
        select run_id, groups, {r('ns')} as no_signal_share, {r('acc')} as accuracy, {r('ma')} as mean_abs_adv
        from n join w using (run_id)""",
    ),
    "m1_accuracy": Entry(
        m1,
        f"""with {VERIFIED} select run_id, case when step % 2 = 0 then 'before' else 'after' end as phase,
        count(*) as n, {r('avg(reward)')} as accuracy from v group by 1, 2""",
    ),
    "m2_length_eval": Entry(
        m2,
        f"""with {VERIFIED}, c as (select run_id, reward, {N_WORDS} as n,
        reward - 0.5::double * greatest({N_WORDS} - 2, 0) / 2 as ch from v)
        select run_id, {r('avg(ch)')} as mean_reward, {r('avg(reward)')} as accuracy, {r('avg(n)')} as mean_tokens
        from c group by run_id""",
    ),
    "m3_log_rows": Entry(
        m3,
        f"""with {VERIFIED}, sm as (select run_id, step, avg(reward) as mu, max(step) over (partition by run_id) as last_step
        from v group by run_id, step)
        select run_id, step, {r('mu')} as mu from sm
        where step % greatest(1, (last_step + 1) // 8) = 0 or step = last_step""",
    ),
    "m6_step_report": Entry(
        m6,
        f"""with {STATS}, e as (select run_id, step, count(*) filter (var >= 1e-12) as kept,
        count(*) filter (var < 1e-12) as skipped from s group by run_id, step)
        select v.run_id, v.step, count(*) as samples, count(*) filter (reward = 1) as n_correct, {r('avg(reward)')} as mu,
               {r('stddev_pop(reward)')} as sigma, {r('min(reward)')} as r_min, {r('max(reward)')} as r_max,
               any_value(kept) as kept, any_value(skipped) as skipped
        from v join e on e.run_id = v.run_id and e.step = v.step group by v.run_id, v.step""",
    ),
    "m6_reward_pages": Entry(
        m6_rewards,
        f"""with {VERIFIED} select run_id, step, prompt_id, (sample_id // 1024)::bigint as page,
        string_agg(reward::int, ',' order by sample_id) as rewards from v group by 1, 2, 3, 4""",
    ),
    "m6_metric_history": Entry(
        m6_history,
        f"""with {STATS}, e as (select run_id, step, avg(reward) as mu, stddev_pop(reward) as sigma,
        max(case when var >= 1e-12 then 1 else 0 end)::double as kept from g group by run_id, step)
        select run_id, step, 'mu' as name, {r('mu')} as value from e
        union all select run_id, step, 'sigma', {r('sigma')} from e
        union all select run_id, step, 'kept', {r('kept')} from e
        union all select run_id, step, 'skipped', {r('1 - kept')} from e""",
    ),
    "m6_step_loss": Entry(
        m6_loss,
        f"""with {STATS} select run_id, step, count(*) as n_rows, {r('sum(-(reward - mu) * lp_new / 5)')} as loss
        from g where r_min <> r_max group by run_id, step""",
    ),
    "m7_any_correct_at_k": Entry(
        m7,
        f"""with {VERIFIED}, h as (select run_id, step, prompt_id, {', '.join(
            f"max(case when sample_id < {k} then reward else 0 end) as at_{k}" for k in (1, 2, 4))}
        from v group by run_id, step, prompt_id)
        select run_id, count(*) as groups, {', '.join(f"{r(f'avg(at_{k})')} as at_{k}" for k in (1, 2, 4))}
        from h group by run_id""",
    ),
}
