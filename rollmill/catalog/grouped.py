"""Queries over rollout groups: rewards, advantages, objectives, selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollmill.catalog.entries import (
    ARITH_ROLLOUTS,
    DOC_ROLLOUTS,
    ROW,
    SPIN_GENERATIONS,
    STATS,
    VERIFIED,
    Entry,
    clip,
    r,
    rounded_cols,
)
from rollmill.functions import losses as C
from rollmill.functions import verifiers as V
from rollmill.functions.numerics import rounded
from rollmill.operators import advantages as A
from rollmill.operators import objectives as O
from rollmill.operators import rewards as R
from rollmill.operators import selection as S
from rollmill.plans.session import written
from rollmill.sources import fixtures as fx
from rollmill.sources.layout import Grouped

IDS = ("run_id", "step", "prompt_id", "sample_id")
PRINCIPLES = [(1, "不知道|不清楚"), (2, "^ *$")]


def rows(df, *cols, digits=6):
    return rounded_cols(df.select(*IDS, *cols), cols, digits)


# --- rewards ---------------------------------------------------------------


def v1(spark, root):
    return rows(fx.verified_rollouts(spark, root), "reward")


def last_int(text, gold):
    """A user's verifier: the last integer of the text, as it is written, is gold."""
    return text.str.extract("(-?[0-9]+)[^0-9]*$", expand=False) == gold.astype("str")


def v1_user(spark, root):
    own = R.user_verifier(last_int)
    return rows(fx.arith_rollouts(spark, root).withColumn("reward", own(F.col("response"), F.col("gold"))), "reward")


def v2(spark, root):
    scored = V.length_reward(F.col("response"), F.col("gold"))
    return rows(fx.arith_rollouts(spark, root).withColumn("reward", scored), "reward")


def v5(spark, root):
    checked = R.constitution_check(fx.arith_rollouts(spark, root), PRINCIPLES)
    return checked.select(*IDS, "principle_id", "critique")


def outcomes(spark, root):
    """External pass/fail results on the same samples: the line's status; every seventh supplier reports none."""
    lines = fx.samples(spark, root).where("l_suppkey % 7 <> 0")
    return lines.select(
        F.col("l_orderkey").alias("prompt_id"), "sample_id", (F.col("l_linestatus") == "F").alias("passed")
    )


def v6(spark, root):
    return rows(R.outcome_reward(fx.arith_rollouts(spark, root), outcomes(spark, root)), "reward")


def v7(spark, root):
    both = R.outcome_reward(fx.arith_rollouts(spark, root), outcomes(spark, root)).withColumnRenamed("reward", "tool")
    both = both.withColumn("verified", V.first_int_reward(F.col("response"), F.col("gold"))).withColumn(
        "over", V.overlength_penalty(F.col("n_tok"))
    )
    mixed = V.composite_reward({"verified": 1.0, "tool": 0.25, "over": -1.0})
    return rows(both.withColumn("reward", mixed), "reward")


# --- group statistics and advantages ----------------------------------------


def a1(spark, root):
    stats = A.group_stats(fx.verified_rollouts(spark, root))
    return rounded_cols(stats, ["r_sum", "mu", "var", "sigma", "r_min", "r_max"])


def a2(spark, root):
    return A.drop_no_signal(fx.grouped_rollouts(spark, root), "equal").select(*IDS)


def a2_modes(spark, root):
    stats = A.group_stats(fx.verified_rollouts(spark, root))
    return stats.select(*A.KEYS, *[A.has_signal(m).alias(f"keep_{m}") for m in ("equal", "var", "all01", "tol")])


def advantage(fn):
    return lambda spark, root: rows(fn(fx.grouped_rollouts(spark, root)), "adv")


def a4_stored(spark, root):
    """A4 over rollouts stored by group: no row moves."""
    return rows(A.adv_grpo(fx.grouped_rollouts(spark, root, stored=True)), "adv")


def doc_advantage(fn):
    def build(spark, root):
        docs = fx.doc_rollouts(spark, root).select("prompt_id", "sample_id", "reward")
        return rounded_cols(fn(docs, ["prompt_id"]).select("prompt_id", "sample_id", "adv"), ["adv"])

    return build


def a7(spark, root):
    base = A.ema_baseline(fx.verified_rollouts(spark, root), dense=True)
    return rounded_cols(base, ["step_mean", "baseline", "baseline_next"])


def a8(spark, root):
    return rows(A.adv_reinforce_pp(fx.verified_rollouts(spark, root), dense=True), "adv", "baseline")


def charged(spark, root):
    """F1 with the length-charged reward of V2 and its parts."""
    return with_charge(fx.verified_rollouts(spark, root))


def with_charge(rollouts, target=2):
    charge = V.length_reward(F.col("response"), F.col("gold"), target)
    return rollouts.withColumnRenamed("reward", "correct").withColumn("reward", charge)


def a9(spark, root):
    groups = fx.grouped_rollouts(spark, root)
    return rows(A.adv_lcpo(Grouped(with_charge(groups.rows), groups.keys, groups.hot)), "adv")


def a10(spark, root):
    report = A.skip_report(fx.verified_rollouts(spark, root))
    return report.withColumn("skipped_so_far", F.col("skipped_so_far").cast("bigint"))


def a10_rows(spark, root):
    return A.drop_no_signal(fx.grouped_rollouts(spark, root), "all01").select(*IDS)


def trajectories(spark, root):
    """Prompt = trajectory, sample = time step, logged log-prob = value estimate."""
    steps = fx.grouped_rollouts(spark, root, stored=True).rows.withColumnRenamed("lp_new", "value")
    parts = fx.line_parts(spark, root)
    return A.gae(steps, ["prompt_id"], "sample_id", gamma=0.99, lam=0.95, keep=("lp_old", "lp_ref"), dense=True, parts=parts)


def a11(spark, root):
    out = trajectories(spark, root).select("prompt_id", "sample_id", "adv", "returns")
    return rounded_cols(out, ["adv", "returns"])


# --- objectives ---------------------------------------------------------------


def o1(spark, root):
    adv = A.adv_mean(fx.grouped_rollouts(spark, root))
    return rounded_cols(O.step_loss(adv, C.pg_loss(F.col("adv"), F.col("lp_new"))), ["loss"])


def o2(spark, root):
    adv = A.adv_grpo(fx.grouped_rollouts(spark, root))
    loss = C.grpo_loss(F.col("adv"), F.col("lp_new"), F.col("lp_ref"))
    out = O.step_loss(adv, loss, log_ratio=F.avg(C.log_ratio(F.col("lp_new"), F.col("lp_ref"))))
    return rounded_cols(out, ["loss", "log_ratio"], 5)


def o3(spark, root):
    adv = A.with_group_stats(fx.grouped_rollouts(spark, root), mode="all01")
    adv = adv.withColumn("adv", A.centred() / F.col("sigma"))
    return rows(adv.withColumn("loss", C.dapo_loss(F.col("adv"), F.col("lp_new"), F.col("lp_old"))), "loss")


def o4(spark, root):
    adv = A.adv_grpo(fx.grouped_rollouts(spark, root))
    cols = (F.col("lp_new"), F.col("lp_old"), F.col("n_tok"))
    clipped = C.is_clipped(C.seq_ratio(*cols), 0.99, 1.01)
    out = O.step_loss(adv, C.gspo_loss(F.col("adv"), *cols, eps=0.01), clipped=F.count_if(clipped))
    return rounded_cols(out, ["loss"], 5)


def o8(spark, root):
    t = trajectories(spark, root)
    loss = C.ppo_clip_loss(F.col("adv"), F.col("value"), F.col("lp_old"), F.col("lp_ref"))
    critic = C.value_loss(F.col("value"), F.col("returns"))
    out = t.select("prompt_id", "sample_id", loss.alias("loss"), critic.alias("critic_loss"))
    return rounded_cols(out, ["loss", "critic_loss"], 5)


def o9(spark, root):
    report = O.ratio_report(fx.arith_rollouts(spark, root), seq_eps=0.01, plain_eps=(0.03, 0.03))
    return rounded_cols(report, [c for c in report.columns if c not in ("run_id", "step", "n_rows")])


# --- selection ----------------------------------------------------------------


def d1(spark, root):
    return S.rejection_sample(fx.verified_rollouts(spark, root)).select(*IDS, "prompt", "response")


def d1_report(spark, root):
    return S.rejection_report(fx.verified_rollouts(spark, root)).withColumn(
        "kept_so_far", F.col("kept_so_far").cast("bigint")
    )


def d2(spark, root):
    top = S.top_k_per_prompt(fx.verified_rollouts(spark, root), 2)
    return top.select(*IDS, F.col("rank").cast("bigint").alias("rank"))


def rounds(spark, root):
    return fx.verified_rollouts(spark, root).withColumn("round", F.col("step") % 3)


def d3(spark, root):
    return rounded_cols(S.star_rounds(rounds(spark, root)), ["accuracy", "delta"])


def d3_start(spark, root):
    """Each group's first answer stands for what the model knew before the first round."""
    sampled = rounds(spark, root)
    found = S.star_rounds(sampled.where("sample_id > 0"), start=sampled.where("sample_id = 0"))
    return rounded_cols(found, ["accuracy", "delta"])


def d4(spark, root):
    rows_of_rounds = rounds(spark, root).select(*IDS, "round", "prompt", "response", "reward")
    scored = S.star_refit(written(rows_of_rounds, "rounds"), IDS)
    return rounded_cols(scored, ["sum_lp"])


def d5(spark, root):
    groups = fx.grouped_rollouts(spark, root)
    judged = groups.rows.withColumn("score", V.rule_judge(F.col("response"), ("是", "ok"), 4, 80))
    return S.best_worst_pairs(Grouped(judged, groups.keys, groups.hot), "score", A.KEYS, judge="rule")


def d6(spark, root):
    return S.spin_pairs(fx.sft_turns(spark, root), fx.spin_generations(spark, root), ("conv_id", "turn"), 1)


def d7(spark, root):
    revised = F.concat(F.lit("答案是"), F.col("gold").cast("string"), F.lit("。"))
    out = S.critique_revise(fx.arith_rollouts(spark, root), PRINCIPLES, revised)
    return out.select(*IDS, "prompt", "initial", "critique", "revised", "principle_id")


def d8(spark, root):
    kept = S.distill_set(fx.verified_rollouts(spark, root), F.col("run_id") == "1-URGENT")
    return kept.select(*IDS, "prompt", "response")


def d9(spark, root):
    return S.mine_hard_pairs(fx.grouped_rollouts(spark, root)).select(*A.KEYS, "chosen", "rejected")


# --- the same in SQL ------------------------------------------------------------


def adv_sql(expr, where):
    return f"with {STATS} select {ROW}, {r(expr)} as adv from g where {where}"


def doc_sql(expr, where):
    return f"""with {DOC_ROLLOUTS}, s as (select prompt_id, count(*) as k, sum(reward) as r_sum, avg(reward) as mu,
        var_pop(reward) as var, sqrt(var_pop(reward)) + 1e-6 as sigma, min(reward) as r_min, max(reward) as r_max
        from doc_rollouts group by prompt_id)
        select prompt_id, sample_id, {r(expr)} as adv from doc_rollouts join s using (prompt_id) where {where}"""


CENTRED = "reward - mu"
ZSCORE = "(reward - mu) / sigma"
LOO = "reward - (r_sum - reward) / nullif(k - 1, 0)"
MIXED = "r_min <> r_max"

EMA = (
    VERIFIED
    + """,
sm as (select run_id, step, avg(reward) as m from v group by run_id, step),
sl as (select *, coalesce(list(m) over (partition by run_id order by step rows between unbounded preceding
       and 1 preceding), []) as past from sm),
em as (select run_id, step, m, list_reduce(list_prepend(0::double, past), lambda a, x: 0.9::double * a + 0.1::double * x) as b
       from sl)"""
)

GAE = (
    VERIFIED
    + """,
dl as (select prompt_id, sample_id, lp_new, lp_old, lp_ref, reward + 0.99::double * coalesce(lead(lp_new) over
       (partition by prompt_id order by sample_id), 0) - lp_new as delta from v),
ga as (select a.prompt_id, a.sample_id, a.lp_new, a.lp_old, a.lp_ref,
              sum(pow(0.99::double * 0.95::double, b.sample_id - a.sample_id) * b.delta) as adv
       from dl a join dl b on b.prompt_id = a.prompt_id and b.sample_id >= a.sample_id group by all)"""
)

N_WORDS = r"len(list_filter(string_split_regex(lower(response), '\s+'), lambda t: t <> ''))"
OUTCOMES = """ol as (select l_orderkey as prompt_id, l_suppkey, cast(row_number() over (partition by l_orderkey
       order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
       l_linestatus, l_shipdate) - 1 as bigint) as sample_id,
       case when l_linestatus = 'F' then 1::double else 0::double end as tool from lineitem),
oc as (select prompt_id, sample_id, tool from ol where l_suppkey % 7 <> 0),
vo as (select v.*, coalesce(oc.tool, 0) as tool from v left join oc using (prompt_id, sample_id))"""
CHARGED = f"(reward - 0.5::double * greatest({N_WORDS} - 2, 0) / 2)"
LCPO = (
    VERIFIED
    + f""",
c as (select *, {CHARGED} as charged from v),
cs as (select run_id, step, prompt_id, avg(charged) as cm, min(charged) as lo, max(charged) as hi from c group by all)"""
)
RHO = "exp(lp_new - lp_old)"
SEQ = "exp((lp_new - lp_old) / greatest(n_tok, 1))"
ROUNDS = VERIFIED + ", rr as (select *, step % 3 as round from v)"


def o3_sql():
    bound = f"case when adv >= 0 then least({RHO}, 1.28::double) else greatest({RHO}, 0.8::double) end"
    return f"""with {STATS}, ga as (select *, (reward - mu) / sigma as adv from g where not (r_min = r_max and r_min in (0, 1)))
    select {ROW}, {r(f"-least({RHO} * adv, ({bound}) * adv) / 5")} as loss from ga"""


def o4_sql():
    low = clip(SEQ, 0.99, 1.01)
    return f"""with {STATS}, ga as (select *, (reward - mu) / sigma as adv from g where var >= 1e-12)
    select run_id, step, count(*) as n_rows, {r(f"sum(-least({SEQ} * adv, {low} * adv) / 5)", 5)} as loss,
           count(*) filter (abs({SEQ} - {low}) > 1e-9) as clipped from ga group by run_id, step"""


def o9_sql():
    parts = []
    for name, x, lo, hi in (("plain", RHO, 0.97, 1.03), ("seq", SEQ, 0.99, 1.01)):
        parts += [f"{r(f'{f}({x})')} as {name}_{n}" for f, n in (("avg", "mean"), ("min", "min"), ("max", "max"))]
        share = f"avg(case when abs({x} - {clip(x, lo, hi)}) > 1e-9 then 1 else 0 end)"
        parts.append(f"{r(share)} as {name}_clipped")
    return f"with {ARITH_ROLLOUTS} select run_id, step, count(*) as n_rows, {', '.join(parts)} from arith_rollouts group by run_id, step"


BEST = """arg_max(response, (score, -sample_id)) as chosen, arg_min(response, (score, -sample_id)) as rejected,
       arg_max(sample_id, (score, -sample_id)) as chosen_id, arg_min(sample_id, (score, -sample_id)) as rejected_id"""

CRITIC_LOSS = "pow(lp_new - (adv + lp_new), 2)"
PPO = f"-least({RHO} * adv, {clip(RHO, 0.8, 1.2)} * adv) + 0.02::double * (lp_new - lp_ref)"

ENTRIES = {
    "v1_first_int_reward": Entry(v1, f"with {VERIFIED} select {ROW}, {r('reward')} as reward from v"),
    "v1_user_verifier": Entry(
        v1_user,
        f"""with {ARITH_ROLLOUTS} select {ROW}, case when regexp_extract(response, '(-?[0-9]+)[^0-9]*$', 1) = gold::bigint::varchar
        then 1::double else 0::double end as reward from arith_rollouts""",
    ),
    "v2_length_reward": Entry(
        v2, f"with {VERIFIED} select {ROW}, {r(f'reward - 0.5::double * greatest({N_WORDS} - 4, 0) / 4')} as reward from v"
    ),
    "v5_constitution_check": Entry(
        v5,
        f"""with {ARITH_ROLLOUTS}, c as (select *, case when regexp_matches(response, '不知道|不清楚') then 1
        when regexp_matches(response, '^ *$') then 2 end::bigint as principle_id from arith_rollouts)
        select {ROW}, principle_id, '违反原则#' || principle_id::varchar as critique from c""",
    ),
    "v6_outcome_reward": Entry(v6, f"with {VERIFIED}, {OUTCOMES} select {ROW}, {r('tool')} as reward from vo"),
    "v7_composite_reward": Entry(
        v7,
        f"with {VERIFIED}, {OUTCOMES} select {ROW}, "
        f"{r('reward + 0.25::double * tool - 0.5::double * greatest(n_tok - 4, 0) / 4')} as reward from vo",
    ),
    "a1_group_stats": Entry(
        a1,
        f"with {STATS} select run_id, step, prompt_id, k, n_correct, {r('r_sum')} as r_sum, {r('mu')} as mu, "
        f"{r('var')} as var, {r('sigma')} as sigma, {r('r_min')} as r_min, {r('r_max')} as r_max from s",
    ),
    "a2_drop_no_signal": Entry(a2, f"with {STATS} select {ROW} from g where {MIXED}"),
    "a10_kept_rows": Entry(
        a10_rows, f"with {STATS} select {ROW} from g where not (r_min = r_max and r_min in (0, 1))"
    ),
    "a2_signal_modes": Entry(
        a2_modes,
        f"""with {STATS} select run_id, step, prompt_id, {MIXED} as keep_equal, var >= 1e-12 as keep_var,
        not (r_min = r_max and r_min in (0, 1)) as keep_all01, greatest(r_max - mu, mu - r_min) >= 1e-9 as keep_tol from s""",
    ),
    "a3_adv_mean": Entry(advantage(A.adv_mean), adv_sql(CENTRED, f"{MIXED} and {CENTRED} <> 0")),
    "a4_adv_grpo": Entry(advantage(A.adv_grpo), adv_sql(ZSCORE, "var >= 1e-12")),
    "a4_adv_grpo_stored": Entry(a4_stored, adv_sql(ZSCORE, "var >= 1e-12")),
    "a5_adv_dr_grpo": Entry(advantage(A.adv_dr_grpo), adv_sql(CENTRED, MIXED)),
    "a6_adv_rloo": Entry(advantage(A.adv_rloo), adv_sql(LOO, f"{MIXED} and {LOO} <> 0")),
    "a3_adv_mean_docs": Entry(doc_advantage(A.adv_mean), doc_sql(CENTRED, f"{MIXED} and {CENTRED} <> 0")),
    "a4_adv_grpo_docs": Entry(doc_advantage(A.adv_grpo), doc_sql(ZSCORE, "var >= 1e-12")),
    "a6_adv_rloo_docs": Entry(doc_advantage(A.adv_rloo), doc_sql(LOO, f"{MIXED} and {LOO} <> 0")),
    "a7_ema_baseline": Entry(
        a7,
        f"with {EMA} select run_id, step, {r('m')} as step_mean, {r('b')} as baseline, "
        f"{r('0.9::double * b + 0.1::double * m')} as baseline_next from em",
    ),
    "a8_adv_reinforce_pp": Entry(
        a8,
        f"""with {EMA}, s as (select run_id, step, prompt_id, avg(reward) as mu, var_pop(reward) as var from v group by all)
        select {ROW}, {r(clip("(reward - mu) / (sqrt(var) + 1e-6)", -5, 5))} as adv, {r('b')} as baseline
        from v join s using (run_id, step, prompt_id) join em using (run_id, step) where var >= 1e-12""",
    ),
    "a9_adv_lcpo": Entry(
        a9,
        f"""with {LCPO} select {ROW}, {r('charged - cm')} as adv from c join cs using (run_id, step, prompt_id)
        where greatest(hi - cm, cm - lo) >= 1e-9 and abs(charged - cm) >= 1e-9""",
    ),
    "a10_dynamic_sampling": Entry(
        a10,
        f"""with {STATS}, ps as (select run_id, step, count(*) as groups,
        count(*) filter (r_min = r_max and r_min in (0, 1)) as skipped from s group by run_id, step)
        select *, (sum(skipped) over (partition by run_id order by step))::bigint as skipped_so_far from ps""",
    ),
    "a11_gae": Entry(
        a11, f"with {GAE} select prompt_id, sample_id, {r('adv')} as adv, {r('adv + lp_new')} as returns from ga"
    ),
    "o1_pg_loss": Entry(
        o1,
        f"""with {STATS} select run_id, step, count(*) as n_rows, {r('sum(-(reward - mu) * lp_new / 5)')} as loss
        from g where {MIXED} and {CENTRED} <> 0 group by run_id, step""",
    ),
    "o2_grpo_loss": Entry(
        o2,
        f"""with {STATS} select run_id, step, count(*) as n_rows,
        {r('sum((-(reward - mu) / sigma * lp_new + 0.02::double * pow(lp_new - lp_ref, 2)) / 5)', 5)} as loss,
        {r('avg(lp_new - lp_ref)', 5)} as log_ratio from g where var >= 1e-12 group by run_id, step""",
    ),
    "o3_dapo_loss": Entry(o3, o3_sql()),
    "o4_gspo_loss": Entry(o4, o4_sql()),
    "o8_ppo_clip_loss": Entry(
        o8,
        f"with {GAE} select prompt_id, sample_id, {r(PPO, 5)} as loss, {r(CRITIC_LOSS, 5)} as critic_loss from ga",
    ),
    "o9_ratio_report": Entry(o9, o9_sql()),
    "d1_rejection_sample": Entry(d1, f"with {VERIFIED} select {ROW}, prompt, response from v where reward = 1"),
    "d1_rejection_report": Entry(
        d1_report,
        f"""with {VERIFIED}, ps as (select run_id, step, count(*) as sampled, count(*) filter (reward = 1) as kept
        from v group by run_id, step)
        select *, (sum(kept) over (partition by run_id order by step))::bigint as kept_so_far from ps""",
    ),
    "d2_top_k_per_prompt": Entry(
        d2,
        f"""with {VERIFIED}, t as (select {ROW}, row_number() over (partition by run_id, step, prompt_id
        order by reward desc, sample_id) as rank from v) select * from t where rank <= 2""",
    ),
    "d3_star_rounds": Entry(
        d3,
        f"""with {ROUNDS}, ra as (select run_id, round, count(*) as sampled, count(*) filter (reward = 1) as kept,
        avg(reward) as a from rr group by run_id, round)
        select run_id, round, sampled, kept, {r('a')} as accuracy,
               {r('a - lag(a) over (partition by run_id order by round)')} as delta,
               array_to_string(list(round(a * 100 + 1.7e-9)::bigint::varchar || '%')
                 over (partition by run_id order by round), ' -> ') as trajectory from ra""",
    ),
    "d3_star_rounds_from_start": Entry(
        d3_start,
        f"""with {ROUNDS}, r0 as (select run_id, avg(reward) as a0 from rr where sample_id = 0 group by run_id),
        ra as (select run_id, round, count(*) as sampled, count(*) filter (reward = 1) as kept,
        avg(reward) as a from rr where sample_id > 0 group by run_id, round)
        select run_id, round, sampled, kept, {r('a')} as accuracy,
               {r('a - coalesce(lag(a) over (partition by run_id order by round), a0)')} as delta,
               round(a0 * 100 + 1.7e-9)::bigint::varchar || '% -> ' || array_to_string(list(round(a * 100 + 1.7e-9)::bigint::varchar || '%')
                 over (partition by run_id order by round), ' -> ') as trajectory from ra join r0 using (run_id)""",
    ),
    "d4_star_refit": Entry(
        d4,
        rf"""with {ROUNDS},
        rw as (select {ROW}, round, reward, list_last(list_filter(string_split_regex(lower(prompt), '\s+'), lambda t: t <> '')) as p_last,
               list_filter(string_split_regex(lower(response), '\s+'), lambda t: t <> '') as ws from rr),
        rt as (select {ROW}, round, reward, p_last, unnest(ws) as w, generate_subscripts(ws, 1) as pos from rw),
        rc as (select *, coalesce(lag(w) over (partition by {ROW} order by pos), p_last) as ctx from rt),
        ng as (select round, ctx, w, count(*) as n from rc where reward = 1 group by all),
        cx as (select round, ctx, sum(n) as n from ng group by all),
        sz as (select round, count(distinct w) + 1 as v from ng group by round)
        select {ROW}, rc.round, count(*) as n_tok,
               {r('sum(ln((coalesce(ng.n, 0) + 0.5::double) / (coalesce(cx.n, 0) + 0.5::double * sz.v)))')} as sum_lp
        from rc join sz on sz.round = rc.round - 1 left join ng on ng.round = sz.round and ng.ctx = rc.ctx and ng.w = rc.w
             left join cx on cx.round = sz.round and cx.ctx = rc.ctx
        group by {ROW}, rc.round""",
    ),
    "d5_best_worst_pairs": Entry(
        d5,
        f"""with {ARITH_ROLLOUTS}, j as (select *, case when (contains(response, '是') or contains(response, 'ok'))
        and length(response) between 4 and 80 then 1::double else 0::double end as score from arith_rollouts)
        select run_id, step, prompt_id, {BEST}, max(score) as best_score, min(score) as worst_score,
               max(score) = min(score) as tied, 'rule' as judge from j group by run_id, step, prompt_id""",
    ),
    "d6_spin_pairs": Entry(
        d6,
        f"""with {SPIN_GENERATIONS} select conv_id, turn, 1::bigint as round, prompt, response as chosen,
        case when not regexp_matches(generation, '[^[:space:]]') then '（空）' else generation end as rejected
        from sft_turns join spin_generations using (conv_id, turn)""",
    ),
    "d7_critique_revise": Entry(
        d7,
        f"""with {ARITH_ROLLOUTS}, c as (select *, case when regexp_matches(response, '不知道|不清楚') then 1
        when regexp_matches(response, '^ *$') then 2 end::bigint as principle_id from arith_rollouts)
        select {ROW}, prompt, response as initial, '违反原则#' || principle_id::varchar as critique,
               '答案是' || gold::varchar || '。' as revised, principle_id from c where principle_id is not null""",
    ),
    "d8_distill_set": Entry(
        d8, f"with {VERIFIED} select {ROW}, prompt, response from v where reward = 1 and run_id = '1-URGENT'"
    ),
    "d9_mine_hard_pairs": Entry(
        d9,
        f"""with {VERIFIED}, j as (select *, reward as score from v)
        select run_id, step, prompt_id, arg_max(response, (score, -sample_id)) as chosen,
               arg_min(response, (score, -sample_id)) as rejected
        from j group by run_id, step, prompt_id having max(score) = 1 and min(score) < 1""",
    ),
}
