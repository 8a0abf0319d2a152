"""Queries over preference losses, anchors, reports and scorers."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from rollmill.catalog.entries import (
    DOC_ROLLOUTS,
    SCORED_PAIRS,
    SPIN_GENERATIONS,
    Entry,
    lm_sql,
    nls,
    r,
    r_as,
    rounded_cols,
    sigmoid,
    tokens_sql,
)
from rollmill.catalog.language import lm
from rollmill.functions import losses as C
from rollmill.functions.numerics import neg_log_sigmoid, rounded
from rollmill.operators import ngram as L
from rollmill.operators import preference as P
from rollmill.operators.selection import spin_pairs
from rollmill.plans.session import shared_dir, written
from rollmill.sources import fixtures as fx


def lps():
    return [F.col(c) for c in P.PAIR_LPS]


def means():
    return F.col("lp_c") / F.col("n_c"), F.col("lp_r") / F.col("n_r")


def per_pair(spark, root, **cols):
    pairs = fx.scored_pairs(spark, root)
    return pairs.select("prompt_id", *[rounded(c).alias(n) for n, c in cols.items()])


def p1(spark, root):
    return per_pair(spark, root, loss=C.dpo_loss(*lps()))


def p2(spark, root):
    rows = P.dpo_metrics(fx.scored_pairs(spark, root))
    return rows.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        rounded(F.avg("loss")).alias("loss"),
        rounded(F.avg("margin")).alias("margin"),
        rounded(F.avg("correct")).alias("accuracy"),
    )


def p3(spark, root):
    return per_pair(spark, root, loss=C.ipo_loss(*lps()), gap=C.pair_margin(*lps()) - F.lit(C.ipo_target()))


def p4(spark, root):
    pairs = fx.scored_pairs(spark, root).select("run_id", "prompt_id", "lp_c", "lpref_c")
    whole = P.kto_z0(pairs, "global", "lp_c", "lpref_c").withColumnRenamed("z0", "z0_global")
    both = P.kto_z0(whole, "batch", "lp_c", "lpref_c", ["run_id"]).withColumnRenamed("z0", "z0_run")
    return rounded_cols(both.select("prompt_id", "z0_global", "z0_run"), ["z0_global", "z0_run"])


def p5(spark, root):
    """The scores are written once: the anchor reads them all before any loss."""
    docs = fx.doc_rollouts(spark, root)
    scored = written(L.seq_logp(lm(spark, root, "policy", "ref"), docs, ["sample_id", "reward"], prompt=None), "scored")
    rows = P.kto_z0(scored, "global", "lp_policy", "lp_ref")
    loss = C.kto_loss(F.col("lp_policy"), F.col("lp_ref"), F.col("reward"), F.col("z0"))
    return rounded_cols(rows.select("sample_id", "z0", loss.alias("loss")), ["z0", "loss"], 4)


def p6(spark, root):
    mc, mr = means()
    return per_pair(
        spark,
        root,
        sft=C.orpo_sft_loss(F.col("lp_c"), F.col("n_c")),
        odds=C.orpo_odds_loss(mc, mr),
        loss=C.orpo_loss(F.col("lp_c"), F.col("n_c"), mc, mr),
    )


def p7(spark, root):
    mc, mr = means()
    above = ((mc - mr) > F.lit(C.simpo_target())).cast("double")
    return per_pair(spark, root, loss=C.simpo_loss(mc, mr), above=above)


REPORT = (
    "dpo_loss", "margin", "accuracy", "ipo_loss", "ipo_gap", "orpo_sft", "orpo_odds", "orpo_loss",
    "simpo_loss", "mean_lp_gap", "simpo_above",
)


def p8(spark, root):
    pairs = fx.scored_pairs(spark, root).withColumn("slice", F.col("step") % 10)
    return rounded_cols(P.preference_report(pairs, ["run_id", "slice"]), REPORT, 5)


def p8_rollup(spark, root):
    """The report per run and slice, per run, and over all pairs."""
    pairs = fx.scored_pairs(spark, root).withColumn("slice", F.col("step") % 10)
    return rounded_cols(P.preference_rollup(pairs, ["run_id", "slice"]), REPORT, 5)


def margin_features():
    """How far the policy prefers the chosen answer against its reference, and how much longer that is."""
    return {"lp_gap": C.pair_margin(*lps()), "length_gap": (F.col("n_c") - F.col("n_r")).cast("double")}


def p9(kind):
    def build(spark, root):
        """Pairs scored by a certified fit on four prompts in five. The pairs are written once."""
        pairs = fx.scored_pairs(spark, root).select("prompt_id", *P.PAIR_LPS, "n_c", "n_r")
        pairs = written(pairs.withColumn("held_out", F.expr("pmod(prompt_id, 5) = 0")), "pairs")
        scorer = P.fit_margin_scorer(pairs.where("not held_out"), margin_features(), kind)
        margin = scorer.margin(margin_features())
        return pairs.select("prompt_id", "held_out", rounded(margin).alias("margin"), (margin > 0).cast("bigint").alias("correct"))

    return build


def fitted_scorer(spark, root, kind):
    """Pairs scored by a scorer that has seen four prompts in five; held_out: the others. The pairs are written once."""
    pairs = fx.scored_pairs(spark, root).select("prompt_id", "chosen", "rejected")
    path = shared_dir(spark, "pairs")
    pairs.withColumn("held_out", F.expr("pmod(prompt_id, 5) = 0")).write.parquet(path)
    pairs = spark.read.schema("prompt_id bigint, chosen string, rejected string, held_out boolean").parquet(path)
    return P.score_pairs(P.fit_preference_scorer(pairs.where("not held_out"), kind), pairs)


def p9_words(kind):
    def build(spark, root):
        return fitted_scorer(spark, root, kind).select("prompt_id", "held_out", "margin", "correct")

    return build


def p9_report(spark, root):
    """Pairs per split, and whether the pairs learned from are told apart better than by a coin."""
    scored = fitted_scorer(spark, root, "bt").withColumn("loss", neg_log_sigmoid(F.col("margin")))
    return scored.agg(
        F.count_if(~F.col("held_out")).alias("n_fit"),
        F.count_if("held_out").alias("n_held_out"),
        (F.avg(F.expr("if(held_out, null, loss)")) < math.log(2)).alias("fit_beats_coin"),
    )


def p1_spin(spark, root):
    """Self-play: the gold answer against a generation, opponent = reference model."""
    pairs = spin_pairs(fx.sft_turns(spark, root), fx.spin_generations(spark, root), ("conv_id", "turn"))
    sides = F.array(
        F.struct(F.lit("c").alias("side"), F.col("chosen").alias("response")),
        F.struct(F.lit("r").alias("side"), F.col("rejected").alias("response")),
    )
    samples = pairs.select("conv_id", "turn", "prompt", F.inline(sides))
    scored = L.seq_logp(lm(spark, root, "policy", "ref"), samples, ["conv_id", "turn", "side"])
    at = {
        f"{m}_{s}": F.max(F.when(F.col("side") == s, F.col(f"lp_{m}")))
        for m in ("policy", "ref")
        for s in ("c", "r")
    }
    wide = scored.groupBy("conv_id", "turn").agg(*[c.alias(n) for n, c in at.items()])
    cols = [F.col(c) for c in ("policy_c", "policy_r", "ref_c", "ref_r")]
    return wide.select(
        "conv_id",
        "turn",
        rounded(C.pair_margin(*cols), 4).alias("margin"),
        rounded(C.dpo_loss(*cols), 4).alias("loss"),
    )


MARGIN = "((lp_c - lpref_c) - (lp_r - lpref_r))"
DPO = nls(f"0.1::double * {MARGIN}")
IPO = f"pow({MARGIN} - 5, 2)"
MC, MR = "(lp_c / n_c)", "(lp_r / n_r)"


def odds(m):
    return f"({m} - ln(1 - least(exp({m}), 0.999999::double)))"


ODDS = f"0.5::double * {nls(f'{odds(MC)} - {odds(MR)}')}"
SFT = "(-lp_c / greatest(n_c, 1))"
SIMPO = nls(f"2.5::double * ({MC} - {MR}) - 1.4::double")
ABOVE = f"(case when {MC} - {MR} > 0.56::double then 1 else 0 end)"
RIGHT = f"(case when {MARGIN} > 0 then 1 else 0 end)"


REPORT_SQL = r_as(
    {
        n: f"avg({e})"
        for n, e in zip(
            REPORT,
            (DPO, MARGIN, RIGHT, IPO, f"{MARGIN} - 5", SFT, ODDS, f"{SFT} + {ODDS}", SIMPO, f"{MC} - {MR}", ABOVE),
            strict=True,
        )
    },
    5,
)


def pair_sql(**cols):
    return f"with {SCORED_PAIRS} select prompt_id, {r_as(cols)} from scored_pairs"


def newton_sql(kind: str, steps: int) -> str:
    """The two weights by Newton steps, one CTE each; a step solves two equations."""
    steps_sql = [
        f"""f as materialized (select prompt_id, prompt_id % 5 = 0 as held_out, {MARGIN}::double as a, (n_c - n_r)::double as b
        from scored_pairs), w0 as (select 0::double as u, 0::double as v)"""
    ]
    z = "(u * a + v * b)"
    slope = f"-{sigmoid(f'-{z}')}" if kind == "bt" else f"({z} - 5)"
    bend = f"{sigmoid(z)} * {sigmoid(f'-{z}')}" if kind == "bt" else "1"
    for i in range(steps):
        steps_sql.append(
            f"""w{i + 1} as materialized (select u - (hbb * ga - hab * gb) / (haa * hbb - hab * hab) as u,
            v - (haa * gb - hab * ga) / (haa * hbb - hab * hab) as v
            from (select any_value(u) as u, any_value(v) as v, avg({slope} * a) + 0.001 * any_value(u) as ga,
                         avg({slope} * b) + 0.001 * any_value(v) as gb, avg({bend} * a * a) + 0.001 as haa,
                         avg({bend} * a * b) as hab, avg({bend} * b * b) + 0.001 as hbb
                  from f, w{i} where not held_out))"""
        )
    return (
        f"with {SCORED_PAIRS}, {', '.join(steps_sql)} select prompt_id, held_out, {r(z)} as margin, "
        f"({z} > 0)::bigint as correct from f, w{steps}"
    )


ENTRIES = {
    "p1_dpo_loss": Entry(p1, pair_sql(loss=DPO)),
    "p1_spin_dpo": Entry(
        p1_spin,
        f"""with {SPIN_GENERATIONS}, sp as (
        select conv_id, turn, prompt, 'c' as side, response from sft_turns
        union all select conv_id, turn, prompt, 'r', case when not regexp_matches(generation, '[^[:space:]]') then '（空）' else generation end
        from sft_turns join spin_generations using (conv_id, turn)),
        {lm_sql(('policy', 'ref'))}, {tokens_sql(('policy', 'ref'), 'sp', 'conv_id, turn, side')},
        d as (select conv_id, turn, sum(case when side = 'c' then lp_policy - lp_ref else lp_ref - lp_policy end) as m
              from tk group by conv_id, turn)
        select conv_id, turn, {r('m', 4)} as margin, {r(nls('0.1::double * m'), 4)} as loss from d""",
    ),
    "p2_dpo_metrics": Entry(
        p2,
        f"with {SCORED_PAIRS} select run_id, count(*) as n_pairs, "
        f"{r_as({'loss': f'avg({DPO})', 'margin': f'avg({MARGIN})', 'accuracy': f'avg({RIGHT})'})} "
        "from scored_pairs group by run_id",
    ),
    "p3_ipo_loss": Entry(p3, pair_sql(loss=IPO, gap=f"{MARGIN} - 5")),
    "p4_kto_z0": Entry(
        p4,
        f"with {SCORED_PAIRS} select prompt_id, {r('avg(lp_c - lpref_c) over ()')} as z0_global, "
        f"{r('avg(lp_c - lpref_c) over (partition by run_id)')} as z0_run from scored_pairs",
    ),
    "p5_kto_loss": Entry(
        p5,
        f"""with {DOC_ROLLOUTS}, {lm_sql(('policy', 'ref'))},
        {tokens_sql(('policy', 'ref'), 'doc_rollouts', 'sample_id, reward', prompt=None)},
        sl as (select d.sample_id, d.reward, coalesce(sum(lp_policy - lp_ref), 0) as d
               from doc_rollouts d left join tk using (sample_id) group by d.sample_id, d.reward),
        z as (select *, avg(d) over () as z0 from sl)
        select sample_id, {r('z0', 4)} as z0,
               {r(f"1 - case when reward = 1 then {sigmoid('0.1::double * (d - z0)')} else {sigmoid('-0.1::double * (d - z0)')} end", 4)} as loss
        from z""",
    ),
    "p6_orpo_loss": Entry(p6, pair_sql(sft=SFT, odds=ODDS, loss=f"{SFT} + {ODDS}")),
    "p7_simpo_loss": Entry(p7, pair_sql(loss=SIMPO, above=ABOVE)),
    "p8_preference_report": Entry(
        p8,
        f"with {SCORED_PAIRS} select run_id, step % 10 as slice, count(*) as n_pairs, {REPORT_SQL} "
        "from scored_pairs group by run_id, step % 10",
    ),
    "p8_preference_rollup": Entry(
        p8_rollup,
        f"""with {SCORED_PAIRS} select grouping(run_id, slice)::bigint as level, run_id, slice, count(*) as n_pairs, {REPORT_SQL}
        from (select *, step % 10 as slice from scored_pairs) group by rollup (run_id, slice)""",
    ),
    "p9_preference_scorer_bt": Entry(p9("bt"), newton_sql("bt", 14)),
    "p9_preference_scorer_ls": Entry(p9("ls"), newton_sql("ls", 2)),
    "p9_word_scorer_bt": Entry(p9_words("bt")),
    "p9_word_scorer_ls": Entry(p9_words("ls")),
    "p9_scorer_report": Entry(
        p9_report,
        f"with {SCORED_PAIRS} select count(*) filter (prompt_id % 5 <> 0) as n_fit, "
        "count(*) filter (prompt_id % 5 = 0) as n_held_out, true as fit_beats_coin from scored_pairs",
    ),
}
