import math
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rollmill.operators import advantages as A
from rollmill.operators import datasets as D
from rollmill.operators import monitor as M
from rollmill.operators import ngram as L
from rollmill.operators import objectives as O
from rollmill.operators import preference as P
from rollmill.operators import rewards as R
from rollmill.operators import selection as S
from rollmill.sources import fixtures as fx
from rollmill.sources import tables as T

G = ["prompt_id"]


def rollouts(spark, groups):
    rows = [(g, i, float(r)) for g, rs in enumerate(groups) for i, r in enumerate(rs)]
    return spark.createDataFrame(rows, "prompt_id bigint, sample_id bigint, reward double")


def advs(df):
    return {(r.prompt_id, r.sample_id): r.adv for r in df.select("prompt_id", "sample_id", "adv").collect()}


GROUPS = ([1, 0, 0, 1], [1, 1, 1, 1], [0, 0], [1], [0.5, 0.5])


def test_group_stats_are_population_stats(spark):
    row = A.group_stats(rollouts(spark, GROUPS), G).where("prompt_id = 0").first()
    assert (row.k, row.mu, row["var"], row.n_correct) == (4, 0.5, 0.25, 2)
    assert row.sigma == 0.5 + 1e-6


@pytest.mark.parametrize(
    ("mode", "kept"), [("equal", {0}), ("var", {0}), ("tol", {0}), ("all01", {0, 4})]
)
def test_signal_tests_differ(spark, mode, kept):
    got = A.drop_no_signal(rollouts(spark, GROUPS), mode, G)
    assert {r.prompt_id for r in got.collect()} == kept


def test_unknown_signal_test_is_refused():
    with pytest.raises(ValueError, match="no signal test"):
        A.has_signal("nope")


def test_advantages_by_hand(spark):
    df = rollouts(spark, ([1, 0, 0, 1],))
    assert advs(A.adv_mean(df, G)) == {(0, 0): 0.5, (0, 1): -0.5, (0, 2): -0.5, (0, 3): 0.5}
    assert advs(A.adv_rloo(df, G))[(0, 0)] == pytest.approx(1 - 1 / 3)
    assert advs(A.adv_grpo(df, G))[(0, 1)] == pytest.approx(-0.5 / (0.5 + 1e-6))


def test_zero_rows_drop_only_where_the_method_skips_them(spark):
    df = rollouts(spark, ([0, 0.5, 1],))
    assert len(advs(A.adv_mean(df, G))) == 2
    assert len(advs(A.adv_rloo(df, G))) == 2
    assert len(advs(A.adv_dr_grpo(df, G))) == 3


def test_size_one_groups_have_no_signal(spark):
    assert advs(A.adv_rloo(rollouts(spark, ([1],)), G)) == {}


@pytest.mark.parametrize("fn", [A.adv_mean, A.adv_grpo, A.adv_dr_grpo, A.adv_rloo])
def test_advantages_sum_to_zero(spark, root, fn):
    sums = fn(fx.verified_rollouts(spark, root)).groupBy(*A.KEYS).agg(F.sum("adv").alias("s"))
    assert sums.agg(F.max(F.abs("s"))).first()[0] < 1e-9


def test_leave_one_out_is_a_scaled_mean_baseline(spark, root):
    v = fx.verified_rollouts(spark, root)
    ids = [*A.KEYS, "sample_id"]
    both = A.adv_rloo(v).select(*ids, "k", F.col("adv").alias("loo")).join(A.adv_mean(v).select(*ids, "adv"), ids)
    gap = both.select(F.max(F.abs(F.col("loo") - F.col("k") / (F.col("k") - 1) * F.col("adv")))).first()[0]
    assert gap < 1e-12


def test_running_baseline_cancels_in_the_z_score(spark, root):
    v = fx.verified_rollouts(spark, root)
    ids = [*A.KEYS, "sample_id"]
    both = A.adv_reinforce_pp(v, bound=1e9).select(*ids, F.col("adv").alias("pp")).join(A.adv_grpo(v).select(*ids, "adv"), ids)
    assert both.count() == A.adv_grpo(v).count()
    assert both.select(F.max(F.abs(F.col("pp") - F.col("adv")))).first()[0] < 1e-9


def test_standardised_advantage_is_clipped(spark):
    df = rollouts(spark, ([1] + [0] * 39,)).withColumn("run_id", F.lit("r")).withColumn("step", F.lit(0).cast("bigint"))
    assert max(advs(A.adv_reinforce_pp(df)).values()) == 5.0


def test_ema_uses_the_value_before_the_step_and_counts_skipped_steps(spark):
    df = spark.createDataFrame(
        [("r", 0, 1.0), ("r", 0, 1.0), ("r", 1, 0.0), ("r", 1, 1.0), ("r", 5, 0.0)], "run_id string, step bigint, reward double"
    )
    got = [(r.step, r.baseline) for r in A.ema_baseline(df).orderBy("step").collect()]
    assert [g[0] for g in got] == [0, 1, 5]
    assert [g[1] for g in got] == pytest.approx([0.0, 0.1, 0.14])


@pytest.mark.parametrize(("gamma", "lam"), [(0.9, 0.8), (1.0, 0.95), (0.9, 1.0), (1.0, 1.0), (0.9, 0.0)])
@pytest.mark.parametrize("dense", [True, False])
def test_gae_by_hand(spark, gamma, lam, dense):
    rows = [(0, 3, 0.0, 0.5), (0, 4, 0.5, 0.4), (0, 5, 1.0, 0.9), (1, 0, 1.0, -2.0)]
    df = spark.createDataFrame(rows, "t bigint, s bigint, reward double, value double")
    got = {(r.t, r.s): (r.adv, r.returns) for r in A.gae(df, ["t"], "s", gamma=gamma, lam=lam, dense=dense).collect()}
    d = [gamma * 0.4 - 0.5, 0.5 + gamma * 0.9 - 0.4, 1.0 - 0.9]
    a2 = d[2]
    a1 = d[1] + gamma * lam * a2
    a0 = d[0] + gamma * lam * a1
    want = {(0, 3): (a0, a0 + 0.5), (0, 4): (a1, a1 + 0.4), (0, 5): (a2, a2 + 0.9), (1, 0): (3.0, 1.0)}
    assert sorted(got) == sorted(want)
    for at, pair in want.items():
        assert got[at] == pytest.approx(pair)


def test_dynamic_sampling_keeps_mixed_groups(spark):
    df = rollouts(spark, ([1, 1], [0, 1], [0, 0])).withColumn("run_id", F.lit("r")).withColumn("step", F.col("prompt_id"))
    kept, report = A.dynamic_sampling(df)
    assert kept.count() == 2
    assert [r.skipped_so_far for r in report.orderBy("step").collect()] == [1, 1, 2]


def test_best_is_first_and_worst_is_last(spark):
    df = rollouts(spark, ([1, 0, 1, 0], [0, 0])).withColumn("response", F.concat(F.lit("t"), "sample_id"))
    got = {r.prompt_id: (r.chosen, r.rejected, r.tied) for r in S.best_worst_pairs(df, "reward").collect()}
    assert got == {0: ("t0", "t3", False), 1: ("t0", "t1", True)}


def test_chosen_scores_at_least_rejected(spark, root):
    pairs = S.best_worst_pairs(fx.verified_rollouts(spark, root), "reward", A.KEYS)
    assert pairs.where("best_score < worst_score").count() == 0


def test_kept_and_dropped_make_the_sampled(spark, root):
    v = fx.verified_rollouts(spark, root)
    kept = S.rejection_sample(v).count()
    assert kept + v.where("reward < 1").count() == v.count()
    assert S.rejection_report(v).agg(F.sum("kept")).first()[0] == kept


def test_spin_blank_generation_gets_the_placeholder(spark):
    gold = spark.createDataFrame([(1, "q", "gold"), (2, "p", "gold")], "id bigint, prompt string, response string")
    own = spark.createDataFrame([(1, "  "), (2, "mine")], "id bigint, generation string")
    assert {r.id: r.rejected for r in S.spin_pairs(gold, own, ["id"]).collect()} == {1: "（空）", 2: "mine"}


def test_validation_reasons(spark):
    rows = [
        (1, "p", "a", "b"), (2, "p", "a", "b"), (3, "p", None, "b"), (4, "p", " ", "b"), (5, "p", "a", "a"),
        (6, "p", "b", "a"), (7, "p", "a", "b"),
    ]
    pairs = spark.createDataFrame(rows, "pair_id bigint, prompt string, chosen string, rejected string")
    got = {r.pair_id: r.reason for r in D.validate_pairs(pairs).collect()}
    assert got == {1: None, 2: "duplicate", 3: "null", 4: "blank", 5: "identical", 6: None, 7: "duplicate"}
    assert D.valid_pairs(pairs).count() == 2


def test_chat_rendering(spark):
    df = spark.createDataFrame([("sys", "hi"), (None, "hi"), ("", "hi")], "s string, p string")
    msgs = D.messages(F.col("s"), F.col("p"))
    got = [r[0] for r in df.select(D.render_chat(msgs)).collect()]
    plain = "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n"
    assert got == ["<|im_start|>system\nsys<|im_end|>\n" + plain, plain, plain]
    shut = df.select(D.render_chat(msgs, ("[", "]", "\n"), add_generation_prompt=False)).first()[0]
    assert shut == "[system]sys\n[user]hi\n"


def test_system_message_is_carried_forward(spark):
    rows = [(1, 0, "system", "S"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (1, 3, "user", "u2"), (1, 7, "assistant", "a2"),
            (2, 0, "user", "x"), (2, 1, "user", "y")]
    conv = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {(r.conv_id, r.turn): (r.system, r.prompt, r.response) for r in D.sft_examples(conv).collect()}
    assert got == {(1, 1): ("S", "u", "a"), (1, 3): ("S", "u2", "a2")}


def test_schedule_wraps_around(spark):
    df = spark.createDataFrame([(10, "a"), (20, "b"), (5, "c")], "id bigint, prompt string")
    by_step = {r.step: r.prompt for r in D.step_schedule(df, "id", ["prompt"], steps=7).collect()}
    assert by_step == dict(enumerate("cabcabc"))
    by_epoch = {r.step: r.prompt for r in D.step_schedule(df, "id", ["prompt"], epochs=2).collect()}
    assert by_epoch == dict(enumerate("cabcab"))
    with pytest.raises(ValueError, match="either"):
        D.step_schedule(df, "id", ["prompt"])


def test_schedule_shorter_than_the_data(spark):
    df = spark.range(10).withColumn("prompt", F.col("id").cast("string"))
    assert {r.id for r in D.step_schedule(df, "id", ["prompt"], steps=4).collect()} == {0, 1, 2, 3}


def test_unpaired_and_export(spark, tmp_path):
    pairs = spark.createDataFrame([("r1", "p", "good", "bad")], "run_id string, prompt string, chosen string, rejected string")
    path = str(tmp_path / "kto")
    T.write_dataset(D.pairs_to_unpaired(pairs, ["run_id"]), "unpaired", path, by=["run_id"])
    back = spark.read.schema("prompt string, completion string, label boolean, run_id string").json(path)
    assert sorted(tuple(r) for r in back.collect()) == [("p", "bad", False, "r1"), ("p", "good", True, "r1")]
    with pytest.raises(ValueError, match="no export kind"):
        T.export_rows(pairs, "nope")


def test_token_logs_from_json(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame(
        [(1, ["a", "b"], [-1.0, -2.0], [0.5]), (2, [], [], [])], T.TOKEN_LOG_SCHEMA
    ).write.json(path)
    log = T.read_log(spark, path, T.TOKEN_LOG_SCHEMA, "json")
    long = T.arrays_to_long(log, ["sample_id"], {"tokens": "token", "lp": "lp", "entropy": "h"})
    assert sorted(tuple(r) for r in long.collect()) == [(1, 0, "a", -1.0, 0.5), (1, 1, "b", -2.0, None)]


def test_outcomes_are_reduced_and_missing_ones_fail(spark):
    r = spark.createDataFrame([(1, 0), (1, 1), (1, 2)], "prompt_id bigint, sample_id bigint")
    o = spark.createDataFrame([(1, 0, True), (1, 0, False), (1, 1, True)], "prompt_id bigint, sample_id bigint, passed boolean")
    got = lambda need: [x.reward for x in R.outcome_reward(r, o, need=need).orderBy("sample_id").collect()]
    assert got("all") == [0.0, 1.0, 0.0]
    assert got("any") == [1.0, 1.0, 0.0]


def test_trajectory_begins_before_the_first_round(spark):
    df = spark.createDataFrame([("a", 4, 1.0), ("a", 4, 0.0), ("a", 9, 1.0), ("b", 4, 0.0)], "run_id string, round bigint, reward double")
    start = spark.createDataFrame([("a", 0.0), ("a", 0.0), ("a", 0.0), ("a", 1.0)], "run_id string, reward double")
    got = {(r.run_id, r.round): (r.delta, r.trajectory) for r in S.star_rounds(df, start=start).collect()}
    # a run without answers from before begins with its first round
    assert got == {("a", 4): (0.25, "25% -> 50%"), ("a", 9): (0.5, "25% -> 50% -> 100%"), ("b", 4): (None, "0%")}


def test_user_verifier_is_vectorised(spark):
    exact = R.user_verifier(lambda text, gold: text.str.strip() == gold.astype(str))
    df = spark.createDataFrame([(" 7 ", 7), ("8", 7)], "text string, gold bigint")
    assert [r[0] for r in df.select(exact(F.col("text"), F.col("gold"))).collect()] == [1.0, 0.0]


# --- language models ---------------------------------------------------------

DOCS = [(1, "a b a b c"), (2, "b a"), (3, "c")]


def tiny_lm(spark, n=2):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    return L.fit_ngram_lm(docs, models={"all": F.lit(True), "one": F.col("doc_id") == 1}, n=n)


def by_hand(sentence, prompt, docs, n=2, k=0.5):
    grams, ctxs, vocab = {}, {}, set()
    for d in docs:
        toks = ["<s>"] * (n - 1) + d.split()
        for i in range(n - 1, len(toks)):
            c, w = " ".join(toks[i - n + 1 : i]), toks[i]
            grams[c, w] = grams.get((c, w), 0) + 1
            ctxs[c] = ctxs.get(c, 0) + 1
            vocab.add(w)
    v = len(vocab) + 1
    toks = ["<s>"] * (n - 1) + prompt.split() + sentence.split()
    out = []
    for i in range(len(toks) - len(sentence.split()), len(toks)):
        c, w = " ".join(toks[i - n + 1 : i]), toks[i]
        out.append(math.log((grams.get((c, w), 0) + k) / (ctxs.get(c, 0) + k * v)))
    return out


@pytest.mark.parametrize("n", [1, 2, 3])
def test_log_probs_by_hand(spark, n):
    lm = tiny_lm(spark, n)
    samples = spark.createDataFrame([(0, "x A", "b c zzz a"), (1, "", "a b")], "sample_id bigint, prompt string, response string")
    toks = L.token_logp(lm, samples, ["sample_id"]).toPandas().sort_values(["sample_id", "pos"])
    for model, docs in (("all", [d for _, d in DOCS]), ("one", [DOCS[0][1]])):
        want = by_hand("b c zzz a", "x a", docs, n) + by_hand("a b", "", docs, n)
        assert toks[f"lp_{model}"].tolist() == pytest.approx(want)


def test_probabilities_sum_to_one(spark):
    lm = tiny_lm(spark)
    vocab = ["a", "b", "c", "never"]  # the last stands for all unknown words
    for ctx in ("a", "b", "<s>", "unseen"):
        needed = spark.createDataFrame([(ctx, w) for w in vocab], "ctx string, w string")
        got = L.score_ngrams(lm, needed).select(F.sum(F.exp("lp_all")).alias("s")).first().s
        assert got == pytest.approx(1.0)


def test_entropy_by_hand_and_bounds(spark):
    lm = tiny_lm(spark)
    for ctx in ("a", "<s>", "unseen"):
        needed = spark.createDataFrame([(ctx, w) for w in ("a", "b", "c", "never")], "ctx string, w string")
        rows = L.score_ngrams(lm, needed, entropy=True).collect()
        assert rows[0].h_all == pytest.approx(-sum(math.exp(r.lp_all) * r.lp_all for r in rows))
        assert 0 <= rows[0].h_all <= math.log(4) + 1e-12


def test_empty_answer_has_length_one(spark):
    samples = spark.createDataFrame([(0, "p", ""), (1, "p", None)], "sample_id bigint, prompt string, response string")
    for row in L.seq_logp_with_lengths(tiny_lm(spark), samples, ["sample_id"]).collect():
        assert (row.n_tok, row.sum_lp_all, row.mean_lp_all) == (1, 0.0, 0.0)


def test_saved_model_scores_the_same(spark, tmp_path):
    lm = tiny_lm(spark)
    lm.save(str(tmp_path / "lm"))
    again = L.load_ngram_lm(spark, str(tmp_path / "lm"), lm.models)
    samples = spark.createDataFrame([(0, "a", "b c")], "sample_id bigint, prompt string, response string")
    assert L.seq_logp(again, samples, ["sample_id"]).collect() == L.seq_logp(lm, samples, ["sample_id"]).collect()


@pytest.mark.parametrize("bits", [64, 128, 1 << 20])
def test_a_stored_model_moves_needed_ngrams_alone(spark, tmp_path, bits):
    docs = spark.range(300).selectExpr("concat_ws(' ', 'a', 'w' || id, 'b', 'w' || (id + 1)) as text")
    lm = L.fit_ngram_lm(docs, "text").save(str(tmp_path / "lm"))
    needed = spark.createDataFrame([("a", f"w{i}") for i in range(9)] + [("w5", "b"), ("never", "b")], "ctx string, w string")
    small = L.narrowed(lm, needed, bits)
    pairs = lambda df: {tuple(r) for r in df.collect()}
    whole = pairs(lm.ngrams.join(needed, ["ctx", "w"], "left_semi"))
    assert whole <= pairs(small.ngrams) and len(whole) == 10
    kept = {r.ctx: r for r in small.contexts.collect()}
    assert all(kept[r.ctx] == r for r in lm.contexts.where("ctx in ('a', 'w5')").collect())
    if bits == 1 << 20:
        assert small.ngrams.count() < 15 < lm.ngrams.count() and len(kept) < 6
    exact = L.score_ngrams(L.replace(lm, stored=False), needed, entropy=True)
    assert pairs(exact) == pairs(L.score_ngrams(lm, needed, entropy=True))


def test_the_filter_comes_before_the_shuffle(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    lm = tiny_lm(spark).save(str(tmp_path / "lm"))
    needed = spark.createDataFrame([("a", "b")], "ctx string, w string")
    plan = L.score_ngrams(lm, needed)._jdf.queryExecution().executedPlan().toString()
    scans = [plan[: m.start()] for m in re.finditer(r"FileScan parquet \[ctx", plan)]
    assert len(scans) == 2
    for above in scans:
        assert above.rindex("Exchange hashpartitioning(ctx") < above.rindex("LeftSemi, BuildRight")


def test_reverse_kl_against_itself_is_zero(spark):
    samples = spark.createDataFrame([(0, "a", "b c b")], "sample_id bigint, prompt string, response string")
    toks = L.token_logp(tiny_lm(spark), samples, ["sample_id"])
    row = O.opd_reverse_kl(toks, ["sample_id"], "lp_all", "lp_all").first()
    assert (abs(row.mean_reverse_kl), abs(row.loss)) == (0.0, 0.0)


def test_cispo_by_hand(spark):
    new = spark.createDataFrame([(0, 0, -1.0), (0, 1, -2.0), (0, 2, -9.0)], "sample_id bigint, pos bigint, lp_new double")
    old = spark.createDataFrame([(0, 0, -3.0), (0, 1, -1.5)], "sample_id bigint, pos bigint, lp_old double")
    adv = spark.createDataFrame([(0, 2.0)], "sample_id bigint, adv double")
    row = O.cispo_loss(O.align_tokens(new, old), adv).first()
    assert row.n_overlap == 2 and row.n_clipped == 1
    assert row.loss == pytest.approx(-2.0 * (1.3 * -1.0 + math.exp(-0.5) * -2.0) / (5 * 2))


def test_kto_anchor_scopes(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0), ("a", 3.0, 0.0), ("b", 5.0, 0.0)], "b string, lp double, ref double")
    assert {r.z0 for r in P.kto_z0(df).collect()} == {3.0}
    assert {(r.b, r.z0) for r in P.kto_z0(df, "batch", batch=["b"]).collect()} == {("a", 2.0), ("b", 5.0)}
    with pytest.raises(ValueError, match="scope"):
        P.kto_z0(df, "epoch")


@pytest.mark.parametrize("kind", ["bt", "ls"])
def test_scorer_learns_which_word_wins(spark, kind):
    rows = [(i, "good answer", "bad answer") for i in range(20)] + [(99, "bad", "good")]
    pairs = spark.createDataFrame(rows, "prompt_id bigint, chosen string, rejected string")
    model = P.fit_preference_scorer(pairs, kind)
    scored = {r.prompt_id: r.margin for r in P.score_pairs(model, pairs).collect()}
    assert scored[0] > 0 > scored[99]
    changed = pairs.selectExpr("prompt_id", "rejected as chosen", "chosen as rejected").union(
        spark.createDataFrame([(100, None, "")], pairs.schema)
    )
    turned = {r.prompt_id: r.margin for r in P.score_pairs(model, changed).collect()}
    assert turned[0] == pytest.approx(-scored[0]) and turned[100] == 0


def test_perplexity_counts_no_token_for_an_empty_answer(spark):
    docs = spark.createDataFrame([(1, "a b a b"), (2, ""), (3, "a b"), (4, None)], "id bigint, response string")
    lm = L.fit_ngram_lm(docs, "response")
    scored = L.seq_logp_with_lengths(lm, docs, ["id"], prompt=None).withColumn("full", F.col("tokens") > 0)
    both = {r.full: r for r in L.perplexity_by(scored, ["full"], f"sum_lp_{lm.models[0]}").collect()}
    assert both[False].tokens == 0 and both[False].perplexity is None
    every = L.perplexity_by(scored.withColumn("g", F.lit(1)), ["g"], f"sum_lp_{lm.models[0]}").first()
    assert every.perplexity == pytest.approx(both[True].perplexity) and every.tokens == 6


@pytest.mark.parametrize("alpha", [0.0, 0.5, 1.0])
def test_running_baseline_over_null_runs_and_sparse_steps(spark, alpha):
    rows = [(run, (i * 7 % 50 - 25) * 2**40, float(i % 3)) for run in (None, "a") for i in range(50)]
    df = spark.createDataFrame(rows, "run_id string, step bigint, reward double")
    got = {(r.run_id, r.step): (r.baseline, r.baseline_next) for r in A.ema_baseline(df, alpha=alpha).collect()}
    assert len(got) == 100
    for run in (None, "a"):
        b = 0.0
        for _, step, x in sorted(r for r in rows if r[0] == run):
            before, b = b, alpha * b + (1 - alpha) * x
            assert got[run, step] == pytest.approx((before, b), abs=1e-12)


# --- monitors -------------------------------------------------------------------


def test_log_rows_are_spaced_and_end_with_the_last(spark):
    df = spark.range(40).select(F.lit("r").alias("run_id"), F.col("id").alias("step"))
    assert sorted(r.step for r in M.log_rows(df, 6).collect()) == [0, 6, 12, 18, 24, 30, 36, 39]
    short = df.where("step < 3")
    assert sorted(r.step for r in M.log_rows(short, 6).collect()) == [0, 1, 2]


def test_any_correct_grows_with_k(spark, root):
    for row in M.any_correct_at_k(fx.verified_rollouts(spark, root)).collect():
        assert row.at_1 <= row.at_2 <= row.at_4


def test_step_report_over_several_groups(spark):
    df = rollouts(spark, ([1, 0, 0, 1], [1, 1])).withColumn("run_id", F.lit("r")).withColumn("step", F.lit(0))
    row = M.step_report(df).first()
    rewards = pd.Series([1, 0, 0, 1, 1, 1], dtype=float)
    assert (row.samples, row.kept, row.skipped) == (6, 1, 1)
    assert row.mu == pytest.approx(rewards.mean()) and row.sigma == pytest.approx(rewards.std(ddof=0))


@pytest.mark.parametrize("hot", [False, True])
def test_step_report_of_grouped_rows_is_the_same(spark, hot):
    from rollmill.sources.layout import Grouped, grouped

    df = spark.range(900).selectExpr(
        "'r' as run_id", "id % 2 as step", "pmod(xxhash64(id), 7) as prompt_id", "case when id % 11 > 0 then 1e8 + id % 3 end as reward",
        "id % 5 as k",
    )
    df = df.union(spark.createDataFrame([("r", 0, 8, None, 1), (None, 5, 1, 0.5, 1), ("r", 1, 9, 2.0, 1)], df.schema))
    groups = grouped(df, ["run_id", "step", "prompt_id"], hot=[])
    if hot:
        some = [r.h for r in df.select(F.xxhash64("prompt_id").alias("h")).distinct().collect()][:4]
        groups = grouped(df, ["run_id", "step", "prompt_id"], ["prompt_id"], some)
    assert isinstance(groups, Grouped) and groups.hot == hot
    order = lambda rows: sorted((r.asDict() for r in rows), key=lambda r: r["step"])
    got, want = order(M.step_report(groups).collect()), order(M.step_report(df).collect())
    assert len(got) == len(want) == 3
    for a, b in zip(got, want):
        assert a == {k: pytest.approx(v, rel=1e-9) if isinstance(v, float) else v for k, v in b.items()}


def test_reward_pages_hold_every_reward_in_order(spark):
    df = spark.range(25).selectExpr("'r' as run_id", "0 as step", "id % 2 as prompt_id", "id div 2 as sample_id", "double(id) as reward")
    got = {(r.prompt_id, r.page): r.rewards for r in M.reward_pages(df, size=5).collect()}
    assert len(got) == 6 and max(map(len, got.values())) == 5
    assert sum((got[0, p] for p in range(3)), []) == [float(i) for i in range(0, 25, 2)]


def test_entropy_drift(spark):
    track = spark.createDataFrame([("c", 0, 2.0), ("c", 5, 1.0), ("t", 0, 2.0), ("t", 5, 1.9)], "arm string, step bigint, entropy double")
    got = {r.arm: (r["first"], r["last"]) for r in M.entropy_drift(track).collect()}
    assert got == {"c": (2.0, 1.0), "t": (2.0, 1.9)}
    last = M.arm_compare(track, "c", "t").where("step = 5").first()
    assert last.difference == pytest.approx(0.9)


@pytest.mark.parametrize("gamma", [0.0, 0.99, 1.0])
@pytest.mark.parametrize("lam", [0.0, 1e-15, 1e-9, 0.5, 1.0])
def test_gae_equals_the_loop_for_any_coefficient(spark, gamma, lam):
    from rollmill.operators.advantages import gae

    rows = [("a", t, (t * 37 % 11) / 7, (t * 53 % 13) / 5) for t in range(12)]
    want, error, ahead = {}, 0.0, 0.0
    for _, t, r, v in reversed(rows):
        error, ahead = r + gamma * ahead - v + gamma * lam * error, v
        want[t] = error
    df = spark.createDataFrame(rows, "k string, t bigint, reward double, value double")
    got = {r.t: r.adv for r in gae(df, ["k"], "t", gamma=gamma, lam=lam).collect()}
    assert all(abs(got[t] - want[t]) < 1e-9 for t in want)


def test_null_is_a_group_like_any_other(spark):
    from rollmill.operators.advantages import adv_grpo

    rows = [(run, 1, 1, i, float(i)) for run in (None, "x") for i in range(2)]
    df = spark.createDataFrame(rows, "run_id string, step bigint, prompt_id bigint, sample_id bigint, reward double")
    assert adv_grpo(df).count() == 4


def test_logs_are_zipped_to_the_shorter(spark):
    a = spark.createDataFrame([(1, [-1.0, -2.0, -3.0]), (2, [-1.0]), (3, None), (4, []), (5, [-1.0])], "sample_id bigint, x array<double>")
    b = spark.createDataFrame([(1, [-4.0, -5.0]), (2, [-6.0, -7.0]), (3, [-1.0]), (4, [-1.0])], "sample_id bigint, y array<double>")
    out = O.zip_logs(a, b, "x", "y")
    assert sorted(map(tuple, out.collect())) == [(1, 0, -1.0, -4.0), (1, 1, -2.0, -5.0), (2, 0, -1.0, -6.0)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_star_refit_over_many_rounds(spark):
    """500 rounds are rows, not columns; each scores the next, NULL rounds and gaps in the numbers included."""
    import math

    rows = [(10 * i + j, i, "p", f"w{i % 7} w{j}", 1.0 if j else 0.0) for i in range(500) for j in range(2)]
    rows += [(-1, None, "p", "w0", 1.0), (9000, 700, "p", "w0", 1.0), (-2, -3, "p", "w1", 0.0), (-3, -2, "p", "w1 w1", 1.0), (9100, 1, "p", "", 1.0)]
    df = spark.createDataFrame(rows, "sample_id bigint, round int, prompt string, response string, reward double")
    out = S.star_refit(df, ["sample_id"])
    got = {r.sample_id: r for r in out.collect()}
    assert len(out.columns) == 4 and len(got) == 499 * 2 + 2
    assert not {-1, -2, 9000} & set(got)
    assert (got[-3].n_tok, got[-3].sum_lp) == (2, 0.0)  # its round before kept nothing
    assert (got[9100].n_tok, got[9100].sum_lp) == (1, 0.0)  # empty answer
    # round 9 scored by round 8, which kept "w1 w1": contexts p and w1, vocabulary of one word and the unknown one
    seen, fresh = math.log((0 + 0.5) / (1 + 0.5 * 2)), math.log((0 + 0.5) / (0 + 0.5 * 2))
    assert got[91].sum_lp == pytest.approx(seen + fresh)
    assert got[80].sum_lp == pytest.approx(math.log(0.5 / (1 + 0.5 * 3)) + math.log(0.5 / (0 + 0.5 * 3)))


@pytest.mark.parametrize("kind", ["bt", "ls"])
def test_margin_scorer_is_at_the_optimum(spark, kind):
    """The gradient, taken by differences of the loss written out in numpy, is zero at the fitted weights; NULL features take no part."""
    import numpy as np

    rows = [(float((i * 37) % 11) - 3, float((i * 53) % 7) - 4) for i in range(300)] + [(None, 1.0), (500.0, None)]
    df = spark.createDataFrame(rows, "a double, b double")
    scorer = P.fit_margin_scorer(df, {"a": F.col("a"), "b": F.col("b")}, kind)
    x, w = np.array(rows[:300]), np.array([scorer.weights["a"], scorer.weights["b"]])

    def loss(w):
        z = x @ w
        return (np.log1p(np.exp(-z)) if kind == "bt" else (z - 5) ** 2 / 2).mean() + 5e-4 * w @ w

    for k in range(2):
        step = np.eye(2)[k] * 1e-5
        assert abs(loss(w + step) - loss(w - step)) / 2e-5 < 1e-7
    assert scorer.gradient_norm <= 1e-9 and (kind == "bt" or scorer.steps == 1)
    empty = P.fit_margin_scorer(df.limit(0), {"a": F.col("a")}, kind)
    assert empty.weights == {"a": 0.0}


def test_margin_scorer_refuses_what_did_not_converge(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "a double")
    with pytest.raises(ArithmeticError):
        P.fit_margin_scorer(df, {"a": F.col("a")}, "bt", most_steps=1)
    with pytest.raises(ValueError):
        P.fit_margin_scorer(df, {"a": F.col("a")}, "other")


def test_rollup_weighs_slices_by_their_pairs(spark):
    rows = [("a", 1, -1.0), ("a", 1, -3.0), ("a", 2, -5.0), ("b", 1, None), (None, 1, -7.0)]
    df = spark.createDataFrame(rows, "run_id string, slice int, lp_c double").selectExpr(
        "*", "-1d as lp_r", "0d as lpref_c", "0d as lpref_r", "1 as n_c", "1 as n_r"
    )
    out = {(r.level, r.run_id, r.slice): r for r in P.preference_rollup(df, ["run_id", "slice"]).collect()}
    assert len(out) == 4 + 3 + 1
    assert (out[1, "a", None].n_pairs, out[1, "a", None].margin) == (3, -2.0)
    assert out[1, "b", None].margin is None and out[0, None, 1].margin == out[1, None, None].margin == -6.0
    assert (out[3, None, None].n_pairs, out[3, None, None].margin) == (5, -3.0)


def test_broken_log_lines_are_set_apart(spark, tmp_path):
    lines = [
        '{"sample_id": 1, "lp": [1.0, 2.0], "entropy": [3.0, 4.0], "more": 1}',
        '{"sample_id": 2, "lp": [1.0], "entropy": [3.0, 4.0]}',
        '{"sample_id": 3, "lp": [1.0]}',
        '{"sample_id": 4, "lp": [1.0',
        '{"sample_id": "x", "lp": [1.0], "entropy": [2.0]}',
        "",
        '{"sample_id": 5}',
        '{"sample_id": 6, "lp": [], "entropy": []}',
    ]
    (tmp_path / "log.json").write_text("\n".join(lines))
    schema = "sample_id bigint, lp array<double>, entropy array<double>"
    good, bad = T.quarantine_log(spark, str(tmp_path / "log.json"), str(tmp_path / "out"), schema, ["lp", "entropy"])
    assert good.columns == ["sample_id", "lp", "entropy"] and {r.sample_id for r in good.collect()} == {1, 5, 6}
    found = {(r.defect, r.sample_id, r.raw) for r in bad.collect()}
    assert found == {("ragged", 2, None), ("ragged", 3, None), ("malformed", None, lines[3]), ("malformed", None, lines[4])}
