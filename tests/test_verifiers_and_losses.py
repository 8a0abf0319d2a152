import math

import pytest
from pyspark.sql import functions as F

from rollmill.functions import losses as C
from rollmill.functions import verifiers as V
from rollmill.functions.numerics import clip, neg_log_sigmoid, rounded, sigmoid, words


def value(spark, column, **inputs):
    row = spark.range(1).select(*[F.lit(v).alias(n) for n, v in inputs.items()])
    return row.select(column).first()[0]


@pytest.mark.parametrize(
    ("text", "gold", "reward"),
    [
        ("7", 7, 1.0),
        ("3+4=7", 7, 0.0),  # the first number counts
        ("答案是-5。", -5, 1.0),
        ("no number", 7, 0.0),
        ("", 7, 0.0),
        ("9" * 60, 9, 0.0),  # beyond 38 digits
        ("007", 7, 1.0),
        ("７", 7, 0.0),  # full-width digit
        (None, 7, 0.0),
    ],
)
def test_first_int_reward(spark, text, gold, reward):
    df = spark.createDataFrame([(text, gold)], "text string, gold bigint")
    assert df.select(V.first_int_reward(F.col("text"), F.col("gold"))).first()[0] == reward


def test_length_reward_may_be_negative(spark):
    df = spark.createDataFrame([("7 " + "x " * 15, 7)], "text string, gold bigint")
    assert df.select(V.length_reward(F.col("text"), F.col("gold"))).first()[0] == pytest.approx(1 - 0.5 * 12 / 4)


@pytest.mark.parametrize(
    ("text", "score"),
    [("短。", 0.0), ("一二三四五六七八九。", 1.0), ("x" * 79 + "！", 1.0), ("x" * 80 + "！", 0.0), ("x" * 20, 0.0)],
)
def test_rule_judge_counts_characters(spark, text, score):
    assert value(spark, V.rule_judge(F.col("t")), t=text) == score


def test_signature_prefix(spark):
    assert value(spark, V.signature_hit(F.col("t"), "abcdefgh"), t="xxabcdefyy") == 0
    assert value(spark, V.signature_hit(F.col("t"), "abcdefgh", 6), t="xxabcdefyy") == 1


def test_composite_reward_is_a_weighted_sum(spark):
    assert value(spark, V.composite_reward({"a": 1.0, "b": -0.5}), a=1.0, b=3.0) == -0.5


def test_violations_are_ascending(spark):
    got = value(spark, V.violated_principles(F.col("t"), [(3, "c"), (1, "a"), (2, "zzz")]), t="abc")
    assert got == [1, 3]


@pytest.mark.parametrize("x", [-800.0, -3.0, 0.0, 3.0, 800.0])
def test_log_sigmoid_is_stable(spark, x):
    got = value(spark, neg_log_sigmoid(F.col("x")), x=x)
    want = math.log1p(math.exp(-x)) if x > -700 else -x
    assert got == pytest.approx(want, rel=1e-12)
    s = value(spark, sigmoid(F.col("x")), x=x)
    assert 0.0 <= s <= 1.0 and s + value(spark, sigmoid(-F.col("x")), x=x) == pytest.approx(1.0)


def test_rounding_has_no_negative_zero(spark):
    assert str(value(spark, rounded(F.col("x")), x=-1e-8)) == "0.0"
    assert value(spark, rounded(F.col("x")), x=0.0000005) == 0.000001


def test_words(spark):
    assert value(spark, words(F.col("t")), t="  Ab\tc \n d  ") == ["ab", "c", "d"]


def test_clip_one_sided(spark):
    assert value(spark, clip(F.col("x"), hi=1.3), x=5.0) == 1.3
    assert value(spark, clip(F.col("x"), lo=0.8), x=5.0) == 5.0


LPS = dict(lp_c=-3.0, lp_r=-5.0, ref_c=-3.5, ref_r=-4.0)


def cols(*names):
    return [F.col(n) for n in names]


def test_losses_at_the_reference_policy(spark):
    same = [F.col("lp_c"), F.col("lp_r"), F.col("lp_c"), F.col("lp_r")]
    assert value(spark, C.dpo_loss(*same), **LPS) == pytest.approx(math.log(2))
    assert value(spark, C.ipo_loss(*same), **LPS) == pytest.approx(1 / (4 * 0.1**2))
    for label in (0, 1):
        kto = C.kto_loss(F.col("lp_c"), F.col("lp_c"), F.lit(label), F.lit(0.0))
        assert value(spark, kto, **LPS) == pytest.approx(0.5)


def test_preference_losses_by_hand(spark):
    margin = 0.5 + 1.0
    args = cols(*LPS)
    assert value(spark, C.dpo_loss(*args), **LPS) == pytest.approx(-math.log(1 / (1 + math.exp(-0.1 * margin))))
    assert value(spark, C.ipo_loss(*args), **LPS) == pytest.approx((margin - 5) ** 2)
    m_c, m_r = -0.5, -1.5
    odds = [m - math.log1p(-math.exp(m)) for m in (m_c, m_r)]
    want = 0.5 * math.log1p(math.exp(-(odds[0] - odds[1])))
    assert value(spark, C.orpo_odds_loss(*cols("a", "b")), a=m_c, b=m_r) == pytest.approx(want)
    want = math.log1p(math.exp(-(2.5 * 1.0 - 1.4)))
    assert value(spark, C.simpo_loss(*cols("a", "b")), a=m_c, b=m_r) == pytest.approx(want)
    full = C.orpo_loss(F.col("s"), F.col("n"), *cols("a", "b"))
    assert value(spark, full, s=-2.0, n=4, a=m_c, b=m_r) == pytest.approx(0.5 + 0.5 * math.log1p(math.exp(-(odds[0] - odds[1]))))


def test_orpo_survives_certainty(spark):
    assert math.isfinite(value(spark, C.orpo_odds_loss(*cols("a", "b")), a=0.0, b=-1.0))


def test_dispatcher(spark):
    by_name = C.pref_loss("dpo", **{n: F.col(n) for n in LPS})
    assert value(spark, by_name, **LPS) == value(spark, C.dpo_loss(*cols(*LPS)), **LPS)
    with pytest.raises(ValueError, match="no preference loss"):
        C.pref_loss("ppo")


@pytest.mark.parametrize("adv", [-1.5, 0.0, 2.0])
def test_unmoved_policy_gives_plain_surrogate(spark, adv):
    lp = F.lit(-2.0)
    a = F.lit(adv)
    assert value(spark, C.dapo_loss(a, lp, lp)) == pytest.approx(-adv / 5)
    assert value(spark, C.gspo_loss(a, lp, lp, F.lit(7))) == pytest.approx(-adv / 5)
    assert value(spark, C.ppo_clip_loss(a, lp, lp, lp)) == pytest.approx(-adv)


def test_dapo_clips_one_side_only(spark):
    up, down = F.lit(1.0), F.lit(-1.0)
    old = F.lit(-2.0)
    assert value(spark, C.dapo_loss(F.lit(1.0), old + up, old)) == pytest.approx(-1.28 / 5)
    assert value(spark, C.dapo_loss(F.lit(1.0), old + down, old)) == pytest.approx(-math.exp(-1) / 5)
    assert value(spark, C.dapo_loss(F.lit(-1.0), old + down, old)) == pytest.approx(0.8 / 5)
    assert value(spark, C.dapo_loss(F.lit(-1.0), old + up, old)) == pytest.approx(math.e / 5)


def test_grpo_penalty_is_squared(spark):
    got = value(spark, C.grpo_loss(F.lit(1.0), F.lit(-2.0), F.lit(-2.5)))
    assert got == pytest.approx((2.0 + 0.02 * 0.25) / 5)


def test_cispo_weight_has_no_floor_unless_asked(spark):
    lp = (F.lit(-3.0), F.lit(-1.0))
    assert value(spark, C.cispo_weight(*lp)) == pytest.approx(math.exp(-2))
    assert value(spark, C.cispo_weight(*lp, eps_low=0.2)) == pytest.approx(0.8)
    assert value(spark, C.cispo_weight(F.lit(0.0), F.lit(-1.0))) == pytest.approx(1.3)
