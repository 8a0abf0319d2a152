"""Preference losses and policy-gradient objectives over logged log-probs.

Every function maps columns to one column, so a whole family of losses over
the same rows stays in a single projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollmill.functions.numerics import clip, neg_log_sigmoid, sigmoid

# Fixed value: ceiling that keeps 1 - p away from zero in log-odds.
ODDS_CEILING = 1 - 1e-6


def log_ratio(lp: Column, lp_ref: Column) -> Column:
    """How far the policy moved from its reference, in nats."""
    return lp - lp_ref


def pair_margin(lp_c: Column, lp_r: Column, ref_c: Column, ref_r: Column) -> Column:
    return log_ratio(lp_c, ref_c) - log_ratio(lp_r, ref_r)


def dpo_loss(lp_c, lp_r, ref_c, ref_r, beta: float = 0.1) -> Column:
    """P1"""
    return neg_log_sigmoid(F.lit(float(beta)) * pair_margin(lp_c, lp_r, ref_c, ref_r))


def ipo_target(beta: float = 0.1) -> float:
    return 1.0 / (2.0 * beta)


def ipo_loss(lp_c, lp_r, ref_c, ref_r, beta: float = 0.1) -> Column:
    """P3"""
    gap = pair_margin(lp_c, lp_r, ref_c, ref_r) - F.lit(ipo_target(beta))
    return gap * gap


def kto_loss(lp, ref, label, z0, beta: float = 0.1) -> Column:
    """P5: desirable rows want the log-ratio above z0, the others below it."""
    pull = F.lit(float(beta)) * (log_ratio(lp, ref) - z0)
    return F.lit(1.0) - sigmoid(F.when(label == 1, pull).otherwise(-pull))


def log_odds(mean_lp: Column) -> Column:
    return mean_lp - F.log1p(-F.least(F.exp(mean_lp), F.lit(ODDS_CEILING)))


def orpo_odds_loss(mean_c, mean_r, lambda_: float = 0.5) -> Column:
    return F.lit(float(lambda_)) * neg_log_sigmoid(log_odds(mean_c) - log_odds(mean_r))


def orpo_sft_loss(sum_c, n_c) -> Column:
    return -sum_c / F.greatest(n_c, F.lit(1))


def orpo_loss(sum_c, n_c, mean_c, mean_r, lambda_: float = 0.5) -> Column:
    """Imitation term plus odds-ratio term."""
    return orpo_sft_loss(sum_c, n_c) + orpo_odds_loss(mean_c, mean_r, lambda_)


def simpo_target(beta: float = 2.5, gamma: float = 1.4) -> float:
    return gamma / beta


def simpo_loss(mean_c, mean_r, beta: float = 2.5, gamma: float = 1.4) -> Column:
    """Reference-free, length-normalised, with a fixed margin."""
    return neg_log_sigmoid(F.lit(float(beta)) * (mean_c - mean_r) - F.lit(float(gamma)))


def pref_loss(variant: str, beta: float = 0.1, gamma: float = 1.4, lambda_: float = 0.5, **cols: Column) -> Column:
    """Preference loss by name; the column arguments are those of the named loss."""
    makers = {
        "dpo": lambda: dpo_loss(cols["lp_c"], cols["lp_r"], cols["ref_c"], cols["ref_r"], beta),
        "ipo": lambda: ipo_loss(cols["lp_c"], cols["lp_r"], cols["ref_c"], cols["ref_r"], beta),
        "simpo": lambda: simpo_loss(cols["mean_c"], cols["mean_r"], beta, gamma),
        "orpo": lambda: orpo_odds_loss(cols["mean_c"], cols["mean_r"], lambda_),
        "kto": lambda: kto_loss(cols["lp"], cols["ref"], cols["label"], cols["z0"], beta),
    }
    if variant not in makers:
        raise ValueError(f"no preference loss named {variant!r}; known: {sorted(makers)}")
    return makers[variant]()


def sft_loss(sum_lp: Column, scale: float = 20.0) -> Column:
    """L6"""
    return -sum_lp / F.lit(float(scale))


def pg_loss(adv: Column, lp: Column, scale: float = 5.0) -> Column:
    """O1"""
    return -adv * lp / F.lit(float(scale))


def grpo_loss(adv, lp, lp_ref, beta_kl: float = 0.02, scale: float = 5.0) -> Column:
    """O2: the reference penalty is the squared log-ratio."""
    d = log_ratio(lp, lp_ref)
    return (-adv * lp + F.lit(float(beta_kl)) * d * d) / F.lit(float(scale))


def token_ratio(lp: Column, lp_old: Column) -> Column:
    return F.exp(lp - lp_old)


def seq_ratio(lp: Column, lp_old: Column, n_tok: Column) -> Column:
    """Length-normalised (geometric mean) importance ratio of a sequence."""
    return F.exp((lp - lp_old) / F.greatest(n_tok, F.lit(1)))


def dapo_loss(adv, lp, lp_old, eps_low: float = 0.2, eps_high: float = 0.28, scale: float = 5.0) -> Column:
    """O3: the upper clip acts on good samples only, the lower on bad ones."""
    rho = token_ratio(lp, lp_old)
    bound = F.when(adv >= 0, clip(rho, hi=1 + eps_high)).otherwise(clip(rho, lo=1 - eps_low))
    return -F.least(rho * adv, bound * adv) / F.lit(float(scale))


def clipped_surrogate(ratio: Column, adv: Column, eps: float) -> Column:
    return F.least(ratio * adv, clip(ratio, 1 - eps, 1 + eps) * adv)


def gspo_loss(adv, lp, lp_old, n_tok, eps: float = 0.10, scale: float = 5.0) -> Column:
    """O4"""
    return -clipped_surrogate(seq_ratio(lp, lp_old, n_tok), adv, eps) / F.lit(float(scale))


def is_clipped(ratio: Column, lo: float | None, hi: float | None, tol: float = 1e-9) -> Column:
    return F.abs(ratio - clip(ratio, lo, hi)) > F.lit(tol)


def cispo_weight(lp, lp_old, eps_high: float = 0.30, eps_low: float | None = None) -> Column:
    """Importance weight, capped above; a floor only on request."""
    return clip(token_ratio(lp, lp_old), lo=None if eps_low is None else 1 - eps_low, hi=1 + eps_high)


def ppo_clip_loss(adv, lp, lp_old, lp_ref, eps: float = 0.2, beta: float = 0.02) -> Column:
    """Clipped surrogate plus a log-ratio penalty to the reference."""
    return -clipped_surrogate(token_ratio(lp, lp_old), adv, eps) + F.lit(float(beta)) * log_ratio(lp, lp_ref)


def value_loss(value: Column, returns: Column) -> Column:
    """O8, critic side."""
    return (value - returns) * (value - returns)
