"""Numeric and text helpers: Column in, Column out, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def neg_log_sigmoid(x: Column) -> Column:
    """-ln(sigmoid(x)) as softplus(-x); finite for any finite x."""
    return F.greatest(-x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def sigmoid(x: Column) -> Column:
    """Only ever exponentiates a non-positive number, so it cannot overflow."""
    e = F.exp(-F.abs(x))
    return F.when(x >= 0, F.lit(1.0) / (F.lit(1.0) + e)).otherwise(e / (F.lit(1.0) + e))


def clip(x: Column, lo: Column | float | None = None, hi: Column | float | None = None) -> Column:
    if hi is not None:
        x = F.least(x, hi if isinstance(hi, Column) else F.lit(float(hi)))
    if lo is not None:
        x = F.greatest(x, lo if isinstance(lo, Column) else F.lit(float(lo)))
    return x


def words(text: Column) -> Column:
    """Lower-cased whitespace tokens; the token unit of this engine."""
    return F.array_remove(F.split(F.lower(text), r"\s+"), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def rounded(x: Column, digits: int = 6) -> Column:
    """Rounding for reports and engine comparison.

    The nudge moves exact decimal ties off the tie, so engines that round
    ties differently agree; the final + 0.0 turns -0.0 into 0.0.
    """
    return F.round(x + F.lit(1.7e-9), digits) + F.lit(0.0)


def is_blank(c: Column) -> Column:
    """No character but white space: spaces, tabs, line ends."""
    return ~c.rlike("\\S")
