"""Ratios that behave the same for empty groups and for missing sides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double ratio; NULL when the denominator is zero (ANSI division would raise)."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def rounded_ratio(numerator: Column, denominator: Column, places: int = 6) -> Column:
    return F.round(ratio(numerator, denominator), places)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, six decimals, zero for an empty whole.

    Multiplying before dividing keeps an exact decimal tie exact, so it rounds half up.
    """
    return F.round(ratio_or_zero(part * F.lit(100), whole), 6)


def f1_score(precision: Column, recall: Column) -> Column:
    return ratio_or_zero(F.lit(2.0) * precision * recall, precision + recall)
