"""Aggregate measures.

Products are summed as decimals, so a sum does not depend on the order in which
partitions arrive; only the final quotient is a double. Reported ratios are decimals
again, so that halves round the same way wherever the last bit of the double falls.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Digits that the report tables hold.
RATIO_DIGITS = 10


def quotient(numerator: Column, denominator: Column) -> Column:
    """Unrounded ratio; null where the denominator is zero or missing."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def rounded(value: Column) -> Column:
    """Double as a decimal with the reported digits, halves rounded away from zero."""
    return F.round(value.cast("decimal(38,12)"), RATIO_DIGITS)


def ratio(numerator: Column, denominator: Column) -> Column:
    return rounded(quotient(numerator, denominator))


def sum_if(condition: Column | None, value: Column) -> Column:
    """Sum over the rows that meet the condition; null if there are none."""
    return F.sum(value if condition is None else F.when(condition, value))


def extremes(value: Column, before: str, behind: str) -> list[Column]:
    """Greatest and least value, as <before>max<behind> and <before>min<behind>."""
    return [F.max(value).alias(f"{before}max{behind}"), F.min(value).alias(f"{before}min{behind}")]


def weighted_average(value: Column, weight: Column, condition: Column | None = None) -> Column:
    """sum(value * weight) / sum(weight), over the rows that meet the condition."""
    return ratio(sum_if(condition, value * weight), sum_if(condition, weight))
