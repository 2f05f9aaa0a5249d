"""Ratios, means and money. Decimals stay decimal, so sums do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Daily money totals of a very large lake exceed DECIMAL(14,2); the wider type holds them.
MONEY_TOTAL = "decimal(20,2)"


def money(value: Column, precision: int = 10) -> Column:
    return value.try_cast(f"decimal({precision},2)")


def ratio(numerator: Column, denominator: Column, precision: int, scale: int) -> Column:
    """Half-up rounded quotient, NULL for a zero denominator or an overflow."""
    quotient = numerator / F.nullif(denominator, F.lit(0))
    return F.round(quotient, scale).try_cast(f"decimal({precision},{scale})")


def mean(value: Column, precision: int, scale: int) -> Column:
    """Aggregate mean of the non-NULL values."""
    return ratio(F.sum(value), F.count(value), precision, scale)


def weighted_mean(value: Column, weight: Column, precision: int, scale: int) -> Column:
    return ratio(F.sum(value * weight), F.sum(weight), precision, scale)


def pct(part: Column, whole: Column, precision: int, scale: int) -> Column:
    return ratio(part * F.lit(100), whole, precision, scale)


def change_pct(now: Column, before: Column, precision: int = 10, scale: int = 2) -> Column:
    return pct(now - before, before, precision, scale)
