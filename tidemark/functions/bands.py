"""Banding, range validation and completeness flags."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucketize(value: Column, bounds: Sequence, labels: Sequence[str]) -> Column:
    """Label of the first bound above `value`; the last label takes the rest and NULL."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("bucketize needs one label more than bounds")
    chain = F.when(value < bounds[0], F.lit(labels[0]))
    for bound, label in zip(bounds[1:], labels[1:]):
        chain = chain.when(value < bound, F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def valid_range(value: Column, low: float, high: float) -> Column:
    """The value read as double, NULL when unreadable or out of bounds."""
    number = value.try_cast("double")
    return F.when(number.between(low, high), number)


def complete(*conditions: Column) -> Column:
    """True only when every condition holds; an unknown counts as incomplete."""
    return F.coalesce(reduce(lambda a, b: a & b, conditions), F.lit(False))
