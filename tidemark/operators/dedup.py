"""Keep one row per key.

`row_number() = 1` is limited per key on the map side before the shuffle, so a key that holds a
large share of the rows sends at most one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key under `order`, which must be a total order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_state(df: DataFrame, key: str, day: str, ties: Sequence[Column] = ()) -> DataFrame:
    """Newest row of each entity."""
    return dedup_latest(df, [key], [F.col(day).desc(), *ties])


def top1_by(
    df: DataFrame, keys: Sequence[str], label: str, measure: Column, name: str = "measure"
) -> DataFrame:
    """Label with the largest total per key; equal totals fall to the smaller label."""
    totals = df.where(F.col(label).isNotNull()).groupBy(*keys, label).agg(F.sum(measure).alias(name))
    return dedup_latest(totals, keys, [F.col(name).desc(), F.col(label).asc()])
