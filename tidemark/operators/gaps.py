"""Silences and activity sessions of a source.

Events are first reduced to one row per (source, slot) with slots as wide as the gap. Two events
in one slot are always closer than the gap, so nothing is lost, and the windows that follow hold
at most one row per slot of the observed time span however busy a source is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _slots(df: DataFrame, ts: str, by: Sequence[str], gap: str, aggs: Sequence[Column]) -> DataFrame:
    slot = F.window(F.col(ts), gap)
    return (
        df.where(F.col(ts).isNotNull())
        .groupBy(*by, slot.alias("_slot"))
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), *aggs)
    )


def silences(df: DataFrame, ts: str, by: Sequence[str], gap: str) -> DataFrame:
    """Stretches longer than `gap` between two consecutive events of a source."""
    order = Window.partitionBy(*by).orderBy("_first")
    resumed = F.lead("_first").over(order)
    slots = _slots(df, ts, by, gap, []).withColumn("silence_end", resumed)
    return slots.where(
        F.col("silence_end") > F.col("_last") + F.expr(f"interval {gap}")
    ).select(*by, F.col("_last").alias("silence_start"), "silence_end")


def sessions(df: DataFrame, ts: str, by: Sequence[str], gap: str, value: str) -> DataFrame:
    """Runs of events less than `gap` apart, with their size, span and total value."""
    order = Window.partitionBy(*by).orderBy("_first")
    slots = _slots(
        df, ts, by, gap, [F.count("*").alias("_n"), F.sum(value).alias("_total")]
    )
    opens = F.coalesce(
        F.col("_first") >= F.lag("_last").over(order) + F.expr(f"interval {gap}"), F.lit(True)
    )
    numbered = slots.withColumn("_open", opens.cast("int")).withColumn(
        "session_no", F.sum("_open").over(order)
    )
    return numbered.groupBy(*by, "session_no").agg(
        F.min("_first").alias("session_start"),
        F.max("_last").alias("session_last"),
        F.sum("_n").alias("n_events"),
        F.sum("_total").alias("total_value"),
    )
