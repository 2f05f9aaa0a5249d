"""Incremental selection, anchors and coverage, as joins of day lists rather than driver sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import ratio


def pending(
    upstream: DataFrame, done: DataFrame | None, day: str, mode: str = "incremental",
    explicit: Sequence[str] = (), limit: int | None = None, stamp: str | None = None,
) -> DataFrame:
    """Days to process, oldest first.

    `incremental` takes days absent from `done`, and with a `stamp` column also days that were
    landed again after they were processed; `full` takes all days; `explicit` the listed ones.
    """
    days = _days(upstream, day, stamp)
    if mode == "explicit":
        days = days.where(F.col(day).isin([F.lit(d).cast("date") for d in explicit]))
    elif mode == "incremental":
        if done is not None:
            processed = _days(done, day, stamp)
            same = days[day] == processed[day]
            if stamp:
                same = same & (processed[stamp] >= days[stamp])
            days = days.join(processed, same, "left_anti")
    elif mode != "full":
        raise ValueError(f"unknown mode {mode!r}")
    ordered = days.select(day).orderBy(day)
    return ordered.limit(limit) if limit else ordered


def _days(df: DataFrame, day: str, stamp: str | None) -> DataFrame:
    present = df.where(F.col(day).isNotNull())
    if stamp:
        return present.groupBy(day).agg(F.max(stamp).alias(stamp))
    return present.select(day).distinct()


def anchor(df: DataFrame, day: str, fallback: str | None = None, name: str = "anchor") -> DataFrame:
    """Newest day of the data as one row, or the fallback for an empty input."""
    return df.agg(F.coalesce(F.max(day), F.lit(fallback).cast("date")).alias(name))


def _expected(df: DataFrame, calendar: DataFrame, by: str, day: str) -> DataFrame:
    """Every value of `by` on every calendar day, opened from one row per value."""
    days = calendar.agg(F.sort_array(F.collect_set(day)).alias("days")).select("days").scalar()
    return df.select(by).distinct().select(by, F.explode(days).alias(day))


def missing_days(df: DataFrame, calendar: DataFrame, by: str, day: str) -> DataFrame:
    """Calendar days on which a value of `by` has no row."""
    landed = df.select(by, day).distinct()
    return _expected(df, calendar, by, day).join(landed, [by, day], "left_anti")


def coverage(
    df: DataFrame, calendar: DataFrame, by: str, day: str, required: Sequence[str] | None = None
) -> DataFrame:
    """Landed days, expected days and their share per value of `by`.

    With `required`, exactly these values are reported; one without any landed day scores 0.
    Without it, every value of the data is reported, those landed outside the calendar with 0.
    """
    days = calendar.select(F.col(day).alias("_day")).distinct()
    expected = days.agg(F.count("*").alias("n")).select("n").scalar()
    landed = df.select(by, day).distinct().join(days, F.col(day) == F.col("_day"), "left")
    counted = landed.groupBy(by).agg(F.count("_day").alias("n_landed"))
    if required is not None:
        wanted = df.sparkSession.createDataFrame([(v,) for v in required], f"{by} string")
        counted = wanted.join(counted, by, "left").select(
            by, F.coalesce("n_landed", F.lit(0)).cast("bigint").alias("n_landed"))
    return counted.select(
        by, "n_landed", expected.alias("n_expected"),
        ratio(F.col("n_landed").cast("decimal(20,0)"), expected, 9, 4).alias("coverage_rate"),
    )


def missing_domains(
    landed: DataFrame, by: str, day: str, required: Sequence[str],
    calendar: DataFrame,
) -> DataFrame:
    """Required domains without any object on a calendar day."""
    wanted = F.array(*[F.lit(d) for d in required])
    expected = calendar.select(day, F.explode(wanted).alias(by))
    found = landed.where(F.col(by).isin(*required)).select(day, by).distinct()
    return expected.join(found, [day, by], "left_anti")
