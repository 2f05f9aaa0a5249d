"""Calendar dimension and calendar completion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import HISTORY_DAYS
from ..functions.history import day_index


def _each_day(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(first, last, F.expr("interval 1 day")))


def day_range(spark: SparkSession, first: str, last: str, name: str = "date_key") -> DataFrame:
    """One row per day between two ISO dates, both included."""
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    return spark.range(1).select(_each_day(low, high).alias(name))


def history_window(
    spark: SparkSession, last: str, days: int = HISTORY_DAYS, name: str = "date_key"
) -> DataFrame:
    """One row per day of the history window that ends on an ISO date."""
    high = F.lit(last).cast("date")
    return spark.range(1).select(_each_day(F.date_sub(high, days - 1), high).alias(name))


def days_of(df: DataFrame, day: str, name: str = "date_key") -> DataFrame:
    """One row per day from the first to the last day found in the data."""
    bounds = df.agg(F.min(day).alias("low"), F.max(day).alias("high")).where("low is not null")
    return bounds.select(_each_day(F.col("low"), F.col("high")).alias(name))


def calendar_attributes(
    df: DataFrame, day: str, anchor: Column | None = None, days: int = HISTORY_DAYS
) -> DataFrame:
    d = F.col(day)
    extra = [day_index(d, anchor, days).alias("day_index")] if anchor is not None else []
    return df.select(
        "*",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.weekofyear(d).alias("week_of_year"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.trunc(d, "month").alias("month_start"),
        *extra,
    )


def calendar_of(df: DataFrame, day: str, days: int = HISTORY_DAYS) -> DataFrame:
    """Calendar dimension over the days of the data, indexed from its newest day."""
    newest = df.agg(F.max(day).alias("anchor")).select("anchor").scalar()
    return calendar_attributes(days_of(df, day), "date_key", newest, days)


def calendar_fill(
    df: DataFrame, day: str, category: str, bounds: tuple[Column, Column],
    zeros: Mapping[str, Column], same_per_category: Sequence[str] = (),
) -> DataFrame:
    """Every category on every day between the bounds.

    Rows must be unique per (category, day). Each row opens the missing days up to the
    category's next row, so completion needs neither a cross join nor a second pass over `df`,
    and the shuffle by category is the one later windows use. Added days take the `zeros`
    values, NULL elsewhere; a NULL measure of an existing day is zeroed too.
    `same_per_category` columns take one value per category on all its days.
    """
    low, high = bounds
    per_category = Window.partitionBy(category)
    ordered = per_category.orderBy(day)
    here = F.col(day)
    before, after = F.lag(day).over(ordered), F.lead(day).over(ordered)
    first = F.when(before.isNull(), F.least(low, here)).otherwise(here)
    last = F.when(after.isNull(), F.greatest(high, here)).otherwise(F.date_sub(after, 1))
    spread = df.withColumns({
        "_first": first, "_last": last,
        **{c: F.max(c).over(per_category) for c in same_per_category},
    })
    opened = spread.withColumn("_day", _each_day(F.col("_first"), F.col("_last")))
    real = F.col("_day") == here
    kept = {category, *same_per_category}
    measures = []
    for c in df.columns:
        if c == day:
            measures.append(F.col("_day").alias(day))
        elif c in kept:
            measures.append(F.col(c))
        else:
            value = F.when(real, F.col(c))
            measures.append((F.coalesce(value, zeros[c]) if c in zeros else value).alias(c))
    return opened.select(*measures)
