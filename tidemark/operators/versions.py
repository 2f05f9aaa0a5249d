"""Snapshot tables as versions: as-of reads, diffs, history, schema union and retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from .dedup import latest_state


def as_of(df: DataFrame, key: str, day: str, when: str | Column) -> DataFrame:
    """State of every entity at a date: its newest row not later than `when`."""
    limit = F.lit(when).cast("date") if isinstance(when, str) else when
    return latest_state(df.where(F.col(day) <= limit), key, day)


def latest_partition(df: DataFrame, day: str) -> DataFrame:
    """Rows of the newest day; the scalar subquery lets Spark prune partitions."""
    newest = df.agg(F.max(day).alias("newest")).select("newest").scalar()
    return df.where(F.col(day) == newest)


def version_diff(
    before: DataFrame, after: DataFrame, keys: Sequence[str], fingerprint: str
) -> DataFrame:
    """Added, removed and changed keys between two versions; NULL is a fingerprint like any other."""
    old = before.select(*keys, F.struct(fingerprint).alias("_old"))
    new = after.select(*keys, F.struct(fingerprint).alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
    )
    joined = old.join(new, list(keys), "full_outer").withColumn("change", change)
    return joined.where(F.col("change").isNotNull()).select(*keys, "change")


def version_counts(before: DataFrame, after: DataFrame, by: str) -> DataFrame:
    """Row counts of two versions side by side; a value absent from one side shows NULL."""
    old = before.groupBy(by).agg(F.count("*").alias("n_before"))
    new = after.groupBy(by).agg(F.count("*").alias("n_after"))
    return old.join(new, by, "full_outer")


def snapshot_history(df: DataFrame, by: Sequence[str], day: str) -> DataFrame:
    """Rows added per version and the running total.

    The window sees one row per version of `by`, not the records themselves.
    """
    added = df.groupBy(*by, day).agg(F.count("*").alias("added_records"))
    order = Window.partitionBy(*by).orderBy(day)
    return added.withColumn("total_records", F.sum("added_records").over(order))


def merge_schema(*versions: DataFrame) -> DataFrame:
    """Rows of all versions under the union of their columns, missing ones NULL."""
    merged, *rest = versions
    for version in rest:
        merged = merged.unionByName(version, allowMissingColumns=True)
    return merged


def retention(
    df: DataFrame, keys: Sequence[str], day: str, cutoff: str | Column,
    keep_last: int = K.RETAIN_LAST,
) -> DataFrame:
    """Rows not older than the cutoff, and in any case each key's newest `keep_last` versions.

    (key, day) identifies a version. The two parts are disjoint; the ranked one is limited per
    key before its shuffle.
    """
    limit = F.lit(cutoff).cast("date") if isinstance(cutoff, str) else cutoff
    newest = Window.partitionBy(*keys).orderBy(F.col(day).desc())
    ranked = df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= keep_last)
    old_but_kept = ranked.where(F.col(day) < limit).drop("_rank")
    return df.where(F.col(day) >= limit).unionByName(old_but_kept)
