"""Quality rules as small report frames: name, severity, passed, detail.

All row-level checks of a table share one scan. A report has one row per rule, so gating on it
brings only a handful of rows to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K

HARD, SOFT = "hard", "soft"


class QualityGateError(RuntimeError):
    """At least one blocking rule failed."""


@dataclass(frozen=True)
class Violation:
    """Rows for which `broken` holds are counted; the rule passes at zero."""

    name: str
    severity: str
    broken: Column
    detail: str = "row(s)"


def _line(name: str, severity: str, passed: Column, *detail: Column) -> Column:
    return F.struct(
        F.lit(name).alias("name"),
        F.lit(severity).alias("severity"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        F.concat(*detail).alias("detail"),
    )


def _counted(name: str, severity: str, count: Column, detail: str) -> Column:
    return _line(name, severity, count == 0, count.cast("string"), F.lit(f" {detail}"))


def row_checks(
    df: DataFrame, violations: Sequence[Violation] = (), *, non_empty: str | None = None,
    depth: tuple[str, str, int] | None = None,
) -> DataFrame:
    """Row-level rules, presence and history depth of one table, in one aggregation.

    `depth` is (name, day column, expected days).
    """
    aggs = [F.count_if(F.coalesce(v.broken, F.lit(False))).alias(f"_v{i}")
            for i, v in enumerate(violations)]
    lines = [_counted(v.name, v.severity, F.col(f"_v{i}"), v.detail)
             for i, v in enumerate(violations)]
    if non_empty:
        aggs.append(F.count("*").alias("_n"))
        lines.append(_line(non_empty, HARD, F.col("_n") > 0, F.col("_n").cast("string"), F.lit(" row(s)")))
    if depth:
        name, day, expected = depth
        aggs.append(F.count_distinct(day).alias("_days"))
        lines.append(_line(
            name, SOFT, F.col("_days") >= F.lit(expected) * F.lit(K.DEPTH_TARGET),
            F.col("_days").cast("string"), F.lit(f" distinct day(s), about {expected} expected"),
        ))
    return df.agg(*aggs).select(F.inline(F.array(*lines)))


def total_check(
    df: DataFrame, name: str, severity: str, total: Column, detail: str
) -> DataFrame:
    """A one-row frame's total must be zero."""
    return df.select(F.inline(F.array(_counted(name, severity, total, detail))))


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "n_rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name)).where(F.col(name) > 1)


def grain_check(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    found = duplicate_keys(df, keys).agg(F.count("*").alias("_dup"))
    line = _counted(name, HARD, F.col("_dup"), f"duplicate key(s) on ({', '.join(keys)})")
    return found.select(F.inline(F.array(line)))


def coverage_check(
    rates: DataFrame, name: str, target: float = K.COVERAGE_TARGET, rate: str = "coverage_rate"
) -> DataFrame:
    """The least covered source must reach the target; no source at all fails."""
    lowest = rates.agg(F.min(rate).alias("_rate"))
    line = _line(name, HARD, F.col("_rate") >= F.lit(target),
                 F.lit("lowest coverage "), F.coalesce(F.col("_rate").cast("string"), F.lit("none")))
    return lowest.select(F.inline(F.array(line)))


def orphan_lines(facts: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Facts without a dimension row."""
    return facts.join(dim.select(*on), list(on), "left_anti")


def reconcile(
    name: str, left: DataFrame, left_total: Column, right: DataFrame, right_total: Column,
    absolute: float = 1.0, relative: float = 0.001,
) -> DataFrame:
    """Two independently computed totals must agree within the larger tolerance."""
    other = right.agg(F.coalesce(right_total, F.lit(0)).alias("total")).select("total").scalar()
    sides = left.agg(F.coalesce(left_total, F.lit(0)).alias("left_total")).select(
        "left_total", other.alias("right_total")
    )
    gap = F.abs(F.col("left_total") - F.col("right_total"))
    allowed = F.greatest(F.lit(absolute), F.col("left_total").cast("double") * F.lit(relative))
    text = [F.lit("left="), F.col("left_total").cast("string"), F.lit(" right="),
            F.col("right_total").cast("string"), F.lit(" gap="), gap.cast("string")]
    return sides.select(F.inline(F.array(_line(name, HARD, gap.cast("double") <= allowed, *text))))


def absent(spark: SparkSession, name: str) -> DataFrame:
    """Report line for a table that does not exist."""
    line = _line(name, HARD, F.lit(False), F.lit("table absent"))
    return spark.range(1).select(F.inline(F.array(line)))


def report(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def gate(checks: DataFrame) -> DataFrame:
    """Passes the report through, or raises with the blocking failures."""
    failed = checks.where(~F.col("passed") & (F.col("severity") == HARD)).collect()
    if failed:
        raise QualityGateError("; ".join(f"{r['name']}: {r['detail']}" for r in failed))
    return checks
