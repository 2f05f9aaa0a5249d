"""Joins of facts with dated snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_left_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], salts: int, spread: Sequence[str]
) -> DataFrame:
    """Left join with every key spread over `salts` tasks.

    Left rows take a salt from the `spread` columns, right rows are repeated once per salt; the
    result equals the plain join. Use it where adaptive skew splitting is unavailable.
    """
    if salts <= 1:
        return left.join(right, list(on), "left")
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*on, "_salt"], "left").drop("_salt")


def temporal_snapshot_join(
    facts: DataFrame, dim: DataFrame, key: str, fact_date: str, dim_date: str,
    salts: int = 1, spread: Sequence[str] = (),
) -> DataFrame:
    """Each fact with the dimension row valid on its day; facts without one stay and are flagged.

    The dimension is unique per (key, day), so the join never multiplies facts. The join strategy
    is left to Spark: it broadcasts by measured size and splits skewed partitions at run time.
    """
    dated = dim.withColumnRenamed(dim_date, fact_date).withColumn("_matched", F.lit(True))
    joined = salted_left_join(facts, dated, [key, fact_date], salts, spread or facts.columns)
    return joined.withColumn("is_unmatched", F.col("_matched").isNull()).drop("_matched")
