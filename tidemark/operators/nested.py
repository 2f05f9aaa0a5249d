"""Nested data: struct flattening, line explosion, replication with thinning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()):
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Struct leaves of any depth as top-level columns named by their joined path."""
    return df.select(*[
        F.col(".".join(f"`{part}`" for part in path)).alias(sep.join(path))
        for path in _leaves(df.schema)
    ])


def explode_lines(df: DataFrame, lines: str) -> DataFrame:
    """One row per element of an array of structs, its fields as columns; empty arrays give none."""
    rest = [c for c in df.columns if c != lines]
    return df.select(*rest, F.inline(lines))


def replicate_and_thin(
    df: DataFrame, copies: int, uniform: Column, rate: Column, name: str = "replica"
) -> DataFrame:
    """`copies` numbered copies of each row, kept where the hash uniform is below the rate."""
    copied = df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return copied.where(uniform < rate)
