"""Detail rows and a TOTAL row per day, from one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K


def with_total(
    df: DataFrame, day: str, category: str, aggs: Sequence[Column], *,
    label: Column | None = None, total_label: str | None = None, label_name: str = "category_label",
) -> DataFrame:
    """`aggs` per (day, category) and per day, the latter under the TOTAL category.

    `label` is an aggregate such as the greatest label of the group. A text maximum turns a hash
    aggregation into a sort, so sum large inputs per label first and pass the sums here.
    """
    measures = list(aggs)
    if label is not None:
        measures.append(label.alias("_label"))
    grouped = df.groupingSets([[day, category], [day]], day, category).agg(
        F.grouping(category).alias("_is_total"), *measures
    )
    is_total = F.col("_is_total") == 1
    named = grouped.withColumn(
        category, F.when(is_total, F.lit(K.TOTAL_SLUG)).otherwise(F.col(category))
    )
    if label is not None:
        text = F.when(is_total, F.lit(total_label)).otherwise(F.col("_label"))
        named = named.withColumn(label_name, text).drop("_label")
    return named.drop("_is_total")
