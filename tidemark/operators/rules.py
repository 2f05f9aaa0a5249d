"""Validity rules: rows are flagged with the first failing rule, never dropped."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K

VALID = "_is_valid"
REASON = "_reject_reason"
CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Rule:
    """`fails` is true for a row the rule rejects; an unknown does not reject."""

    reason: str
    fails: Column


def domain_rules(domain: str) -> list[Rule]:
    readable = Rule(K.REASON_UNREADABLE, F.col(CORRUPT).isNotNull())
    has_id = Rule(K.REASON_NO_ID, F.col("id").isNull())
    specific = {
        "products": [
            Rule(K.REASON_NO_TITLE, F.col("title").isNull()),
            Rule(K.REASON_NO_PRICE, F.col("price").isNull()),
            Rule(K.REASON_NEGATIVE_PRICE, F.col("price") < 0),
        ],
        "users": [
            Rule(K.REASON_NO_EMAIL, F.col("email").isNull()),
            Rule(K.REASON_BAD_EMAIL, ~F.col("email").contains("@")),
        ],
        "carts": [
            Rule(K.REASON_NO_USER, F.col("userId").isNull()),
            Rule(K.REASON_EMPTY_CART, F.size(F.coalesce("products", F.array())) == 0),
        ],
    }
    return [readable, has_id, *specific[domain]]


def first_failure(rules: Sequence[Rule]) -> Column:
    return F.coalesce(*[F.when(r.fails, F.lit(r.reason)) for r in rules])


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.withColumn(REASON, first_failure(rules)).withColumn(VALID, F.col(REASON).isNull())


def route(df: DataFrame, accepted: Column) -> tuple[DataFrame, DataFrame]:
    """Two complementary filters; an unknown predicate counts as refused."""
    ok = F.coalesce(accepted, F.lit(False))
    return df.where(ok), df.where(~ok)


def reject_breakdown(df: DataFrame) -> DataFrame:
    return df.where(~F.col(VALID)).groupBy(REASON).agg(F.count("*").alias("n_rows"))
