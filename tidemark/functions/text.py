"""Text normalisation and privacy minimising."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(text: Column) -> Column:
    return F.lower(F.trim(text))


def title_label(text: Column) -> Column:
    return F.initcap(F.regexp_replace(F.trim(text), "'", " "))


def digits(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[^0-9]", "")


def email_domain(email: Column) -> Column:
    """Text after the first @; NULL when there is none."""
    return F.get(F.split(email, "@"), F.lit(1))


def mask_email(email: Column) -> Column:
    return F.concat(F.substring(email, 1, 1), F.lit("***@"), email_domain(email))


def join_words(*parts: Column) -> Column:
    """Parts separated by one blank, missing ones skipped."""
    return F.concat_ws(" ", *[p.cast("string") for p in parts])
