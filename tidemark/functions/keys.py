"""Stable keys, fingerprints and hash-derived uniforms."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import HISTORY_SEED


def surrogate_key(kind: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(kind), *[p.cast("string") for p in parts]), 256)


def record_hash(df: DataFrame, exclude: Iterable[str] = ()) -> Column:
    """Fingerprint of the JSON form of a row; name secrets and bookkeeping columns in `exclude`."""
    hidden = set(exclude)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in hidden]
    return F.sha2(F.to_json(F.struct(*kept)), 256)


def padded(value: Column, width: int) -> Column:
    """Zero-padded text, never truncated."""
    text = value.cast("string")
    return F.when(F.length(text) > width, text).otherwise(F.lpad(text, width, "0"))


def business_key(prefix: str, day: Column, *parts: Column | tuple[Column, int]) -> Column:
    """`prefix-yyyyMMdd-part-…`; a (column, width) part is zero-padded, never truncated."""
    pieces = [F.lit(prefix), F.date_format(day, "yyyyMMdd")]
    for part in parts:
        if isinstance(part, tuple):
            pieces.append(padded(*part))
        else:
            pieces.append(part.cast("string"))
    return F.concat_ws("-", *pieces)


def hash_uniform(
    key: Column, day: Column, salt: str, seed: int = HISTORY_SEED, method: str = "murmur3"
) -> Column:
    """Repeatable uniform in [0, 1).

    `murmur3` gives the 100,000-step values published tables were made with; `md5` has 2**32
    steps and can be recomputed by any SQL engine.
    """
    text = F.concat_ws("|", key.cast("string"), day.cast("string"), F.lit(salt), F.lit(str(seed)))
    if method == "murmur3":
        return F.pmod(F.hash(text), F.lit(100000)) / F.lit(100000.0)
    if method == "md5":
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
    raise ValueError(f"unknown hash method {method!r}")


def hash_pick(
    key: Column, day: Column, salt: str, buckets: int | Column, seed: int = HISTORY_SEED,
    method: str = "murmur3",
) -> Column:
    """Repeatable, evenly spread choice of one of 1..buckets, for any number of buckets.

    `murmur3` refines each of the 100,000 published steps by the 64-bit hash of the same text, so
    choices among a divisor of 100,000 are the published ones and no bucket is out of reach;
    `md5` uses 52 bits and can be recomputed by any SQL engine.
    """
    text = F.concat_ws("|", key.cast("string"), day.cast("string"), F.lit(salt), F.lit(str(seed)))
    if method == "md5":
        uniform = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))
    else:
        step = hash_uniform(key, day, salt, seed, method) * F.lit(100000.0)
        part = F.shiftrightunsigned(F.xxhash64(text), 29) / F.lit(float(2**35))
        uniform = (F.round(step) + part) / F.lit(100000.0)
    return F.least(hash_bucket(uniform, buckets), buckets if isinstance(buckets, Column) else F.lit(buckets))


def hash_bucket(uniform: Column, buckets: int | Column) -> Column:
    """Evenly spread bucket number 1..buckets."""
    n = buckets if isinstance(buckets, Column) else F.lit(buckets)
    return (F.floor(uniform * n) + 1).cast("bigint")
