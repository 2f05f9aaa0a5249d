"""Landing layer: every record of every object, flagged, fingerprinted and traceable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.rules import CORRUPT, REASON, VALID, apply_rules, domain_rules
from ..sources.raw import SECRETS, domain_schema, provenance


def hash_secrets(df: DataFrame, domain: str) -> DataFrame:
    """Secrets leave as `<name>_sha256`; the clear text is dropped."""
    for name in SECRETS.get(domain, ()):
        df = df.withColumn(
            f"{name}_sha256", F.sha2(F.coalesce(F.col(name), F.lit("")), 256)
        ).drop(name)
    return df


def fingerprint(domain: str) -> Column:
    """Hash of the JSON form of the business fields, secrets left out."""
    fields = [f.name for f in domain_schema(domain).fields if f.name not in SECRETS.get(domain, ())]
    return F.sha2(F.to_json(F.struct(*fields)), 256)


def bronze(
    raw: DataFrame, domain: str, batch_id: str, path: Column | None = None
) -> DataFrame:
    """Record x object with the eight technical columns."""
    traced = provenance(raw, path).withColumns({
        "_bronze_ts": F.current_timestamp(),
        "_batch_id": F.lit(batch_id),
        "_record_hash": fingerprint(domain),
    })
    return hash_secrets(apply_rules(traced, domain_rules(domain)), domain)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Counts total, rejected and undated rows during the write, without extra passes."""
    seen = Observation(name)
    return df.observe(
        seen,
        F.count(F.lit(1)).alias("total"),
        F.count_if(~F.col(VALID)).alias("invalid"),
        F.count_if(F.col("_ingest_date").isNull()).alias("undated"),
        *[F.count_if(F.col(REASON) == r.reason).alias(r.reason) for r in domain_rules(name)],
    ), seen


def dated_or_fail(df: DataFrame) -> DataFrame:
    """Fails the write on a row whose day cannot be read from its object name."""
    message = F.concat(F.lit("no partition day in object name: "), F.col("_source_file"))
    day = F.when(F.col("_ingest_date").isNull(), F.raise_error(message)).otherwise(
        F.col("_ingest_date")
    )
    return df.withColumn("_ingest_date", day.cast("date"))


__all__ = ["CORRUPT", "bronze", "dated_or_fail", "fingerprint", "hash_secrets", "observed"]
