"""A ledger of the raw zone: per domain and day the objects that lie there, and when the newest was called.

A run reads what is new: landed files through a file stream, which remembers those it has seen, and object
folders only where the folder has changed since it was listed last.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import raw as R
from .tables import HIVE_NULL, _files

#: A folder that changed less than this before its listing may change again within its time stamp.
SETTLE_MS = 10_000

_LANDED = "domain STRING, ingest_date DATE, n_objects BIGINT, n_bytes BIGINT, newest TIMESTAMP"
_OBJECTS = _LANDED + ", folder_ms BIGINT"


def _counted(objects: DataFrame, size: str) -> list:
    return [F.count("*").alias("n_objects"), F.coalesce(F.sum(size), F.lit(0)).alias("n_bytes"),
            F.max("_ingest_ts").alias("newest")]


def follow_landed(spark: SparkSession, raw: str, ledger: str) -> None:
    """Enters the landing flow's files that have come since the last run: one small file per micro-batch.

    A batch that is run again replaces its own file, so every landed file counts once.
    """
    root = f"{raw}/landed"
    if not R.present(spark, root):
        return

    def enter(batch: DataFrame, number: int) -> None:
        traced = R.provenance(batch.withColumn("length", F.octet_length("body")), F.col("object_key"))
        (traced.groupBy("domain", "ingest_date").agg(*_counted(traced, "length"))
         .coalesce(1).write.mode("overwrite").parquet(f"{ledger}/landed/batch={number}"))

    schema = f"{R.LANDED_FIELDS}, domain STRING, ingest_date DATE"
    (spark.readStream.schema(schema).json(root).writeStream.foreachBatch(enter)
     .option("checkpointLocation", f"{ledger}/_checkpoint").trigger(availableNow=True).start().awaitTermination())


def day_folders(spark: SparkSession, root: str, day: str = "ingest_date") -> dict[str, int]:
    """Change time of every day folder below a root: one entry a day, from one listing of the root alone."""
    fs, make = _files(spark, root)
    if not fs.exists(make(root)):
        return {}
    found = ((s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(make(root)))
    return {name.split("=", 1)[1]: ms for name, ms in found if name.startswith(f"{day}=")}


def follow_objects(spark: SparkSession, raw: str, domain: str, ledger: str) -> list[str]:
    """Lists the day folders that are new or have changed, replaces their entries, and returns those days.

    Stores without folder times (0) have all their folders listed. An object whose name has no day, or another one than
    its folder's, stops the run before anything is entered.
    """
    root, table = f"{raw}/{domain}", f"{ledger}/objects"
    now = int(time.time() * 1000)
    folders = day_folders(spark, root)
    known = {}
    if R.present(spark, table):
        # One row a day.
        known = {str(r["ingest_date"]): r["folder_ms"] for r in spark.read.schema(_OBJECTS).parquet(table)
                 .where(F.col("domain") == domain).select("ingest_date", "folder_ms").collect()}
    days = sorted(d for d, ms in folders.items() if d != HIVE_NULL and (ms <= 0 or known.get(d) != ms))
    fs, make = _files(spark, table)
    for day in set(known) - set(folders):
        fs.delete(make(f"{table}/domain={domain}/ingest_date={day}"), True)
    if not days:
        return []
    traced = R.provenance(R.objects(spark, [f"{root}/ingest_date={d}" for d in days]), F.col("path"))
    wrong = [r["path"] for r in R.misnamed(traced).select("path").limit(5).collect()]
    if wrong:
        raise ValueError(f"objects whose name does not fit their day folder: {wrong}")
    times = {d: folders[d] if now - folders[d] > SETTLE_MS else -1 for d in days}
    changed = F.create_map(*[F.lit(x) for d in days for x in (d, times[d])])
    entries = traced.groupBy(F.col("_ingest_date").alias("ingest_date")).agg(*_counted(traced, "length")).select(
        F.lit(domain).alias("domain"), "*", changed[F.col("ingest_date").cast("string")].cast("long").alias("folder_ms"))
    (entries.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("domain", "ingest_date").parquet(table))
    return days


def entries(spark: SparkSession, ledger: str) -> DataFrame:
    """domain, ingest_date, n_objects, n_bytes, newest, origin (object or landed), one row each."""
    parts = [spark.createDataFrame([], _LANDED + ", origin STRING")]
    for origin, schema in (("object", _OBJECTS), ("landed", _LANDED)):
        place = f"{ledger}/{origin}s" if origin == "object" else f"{ledger}/{origin}"
        if R.present(spark, place):
            rows = spark.read.schema(schema).parquet(place)
            parts.append(rows.groupBy("domain", "ingest_date").agg(
                F.sum("n_objects").alias("n_objects"), F.sum("n_bytes").alias("n_bytes"),
                F.max("newest").alias("newest")).withColumn("origin", F.lit(origin)))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found
