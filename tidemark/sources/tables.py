"""Table writers on partitioned Parquet, and the small-file maintenance around them."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import COMPACTION_MIN_FILES, COMPACTION_TARGET_BYTES, RETAIN_DAYS, RETAIN_LAST
from ..operators.quality import gate
from ..session import scratch_path
from .raw import objects


#: Partitions that one compaction pass rewrites.
COMPACTION_BATCH = 500
#: The folder value of a NULL partition.
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


def _clustered(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str]) -> DataFrame:
    """Rows of a partition together and sorted; adaptive execution splits a partition that is too
    large for one task and joins small ones, so a hot day is written by many tasks."""
    placed = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    order = [*partition_by, *sort_by]
    return placed.sortWithinPartitions(*order) if order else placed


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = ()
) -> None:
    """Creates the table or replaces exactly the partitions present in `df`: replays are idempotent."""
    (
        _clustered(df, partition_by, sort_by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    )


def replace_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()
) -> None:
    """Replaces the whole table, written once beside it and then put in its place by renames.

    `df` may read the table it replaces, and a failed computation leaves the table as it was. A
    run that stops between the two renames leaves the old version as `<path>__old`; readers take it
    from there (`current`), and the next replacement puts it back first.
    """
    spark = df.sparkSession
    recover(spark, path)
    fresh = f"{path}__new-{uuid.uuid4().hex}"
    writer = _clustered(df, partition_by, sort_by).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(fresh)
    _switch(spark, fresh, path)


def _switch(spark: SparkSession, fresh: str, path: str) -> None:
    """Puts a table that is written in full in the place of another one."""
    fs, make = _files(spark, path)
    old = make(f"{path}__old")
    if fs.exists(make(path)) and not fs.rename(make(path), old):
        raise OSError(f"cannot move {path}")
    if not fs.rename(make(fresh), make(path)):
        raise OSError(f"cannot publish {path}")
    fs.delete(old, True)


def current(spark: SparkSession, path: str) -> str:
    """Where the table lies: in its place or, between the renames of a replacement or after a crash there, beside it."""
    fs, make = _files(spark, path)
    old = f"{path}__old"
    return old if not fs.exists(make(path)) and fs.exists(make(old)) else path


def recover(spark: SparkSession, path: str) -> None:
    """Puts back the version that an interrupted replacement has moved aside."""
    fs, make = _files(spark, path)
    old = make(f"{path}__old")
    if fs.exists(old):
        if fs.exists(make(path)):
            fs.delete(old, True)
        else:
            fs.rename(old, make(path))


def _files(spark: SparkSession, path: str):
    """The file system of a path, and how to name a path in it."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    fs, make = _files(spark, path)
    return fs.getContentSummary(make(path)).getLength()


def partition_days(spark: SparkSession, path: str, day: str) -> list[tuple[str, str]]:
    """(day, folder) of every partition, oldest first: one entry per day, from one listing."""
    fs, make = _files(spark, path)
    if not fs.exists(make(path)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(make(path))]
    return sorted((n.split("=", 1)[1], f"{path}/{n}") for n in names if n.startswith(f"{day}="))


def drop_days(spark: SparkSession, path: str, day: str, days: Sequence[str]) -> None:
    """Deletes the partitions of these days, where they exist."""
    fs, make = _files(spark, path)
    for d in days:
        fs.delete(make(f"{path}/{day}={d}"), True)


def expire(
    spark: SparkSession, path: str, day: str, retain_days: int = RETAIN_DAYS, keep_last: int = RETAIN_LAST,
) -> list[str]:
    """Deletes the partitions more than `retain_days` before the newest one, but never the newest
    `keep_last`; returns the deleted days."""
    days = [(d, p) for d, p in partition_days(spark, path, day) if d != HIVE_NULL]
    if not days:
        return []
    limit = (dt.date.fromisoformat(days[-1][0]) - dt.timedelta(days=retain_days)).isoformat()
    gone = [(d, p) for d, p in days[:-keep_last or None] if d < limit]
    fs, make = _files(spark, path)
    for _, folder in gone:
        fs.delete(make(folder), True)
    return [d for d, _ in gone]


def _staged(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_audit_publish(
    df: DataFrame, path: str, partition_by: Sequence[str],
    checks: Callable[[DataFrame], DataFrame], sort_by: Sequence[str] = (),
) -> DataFrame:
    """Stage, check the staged rows, publish only if no blocking check failed; returns the report."""
    staged = _staged(df, "audit")
    checked = gate(checks(staged))
    overwrite_partitions(staged, path, partition_by, sort_by)
    return checked


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(current(spark, path))
    except AnalysisException as err:
        if err.getCondition() in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}:
            return False
        raise
    return True


def table_stats(df: DataFrame, day: str) -> DataFrame:
    """Row count and newest version of a table."""
    return df.agg(F.count("*").alias("n_rows"), F.max(day).alias("newest"))


def table_inventory(spark: SparkSession, layers: Sequence[str] = ("bronze", "silver", "gold")) -> DataFrame:
    """Catalogue tables of the layers, in layer order."""
    found = [
        (layer, t.name, t.tableType)
        for layer in layers if spark.catalog.databaseExists(layer)
        for t in spark.catalog.listTables(layer) if not t.isTemporary
    ]
    rows = spark.createDataFrame(found, "layer string, table_name string, table_type string")
    rank = F.array_position(F.array(*[F.lit(layer) for layer in layers]), F.col("layer"))
    return rows.orderBy(rank, "table_name")


def compaction_plan(
    spark: SparkSession, path: str, target_bytes: int = COMPACTION_TARGET_BYTES,
    min_files: int = COMPACTION_MIN_FILES,
) -> DataFrame:
    """Partitions worth rewriting: enough files below the target size, and fewer afterwards."""
    files = objects(spark, path).where(F.col("path").endswith(".parquet")).select(
        F.regexp_extract("path", r"((?:/[^/=]+=[^/]+)*)/[^/]+$", 1).alias("partition"), "length"
    )
    small = files.where(F.col("length") < target_bytes).groupBy("partition").agg(
        F.count("*").alias("n_files"), F.sum("length").alias("n_bytes")
    )
    planned = small.withColumn(
        "n_files_after", F.ceil(F.col("n_bytes") / F.lit(target_bytes)).cast("bigint")
    )
    return planned.where(
        (F.col("n_files") >= min_files) & (F.col("n_files_after") < F.col("n_files"))
    )


def compact(
    spark: SparkSession, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = (),
    target_bytes: int = COMPACTION_TARGET_BYTES, min_files: int = COMPACTION_MIN_FILES,
) -> int:
    """Rewrites the planned partitions and returns their number; a table without partitions is replaced as a whole."""
    recover(spark, path)
    plan = compaction_plan(spark, path, target_bytes, min_files).select(
        F.regexp_replace("partition", "^/", "").alias("_partition"), F.col("n_files_after").alias("_files")
    )
    # One short row per partition folder of the table.
    wanted = {r["_partition"]: r["_files"] for r in plan.collect()}
    table = spark.read.parquet(path) if wanted else None
    todo = list(wanted)
    for at in range(0, len(todo), COMPACTION_BATCH):
        part = todo[at:at + COMPACTION_BATCH]
        folders = [f"{path}/{p}" if p else path for p in part]
        rows = spark.read.schema(table.schema).option("basePath", path).parquet(*folders)
        # Rows are dealt out evenly to the planned number of files of their partition.
        folder = F.regexp_extract("_metadata.file_path", r"((?:/[^/=]+=[^/]+)*)/[^/]+$", 1)
        counts = F.create_map(*[F.lit(v) for p in part for v in (f"/{p}" if p else "", wanted[p])])
        dealt = rows.select("*", F.pmod(F.monotonically_increasing_id(), counts[folder]).alias("_file"))
        staged = _staged(dealt, "compact")
        spread = staged.repartition(sum(wanted[p] for p in part), *partition_by, "_file")
        ordered = spread.sortWithinPartitions(*partition_by, "_file", *sort_by).drop("_file")
        if partition_by:
            (ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*partition_by).parquet(path))
        else:
            # Never in place: a run that stops here must not lose the table.
            fresh = f"{path}__new-{uuid.uuid4().hex}"
            ordered.write.parquet(fresh)
            _switch(spark, fresh, path)
    return len(wanted)
