"""Session building, and written tables in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(
    app: str, master: str | None = None, shuffle_partitions: int | None = None, **conf
) -> SparkSession:
    """Session with the settings the jobs expect.

    `shuffle_partitions` is where adaptive execution starts joining small partitions: choose it
    for the largest shuffle, about its bytes divided by 200 MB.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config("spark.ui.enabled", "false")
        # Recording a Python call site per column doubles the time to build a large plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if shuffle_partitions:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", shuffle_partitions
        )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named by the session; a temporary one only for local runs."""
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; no two calls return the same one."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tidemark/{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Removes this application's scratch tables; jobs call it when they end."""
    root = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write once and read back: cuts lineage, survives executor loss, carries size statistics."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
