"""Shared places and small helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share; a temporary one only where none is set, in a local session."""
    context = spark.sparkContext
    place = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if place is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that every executor can reach")
        place = tempfile.mkdtemp(prefix="tidemark-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(place)
    return place.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The same rows, held as a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """The same rows as a Parquet table in the shared folder; its size is then known to the planner."""
    spark, place = df.sparkSession, scratch(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(place)
    return spark.read.schema(df.schema).parquet(place)


def drop_written(df: DataFrame | None) -> None:
    """Removes the files of a written table that nothing reads any more."""
    if df is None:
        return
    spark = df.sparkSession
    for name in {root + "/llm/" + rest.split("/")[0] for root, rest in (f.rsplit("/llm/", 1) for f in df.inputFiles())}:
        folder = spark._jvm.org.apache.hadoop.fs.Path(name)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def hash_bits(*parts: Column) -> Column:
    """52 bits of the MD5 of the parts joined by `|`, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("long")


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, from batches sorted by the keys; a group may span batches."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            codes = table[k].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
            change[1:] |= codes[1:] != codes[:-1]
        first = tuple(table[k][0].as_py() for k in keys)
        starts = np.flatnonzero(change)
        if held and first != last:
            yield pa.concat_tables(held)
            held = []
        at = 0
        for s in starts:
            held.append(table.slice(at, s - at))
            yield pa.concat_tables(held)
            held, at = [], int(s)
        held.append(table.slice(at))
        last = tuple(table[k][table.num_rows - 1].as_py() for k in keys)
    if held:
        yield pa.concat_tables(held)
