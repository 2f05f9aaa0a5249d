"""Throughput of the landing flow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def throughput(
    df: DataFrame, ts: str, width: str, by: Sequence[str], size: str | None = None
) -> DataFrame:
    """Events per fixed window, with `size` also their bytes; works on batch and streaming frames."""
    sums = [F.count("*").alias("n_events")]
    if size:
        sums.append(F.coalesce(F.sum(F.col(size).cast("bigint")), F.lit(0)).alias("n_bytes"))
    counted = df.groupBy(F.window(F.col(ts), width).alias("_w"), *by).agg(*sums)
    return counted.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *by,
        "n_events", *(["n_bytes"] if size else [])
    )


def stream_throughput(
    df: DataFrame, ts: str, width: str, by: Sequence[str], path: str, checkpoint: str,
    size: str | None = None,
) -> DataFrame:
    """Drains a stream into window counts per micro-batch and returns their sums.

    Each batch writes its own counts once, under its number, so a repeated batch replaces itself.
    Nothing is held between batches, and no event is too late to be counted.
    """
    def count(batch: DataFrame, number: int) -> None:
        throughput(batch, ts, width, by, size).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").parquet(f"{path}/batch={number}")

    query = df.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()
    query.awaitTermination()
    schema = throughput(df, ts, width, by, size).schema
    parts = df.sparkSession.read.schema(schema).option("basePath", path).parquet(path)
    sums = [F.sum(c).alias(c) for c in ("n_events", "n_bytes") if c in schema.names]
    return parts.groupBy("window_start", "window_end", *by).agg(*sums)


def sliding_throughput(
    df: DataFrame, ts: str, width: str, slide: str, by: Sequence[str]
) -> DataFrame:
    """Events per overlapping window of a batch.

    Events are counted once per slide first; only those counts enter the overlapping windows.
    `width` must be a multiple of `slide`.
    """
    pane = throughput(df, ts, slide, by).select(
        F.col("window_start").alias("_pane"), *by, "n_events"
    )
    summed = pane.groupBy(F.window("_pane", width, slide).alias("_w"), *by).agg(
        F.sum("n_events").alias("n_events")
    )
    return summed.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *by, "n_events"
    )


def silence_alerts(df: DataFrame, ts: str, by: Sequence[str], gap: str, late: str = "0 seconds") -> DataFrame:
    """One row for each silence longer than `gap`, as soon as the stream's time has come that far.

    Other sources' events move the time on, so the row comes while the source is still silent. State is a session a
    source and is dropped with its alert; events more than `late` behind the newest are not counted. On a batch frame
    all of them are found, those that reach beyond the newest event included.
    """
    source = df.withWatermark(ts, late) if df.isStreaming else df
    # The last event is taken as an aggregate: a filter on a session's own end would be pushed below its making.
    closed = source.where(F.col(ts).isNotNull()).groupBy(F.session_window(F.col(ts), gap).alias("_s"), *by).agg(
        F.max(ts).alias("silence_start"), F.count("*").alias("n_events"))
    alert = F.col("silence_start") + F.expr(f"INTERVAL {gap}")
    return closed.select(*by, "silence_start", alert.alias("alert_at"), "n_events")
