"""Landing flow: requests are split by domain, responses routed, deduplicated and written.

The functions before `land` take batch and streaming frames; `read_stream` starts a stream.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import constants as K
from ..operators.rules import route

# When the flow received a row.
ARRIVED = "_arrived"

# Tasks that share one folder's rows of a micro-batch, and so its files of that batch at most.
FOLDER_TASKS = 8

# Request envelope.
REQUEST_FIELDS = "snapshot_date STRING, domains ARRAY<STRING>, run_id STRING"


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "json",
    max_files: int | None = None, max_bytes: str | None = None,
) -> DataFrame:
    """File stream with bounded micro-batches: `max_files` / `max_bytes` are the back-pressure."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    elif max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def parse_requests(df: DataFrame, body: str) -> DataFrame:
    """Request fields out of a JSON body."""
    return df.withColumn("_request", F.from_json(body, REQUEST_FIELDS)).select(
        *df.columns, "_request.*"
    )


def split_domains(requests: DataFrame, domains: str = "domains") -> DataFrame:
    """One row per requested domain, the name reduced to its first run of letters."""
    rest = [c for c in requests.columns if c != domains]
    return requests.select(*rest, F.explode(domains).alias("_name")).select(
        *rest, F.regexp_extract("_name", "([A-Za-z]+)", 1).alias("domain")
    )


def is_conforming(status: Column, size: Column, mime: Column) -> Column:
    """Success, a body worth keeping and a JSON type."""
    return (status == K.OK_STATUS) & (size > K.MIN_BODY_BYTES) & mime.contains("json")


def retry_route(df: DataFrame, failed: Column, attempts: str) -> DataFrame:
    """Counts an attempt for failed rows and names their next stop."""
    count = F.coalesce(attempts, F.lit(0)) + F.coalesce(failed, F.lit(False)).cast("int")
    stop = (
        F.when(~F.coalesce(failed, F.lit(False)), "done")
        .when(count > K.MAX_RETRIES, "dead_letter")
        .otherwise("retry")
    )
    return df.withColumns({attempts: count, "next_stop": stop})


def dedup_stream(
    df: DataFrame, keys: Sequence[str], ts: str, ttl: str = K.DEDUP_TTL,
    spread: Sequence[str] = (), salts: int = 8,
) -> DataFrame:
    """First arrival of each key within the time to live; `ts` is when a row arrived.

    Keys age by arrival, so a row whose event is old but whose key is new is never refused. On a
    batch frame all rows count as arrived together.

    With `spread` columns a busy key is first reduced on `salts` tasks, so the second step
    receives at most `salts` rows of it per batch and no single state partition sees them all.
    """
    if not df.isStreaming:
        return df.dropDuplicates(list(keys))
    marked = df.withWatermark(ts, ttl)
    if not spread:
        return marked.dropDuplicatesWithinWatermark(list(keys))
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    return (
        marked.withColumn("_salt", salt)
        .dropDuplicatesWithinWatermark([*keys, "_salt"])
        .drop("_salt")
        .dropDuplicatesWithinWatermark(list(keys))
    )


def arriving(df: DataFrame, name: str = ARRIVED) -> DataFrame:
    """The rows with the instant at which the flow received them: that of their micro-batch."""
    return df.withColumn(name, F.current_timestamp())


def late_report(df: DataFrame, ts: str, by: Sequence[str], arrived: str = ARRIVED,
                ttl: str = K.DEDUP_TTL) -> DataFrame:
    """Rows whose event lies more than the time to live before their arrival, counted."""
    late = F.col(ts) < F.col(arrived) - F.expr(f"INTERVAL {ttl}")
    return df.where(late).groupBy(*by).agg(F.count("*").alias("n_late"), F.min(ts).alias("oldest"))


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How often each repeated key arrived, and how many arrivals were surplus."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("n_arrivals"))
    return counted.where("n_arrivals > 1").withColumn("n_duplicates", F.col("n_arrivals") - 1)


def object_key(domain: Column, day: Column, millis: Column, token: Column) -> Column:
    """`<domain>/ingest_date=<day>/<domain>_<day>_<epoch ms>_<token>.json`."""
    date = day.cast("string")
    name = F.concat(F.concat_ws("_", domain, date, millis.cast("string"), token), F.lit(".json"))
    return F.concat_ws("/", domain, F.concat(F.lit("ingest_date="), date), name)


def dead_letter_key(domain: Column, day: Column, token: Column) -> Column:
    place = F.coalesce(F.nullif(domain, F.lit("")), F.lit(K.DEAD_LETTER_NO_DOMAIN))
    date = F.coalesce(F.nullif(day.cast("string"), F.lit("")), F.lit(K.DEAD_LETTER_NO_DATE))
    return F.concat_ws("/", F.lit("_dead_letter"), place, date, F.concat(token, F.lit(".json")))


def parked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The refused rows that wait for another try, as a stream of the files that `land` has written there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    return read_stream(spark, path, schema)


def land(
    df: DataFrame, accepted: Column, keys: Sequence[str], ts: str, ok_path: str, dead_path: str,
    checkpoint: str, spread: Sequence[str] = (), ttl: str = K.DEDUP_TTL, body: str = "body",
    retry_path: str | None = None, attempts: str = "attempts",
    recall: Callable[[DataFrame], DataFrame] | None = None, settled: DataFrame | None = None,
) -> Iterator[StreamingQuery]:
    """Lands everything available now; yields its queries, each to be awaited before the next is asked for.

    Accepted rows are landed once per key and time to live, counted from their arrival, below
    `ok_path` as `domain=<d>/ingest_date=<day>`, each with its `object_key` from the call instant
    `ts`; with `<raw>/landed` as `ok_path` the Bronze job finds them. Without a `retry_path`, refused
    rows are dead letters at once.

    With it, a refused row is parked there, and every later run reads the parked rows as a second
    source beside `df`: a run is a try. `recall` makes the call again (rows to rows of the same
    columns, the same for equal rows); without it a row is judged as it is. A row that is accepted
    then is landed like any other; one whose key is in `settled` (a frame of keys landed by earlier
    runs) is done with; any other has its attempts counted, and is parked again or, with
    `MAX_RETRIES` passed, a dead letter. All file sinks commit exactly once and read each parked row
    once; the checkpoint carries the deduplication state.
    """
    if retry_path:
        waiting = parked(df.sparkSession, retry_path, df.schema)
        if settled is not None:
            waiting = waiting.join(settled, list(keys), "left_anti").select(*df.columns)
        df = df.unionByName(recall(waiting) if recall else waiting)
    conforming, refused = route(df, accepted)
    token = F.md5(F.concat_ws("|", "domain", "snapshot_date", F.col(ts).cast("string"), body))
    key = object_key(F.col("domain"), F.col("snapshot_date"), F.unix_millis(ts), token)
    landed = dedup_stream(arriving(conforming), keys, ARRIVED, ttl, spread).withColumn("object_key", key)
    yield _write(landed.withColumnRenamed("snapshot_date", "ingest_date"),
                 ok_path, ["domain", "ingest_date"], f"{checkpoint}/ok")
    if not retry_path:
        yield _write(refused, dead_path, ["domain", "snapshot_date"], f"{checkpoint}/dead")
        return
    counted = retry_route(refused, F.lit(True), attempts)
    given_up = counted.where(F.col("next_stop") == "dead_letter").drop("next_stop")
    yield _write(given_up, dead_path, ["domain", "snapshot_date"], f"{checkpoint}/dead")
    # The last to start: what it parks is read by the next run.
    again = counted.where(F.col("next_stop") == "retry").drop("next_stop")
    yield _write(again, retry_path, ["domain", "snapshot_date"], f"{checkpoint}/retry")


def by_folder(df: DataFrame, partition_by: Sequence[str], tasks: int = FOLDER_TASKS) -> DataFrame:
    """The rows dealt out so that a folder's lie in at most `tasks` tasks, evenly: the state's partitions follow the
    keys, and each of them would write a file into every folder."""
    rest = [c for c in df.columns if c not in partition_by]
    return df.repartition(*partition_by, F.pmod(F.xxhash64(*rest), F.lit(tasks)))


def _write(df: DataFrame, path: str, partition_by: Sequence[str], checkpoint: str) -> StreamingQuery:
    return (
        by_folder(df, partition_by).writeStream.format("json").option("path", path)
        .option("checkpointLocation", checkpoint).partitionBy(*partition_by)
        .trigger(availableNow=True).start()
    )


def run_to_table(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Drains the stream into a Parquet table and returns that table."""
    writer = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.outputMode("append").format("parquet").option("path", path).start().awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)
