"""Retries over several runs, the ledger of the raw zone, back-pressure, audits and inventories."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import quality as Q
from ..session import materialise, scratch_path
from ..sources import ledger as LG
from ..sources import raw as R
from ..sources import tables as T
from ..streaming import landing as L
from ..streaming import monitor as M
from .core import query, table
from .fixtures import with_fx, with_response
from .operations import OK, _event_files
from .raw_zone import FIRST_DAY, RECORDS_PER_OBJECT, _write_zone, part_records


def _as_responses(events):
    return with_response(events).select(
        "event_id", "ts", "domain", F.col("snapshot_date").cast("string").alias("snapshot_date"), "status", "mime",
        "n_bytes", F.to_json(F.struct("event_id", "value")).alias("body"), F.lit(None).cast("int").alias("attempts"))


def _accepted():
    return L.is_conforming(F.col("status"), F.col("n_bytes"), F.col("mime"))


@query(with_fx("fx_landing", f"""
, judged AS (SELECT event_id, coalesce({OK}, FALSE) AS good FROM fx_landing)
SELECT event_id, CASE WHEN good OR event_id % 4 < {K.MAX_RETRIES} THEN 'landed' ELSE 'dead_letter' END AS outcome,
       CAST(CASE WHEN good THEN 0 ELSE least(event_id % 4, {K.MAX_RETRIES}) + 1 END AS INT) AS attempts
FROM judged"""))
def retry_loop(spark, sf):
    """Refused events are tried again by each run; a quarter of them recovers at every further try, the rest never."""
    base, responses = scratch_path(spark, "retry"), _as_responses(_event_files(spark, sf))

    def recall(rows):
        back = F.col("event_id") % 4 < F.col("attempts")
        return rows.withColumns({
            "status": F.when(back, F.lit(K.OK_STATUS)).otherwise(F.col("status")),
            "mime": F.when(back, F.lit("application/json")).otherwise(F.col("mime")),
            "n_bytes": F.when(back, F.lit(K.MIN_BODY_BYTES + 1)).otherwise(F.col("n_bytes"))})

    for _ in range(K.MAX_RETRIES + 1):
        for q in L.land(responses, _accepted(), ["event_id"], "ts", f"{base}/ok", f"{base}/dead", f"{base}/checkpoint",
                        retry_path=f"{base}/retry", recall=recall):
            q.awaitTermination()
    fields = "event_id BIGINT, attempts INT"
    landed, dead = (spark.read.schema(fields).json(f"{base}/{place}").select(
        "event_id", F.lit(outcome).alias("outcome"), F.coalesce("attempts", F.lit(0)).alias("attempts"))
        for place, outcome in (("ok", "landed"), ("dead", "dead_letter")))
    return landed.unionByName(dead)


@query(with_fx("fx_landing", f"""
SELECT domain, snapshot_date AS ingest_date, 'landed' AS origin, CAST(count(*) AS BIGINT) AS n_objects,
       CAST(max(epoch_us(ts)) // 1000 AS BIGINT) AS newest_ms
FROM fx_landing WHERE {OK} GROUP BY 1, 2"""))
def landing_ledger(spark, sf):
    """Two halves of the events are landed; the second entry reads the second half's files alone."""
    base = scratch_path(spark, "ledger")
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for half in (0, 1):
        events.where(F.col("event_id") % 2 == half).write.mode("append").parquet(f"{base}/events")
        arriving = L.read_stream(spark, f"{base}/events", events.schema, "parquet")
        for q in L.land(_as_responses(arriving), _accepted(), ["event_id"], "ts", f"{base}/raw/landed", f"{base}/dead",
                        f"{base}/checkpoint"):
            q.awaitTermination()
        LG.follow_landed(spark, f"{base}/raw", f"{base}/ledger")
    return LG.entries(spark, f"{base}/ledger").select(
        "domain", "ingest_date", "origin", "n_objects", F.unix_millis("newest").alias("newest_ms"))


@query(with_fx("fx_landing", """
, opened AS (SELECT domain, ts, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 2 HOUR THEN 0 ELSE 1 END AS opens FROM fx_landing
             WINDOW w AS (PARTITION BY domain ORDER BY ts))
, numbered AS (SELECT domain, ts, sum(opens) OVER (PARTITION BY domain ORDER BY ts, opens ROWS UNBOUNDED PRECEDING) AS no FROM opened)
SELECT domain, max(ts) AS silence_start, max(ts) + INTERVAL 2 HOUR AS alert_at, CAST(count(*) AS BIGINT) AS n_events
FROM numbered GROUP BY domain, no HAVING max(ts) + INTERVAL 2 HOUR <= (SELECT max(ts) FROM fx_landing)"""))
def silence_alerts(spark, sf):
    """Events arrive in four files in the order of time; a silence is told as soon as the stream's time has passed it."""
    base = scratch_path(spark, "alerts")
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    low, high = events.agg(F.unix_micros(F.min("ts")), F.unix_micros(F.max("ts"))).first()
    quarter = F.least(F.floor((F.unix_micros("ts") - low) * 4 / (high - low + 1)), F.lit(3))
    for q in range(4):
        events.where(quarter == q).coalesce(1).write.mode("append").parquet(f"{base}/events")
    stream = L.read_stream(spark, f"{base}/events", events.schema, "parquet", max_files=1)
    alerts = M.silence_alerts(with_response(stream), "ts", ["domain"], "2 hours")
    found = L.run_to_table(alerts, f"{base}/table", f"{base}/checkpoint")
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("silence_start", "alert_at")})


@query("SELECT CAST(4 AS BIGINT) AS n_batches, CAST(1 AS BIGINT) AS most_files, count(*) AS n_rows FROM events")
def stream_backpressure(spark, sf):
    """Four files are waiting; each micro-batch takes one."""
    base = scratch_path(spark, "backpressure")
    stream = _event_files(spark, sf).select("event_id", F.col("_metadata.file_path").alias("file"))

    def count(batch, number):
        (batch.agg(F.count_distinct("file").alias("n_files"), F.count("*").alias("n"))
         .write.mode("overwrite").parquet(f"{base}/counts/batch={number}"))

    (stream.writeStream.foreachBatch(count).option("checkpointLocation", f"{base}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema("n_files BIGINT, n BIGINT").parquet(f"{base}/counts").where("n > 0").agg(
        F.count("*").alias("n_batches"), F.max("n_files").alias("most_files"), F.sum("n").alias("n_rows"))


@query("""
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(o_totalprice AS DECIMAL(14,2)) AS price
FROM orders WHERE o_totalprice > 0""")
def audited_publication(spark, sf):
    """Good rows are published; a later batch with a broken row is refused and leaves the table as it was."""
    path = scratch_path(spark, "audited")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.trunc("o_orderdate", "month").alias("month"), F.col("o_totalprice").cast("decimal(14,2)").alias("price"))

    def checks(rows):
        return Q.report(Q.row_checks(rows, [Q.Violation("price", Q.HARD, F.col("price") <= 0, "price(s) <= 0")],
                                     non_empty="orders"))

    T.write_audit_publish(orders.where("price > 0"), path, ["month"], checks)
    broken = orders.withColumn("price", F.when(F.col("o_orderkey") % 2 == 0, F.lit(0)).otherwise(F.col("price"))
                               .cast("decimal(14,2)"))
    try:
        T.write_audit_publish(broken, path, ["month"], checks)
    except Q.QualityGateError:
        return spark.read.schema(orders.schema).parquet(path)
    raise AssertionError("a broken batch was published")


@query("""
SELECT layer, table_name, table_type, n_rows, CAST(row_number() OVER (ORDER BY rank, table_name) AS INT) AS place FROM (
    SELECT 'stock_silver' AS layer, 'orders' AS table_name, 'EXTERNAL' AS table_type, count(*) AS n_rows, 1 AS rank FROM orders
    UNION ALL SELECT 'stock_silver', 'customer', 'EXTERNAL', count(*), 1 FROM customer
    UNION ALL SELECT 'stock_gold', 'part', 'EXTERNAL', count(*), 2 FROM part)""")
def catalogue_inventory(spark, sf):
    """Catalogue tables in the order of their layers, which is not that of their names."""
    held = {("stock_silver", "orders"), ("stock_silver", "customer"), ("stock_gold", "part")}
    for layer, name in held:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        spark.sql(f"DROP TABLE IF EXISTS {layer}.{name}")
        table(spark, sf, name).write.option("path", scratch_path(spark, name)).saveAsTable(f"{layer}.{name}")
    counted = [spark.table(f"{layer}.{name}").agg(F.count("*").alias("n_rows")).select(
        F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "n_rows") for layer, name in held]
    counts = counted[0].unionByName(counted[1]).unionByName(counted[2])
    listed = T.table_inventory(spark, ["stock_silver", "stock_gold"]).withColumn("at", F.monotonically_increasing_id())
    # Three rows, numbered in the order in which the inventory gives them.
    placed = listed.withColumn("place", F.row_number().over(Window.orderBy("at"))).drop("at")
    return placed.join(counts, ["layer", "table_name"])


@query("""
SELECT o_orderpriority AS name, count(*) AS n_rows, TRUE AS found FROM orders GROUP BY 1
UNION ALL SELECT 'absent', CAST(0 AS BIGINT), FALSE UNION ALL SELECT 'empty', CAST(0 AS BIGINT), FALSE""")
def existence_probe(spark, sf):
    """Tables are looked for by path: one for each priority, one never written, and a folder without files."""
    base = scratch_path(spark, "probe")
    counts = materialise(table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("name")).agg(
        F.count("*").alias("n_rows")), "probe-counts")
    counts.write.partitionBy("name").parquet(base)
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/name=empty")
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    names = [r["name"] for r in counts.select("name").collect()] + ["absent", "empty"]  # one name a priority
    probed = spark.createDataFrame([(n, T.exists(spark, f"{base}/name={n}")) for n in names], "name string, found boolean")
    return probed.join(counts, "name", "left").select("name", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "found")


DAYS = ("2024-01-01", "2024-01-03", "2024-01-06")


@query("SELECT p_partkey AS id FROM part WHERE p_partkey % 7 IN (0, 2, 5) AND p_size % 10 <> 3")
def explicit_days_scan(spark, sf):
    """The folders of three stated days of seven are read, the others are not."""
    root, seven = scratch_path(spark, "week"), 7 * RECORDS_PER_OBJECT
    key = F.get_json_object("record", "$.id").cast("bigint")
    _write_zone(spark, part_records(spark, sf).withColumn("object_no", key % 7 + 7 * F.floor(key / seven)), "products", root)
    assert DAYS[0] == FIRST_DAY
    rows = R.read_raw(spark, R.input_paths(root, "products", DAYS), "products")
    return rows.where(F.col("_corrupt_record").isNull()).select("id")
