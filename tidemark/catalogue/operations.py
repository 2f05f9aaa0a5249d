"""Jobs and table maintenance run over the given tables: landing to Bronze, gates, rewrites, expiry."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from .. import jobs
from ..config import Lake
from ..operators import calendar as C
from ..operators import incremental as I
from ..operators import ntile_distributed
from ..operators import quality as Q
from ..operators import versions as V
from ..operators.rules import REASON, VALID, apply_rules, domain_rules
from ..plans import silver as S
from ..session import scratch_path
from ..sources import tables as T
from ..streaming import landing as L
from ..streaming import monitor as M
from .catalog import LANDED, landed_products
from .core import query, table
from .fixtures import landing, with_fx, with_response
from .landing import CALENDAR, landed_orders, order_calendar


def _event_files(spark, sf, files: int = 4):
    """The events dealt over some files out of time order, and a stream that takes one at a time."""
    path = scratch_path(spark, "event-files")
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(files, "event_id").write.parquet(path)
    return L.read_stream(spark, path, events.schema, "parquet", max_files=1)


@query(with_fx("fx_landing", "SELECT DISTINCT domain, snapshot_date, user_id FROM fx_landing"))
def dedup_out_of_order(spark, sf):
    """Keys first seen in any micro-batch, however late their events are."""
    keys = ["domain", "snapshot_date", "user_id"]
    arrived = L.arriving(with_response(_event_files(spark, sf)))
    base = scratch_path(spark, "dedup-late")
    return L.run_to_table(L.dedup_stream(arrived, keys, L.ARRIVED).select(*keys), f"{base}/t", f"{base}/c")


OK = f"status = {K.OK_STATUS} AND n_bytes > {K.MIN_BODY_BYTES} AND mime LIKE '%json%'"


@query(with_fx("fx_landing", f"""
SELECT snapshot_date AS _ingest_date, CAST(count(*) AS BIGINT) AS n_rows, CAST(min(event_id) AS BIGINT) AS first_id,
       CAST(max(event_id) AS BIGINT) AS last_id, CAST(count(*) FILTER (value < 0) AS BIGINT) AS n_invalid,
       CAST(min(epoch_us(ts)) // 1000 AS BIGINT) AS first_ms
FROM fx_landing WHERE {OK} GROUP BY 1"""))
def landing_to_bronze(spark, sf):
    """Events arrive as product responses, are landed by the stream and read by the Bronze job."""
    lake = Lake(scratch_path(spark, "lake"))
    body = F.concat(F.lit("["), F.to_json(F.struct(
        F.col("event_id").alias("id"), F.col("domain").alias("title"), F.col("value").alias("price"))), F.lit("]"))
    responses = with_response(_event_files(spark, sf)).select(
        "event_id", "ts", F.lit("products").alias("domain"), "snapshot_date", "status", "mime", "n_bytes",
        body.alias("body"))
    accepted = L.is_conforming(F.col("status"), F.col("n_bytes"), F.col("mime"))
    for q in L.land(responses, accepted, ["event_id"], "ts", f"{lake.raw}/landed", f"{lake.root}/dead",
                    f"{lake.root}/checkpoint"):
        q.awaitTermination()
    jobs.run_bronze(spark, lake, "products")
    return lake.read(spark, "bronze", "raw_products").groupBy("_ingest_date").agg(
        F.count("*").alias("n_rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id"),
        F.count_if(~F.col("_is_valid")).alias("n_invalid"), F.min(F.unix_millis("_ingest_ts")).alias("first_ms"))


@query(with_fx("fx_landing", """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       domain, CAST(count(*) AS BIGINT) AS n_events, CAST(sum(n_bytes) AS BIGINT) AS n_bytes
FROM fx_landing GROUP BY 1, 2, 3"""))
def throughput_bytes(spark, sf):
    return M.throughput(landing(spark, sf), "ts", "1 hour", ["domain"], "n_bytes").withColumns({
        c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


REQUIRED = ("1-URGENT", "2-HIGH", "absent")


@query(CALENDAR + f"""
, wanted AS (SELECT unnest({list(REQUIRED)}) AS domain)
, counted AS (SELECT w.domain, CAST(count(l.day) AS BIGINT) AS n_landed, CAST((SELECT count(*) FROM days) AS BIGINT) AS n_expected
              FROM wanted w LEFT JOIN landed l ON l.domain = w.domain GROUP BY w.domain)
SELECT domain, n_landed, n_expected, FALSE AS gate_passed FROM counted""")
def coverage_required(spark, sf):
    """A required domain without any object scores 0, and the gate fails on it."""
    rates = I.coverage(landed_orders(spark, sf), order_calendar(spark, sf), "domain", "day", REQUIRED)
    passed = Q.coverage_check(rates, "raw.coverage").select("passed").scalar()
    return rates.select("domain", "n_landed", "n_expected", passed.alias("gate_passed"))


GONE = 50


@query(f"""
WITH old AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS h FROM orders
             WHERE o_orderkey % {GONE} <> 1)
, new AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END AS h FROM orders
          WHERE o_orderkey % {GONE} <> 2)
SELECT coalesce(old.k, new.k) AS k, CASE WHEN old.k IS NULL THEN 'added' WHEN new.k IS NULL THEN 'removed'
       ELSE 'changed' END AS change
FROM old FULL JOIN new ON old.k = new.k
WHERE old.k IS NULL OR new.k IS NULL OR old.h IS DISTINCT FROM new.h""")
def version_diff_nulls(spark, sf):
    """A missing fingerprint is a state of its own, not a missing row."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("h"))
    old = orders.where(f"k % {GONE} <> 1").withColumn("h", F.when(F.col("k") % 3 != 0, F.col("h")))
    new = orders.where(f"k % {GONE} <> 2").withColumn("h", F.when(F.col("k") % 4 != 0, F.col("h")))
    return V.version_diff(old, new, ["k"], "h")


@query("""
WITH m AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE (o_orderkey % 1000) * 1e-10 + o_custkey % 3 END AS v
           FROM orders)
SELECT o_orderkey, CAST(ntile(100) OVER (ORDER BY v DESC NULLS LAST, o_orderkey) AS INT) AS tile FROM m""")
def ntile_double(spark, sf):
    """Measures that differ far behind the decimal point."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.when(
        F.col("o_orderkey") % 11 != 0, (F.col("o_orderkey") % 1000) * F.lit(1e-10) + F.col("o_custkey") % 3).alias("v"))
    return ntile_distributed(orders, 100, F.col("v"), "o_orderkey", True).select("o_orderkey", "tile")


@query("""
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(14,2)) + 1 AS total_price FROM orders WHERE o_orderkey % 2 = 0""")
def replace_table(spark, sf):
    """A table is replaced by rows computed from itself."""
    path = scratch_path(spark, "replaced")
    T.replace_table(table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(14,2)").alias("total_price")), path)
    now = spark.read.parquet(path)
    T.replace_table(now.where("o_orderkey % 2 = 0").withColumn(
        "total_price", (F.col("total_price") + 1).cast("decimal(15,2)")), path, (), ["o_orderkey"])
    return spark.read.parquet(path)


@query("""
SELECT event_type, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(event_id) AS BIGINT) AS id_sum, CAST(0 AS BIGINT) AS n_planned
FROM events GROUP BY event_type""")
def compaction_run(spark, sf):
    """Six small files per type are rewritten; a second run has nothing to plan."""
    path = scratch_path(spark, "compacted")
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    events.repartition(6, "event_id").write.partitionBy("event_type").parquet(path)
    T.compact(spark, path, ["event_type"], ["event_id"])
    planned = T.compaction_plan(spark, path).agg(F.count("*").alias("n")).select("n").scalar()
    return spark.read.schema(events.schema).parquet(path).groupBy("event_type").agg(
        F.count("*").alias("n_rows"), F.sum("event_id").alias("id_sum"), planned.alias("n_planned"))


@query(f"""
WITH d AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS day FROM orders)
, kept AS (SELECT day FROM d WHERE day >= (SELECT max(day) FROM d) - 100
           UNION SELECT day FROM (SELECT day FROM d ORDER BY day DESC LIMIT {K.RETAIN_LAST}))
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS day, CAST(count(*) AS BIGINT) AS n_rows FROM orders
WHERE CAST(date_trunc('month', o_orderdate) AS DATE) IN (SELECT day FROM kept) GROUP BY 1""")
def expire_partitions(spark, sf):
    """Partitions far older than the newest are deleted on disk, the newest few never."""
    path = scratch_path(spark, "expired")
    orders = table(spark, sf, "orders").select("o_orderkey", F.trunc("o_orderdate", "month").alias("day"))
    T.overwrite_partitions(orders, path, ["day"])
    T.expire(spark, path, "day", 100)
    return spark.read.schema(orders.schema).parquet(path).groupBy("day").agg(F.count("*").alias("n_rows"))


@query("SELECT count(*) AS n_rows, max(CAST(o_orderdate AS DATE)) AS newest FROM orders")
def table_stats(spark, sf):
    return T.table_stats(table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate")), "day")


DATES = ("1995-03-01", "1996-07-01", "1997-01-01")


@query("WITH one AS (SELECT 1)" + LANDED + f"""
SELECT id, _ingest_date, _record_hash FROM newest WHERE CAST(_ingest_date AS VARCHAR) IN {DATES}""")
def date_list_scan(spark, sf):
    return S.current_records(landed_products(spark, sf), DATES).select("id", "_ingest_date", "_record_hash")


@query(f"""
SELECT l_orderkey, l_linenumber, CASE
    WHEN l_linenumber = 7 THEN '{K.REASON_NO_ID}' WHEN l_linenumber = 6 THEN '{K.REASON_NO_USER}'
    WHEN l_quantity < 10 THEN '{K.REASON_EMPTY_CART}' END AS reason,
    NOT (l_linenumber IN (6, 7) OR l_quantity < 10) AS is_valid
FROM lineitem""")
def validity_carts(spark, sf):
    line = F.struct(F.col("l_partkey").alias("productId"), F.col("l_quantity").cast("int").alias("quantity"))
    carts = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")).alias("id"),
        F.when(F.col("l_linenumber") != 6, F.col("l_suppkey")).alias("userId"),
        F.when(F.col("l_quantity") >= 10, F.array(line)).alias("products"),
        F.lit(None).cast("string").alias("_corrupt_record"))
    return apply_rules(carts, domain_rules("carts")).select(
        "l_orderkey", "l_linenumber", F.col(REASON).alias("reason"), F.col(VALID).alias("is_valid"))


LAST = "1998-06-30"


@query(f"""
WITH days AS (SELECT CAST(unnest(generate_series(DATE '{LAST}' - {K.HISTORY_DAYS - 1}, DATE '{LAST}', INTERVAL 1 DAY)) AS DATE) AS day)
SELECT day, CAST(count(o_orderkey) AS BIGINT) AS n_orders
FROM days LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day GROUP BY day""")
def history_window_orders(spark, sf):
    """Orders on every day of the history window, days without any included."""
    days = C.history_window(spark, LAST, name="day")
    orders = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"), "o_orderkey")
    return days.join(orders, "day", "left").groupBy("day").agg(F.count("o_orderkey").alias("n_orders"))


