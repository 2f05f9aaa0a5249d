"""The landing flow over the event stream, and its monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import calendar as C
from ..operators import gaps
from ..operators import incremental as I
from ..operators.rules import route
from ..session import scratch_path
from ..streaming import landing as L
from ..streaming import monitor as M
from .core import quotient, query, table
from .fixtures import landing, with_fx, with_response


def event_stream(spark, sf):
    """The events table read as a file stream, with an event time that takes a watermark."""
    schema = table(spark, sf, "events").schema
    # A pattern matches the table whether it is one file or a folder of files.
    return L.read_stream(spark, f"{sf}/events*.parquet", schema, "parquet").withColumn(
        "ts", F.col("ts").cast("timestamp")
    )


def drain(spark, df, label: str):
    base = scratch_path(spark, label)
    return L.run_to_table(df, f"{base}/table", f"{base}/checkpoint")


BODY = """concat('{"snapshot_date":"', CAST(CAST(ts AS DATE) AS VARCHAR), '","domains":["', event_type,
       '-1","', user_id, '/', event_type, '"],"run_id":"run-', event_id, '"}')"""


def requests(events):
    """Request envelopes asking for the event's type twice, under decorated names."""
    body = F.concat(
        F.lit('{"snapshot_date":"'), F.to_date("ts").cast("string"), F.lit('","domains":["'),
        F.col("event_type"), F.lit('-1","'), F.col("user_id").cast("string"), F.lit("/"),
        F.col("event_type"), F.lit('"],"run_id":"run-'), F.col("event_id").cast("string"), F.lit('"}'),
    )
    return events.select("event_id", body.alias("body"))


@query(f"""
SELECT event_id, json_extract_string(body, '$.snapshot_date') AS snapshot_date,
       json_extract_string(body, '$.run_id') AS run_id,
       CAST(json_array_length(body, '$.domains') AS INT) AS n_domains
FROM (SELECT event_id, {BODY} AS body FROM events)""")
def stream_json_extract(spark, sf):
    parsed = L.parse_requests(requests(event_stream(spark, sf)), "body")
    out = parsed.select("event_id", "snapshot_date", "run_id", F.size("domains").alias("n_domains"))
    return drain(spark, out, "requests")


@query("""
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS snapshot_date, 'run-' || event_id AS run_id,
       event_type AS domain
FROM events, (VALUES (1), (2)) AS twice(n)""")
def stream_explode(spark, sf):
    parsed = L.parse_requests(requests(event_stream(spark, sf)), "body").drop("body")
    return drain(spark, L.split_domains(parsed), "split")


OK = f"status = {K.OK_STATUS} AND n_bytes > {K.MIN_BODY_BYTES} AND mime LIKE '%json%'"


def conforming():
    return L.is_conforming(F.col("status"), F.col("n_bytes"), F.col("mime"))


@query(with_fx("fx_landing", f"""
SELECT event_id, domain, snapshot_date, CAST(n_bytes AS INT) AS n_bytes FROM fx_landing WHERE {OK}"""))
def route_conforming(spark, sf):
    ok, _ = route(with_response(event_stream(spark, sf)), conforming())
    return drain(spark, ok.select("event_id", "domain", "snapshot_date", "n_bytes"), "conforming")


@query(with_fx("fx_landing", f"""
SELECT event_id, CAST(status AS INT) AS status, mime, CAST(n_bytes AS INT) AS n_bytes,
       concat('_dead_letter/', domain, '/', CAST(snapshot_date AS VARCHAR), '/', event_id, '.json') AS object_key
FROM fx_landing WHERE NOT coalesce({OK}, FALSE)"""))
def route_dead_letter(spark, sf):
    _, dead = route(with_response(event_stream(spark, sf)), conforming())
    key = L.dead_letter_key(F.col("domain"), F.col("snapshot_date"), F.col("event_id").cast("string"))
    return drain(spark, dead.select("event_id", "status", "mime", "n_bytes", key.alias("object_key")), "dead")


@query(with_fx("fx_landing", "SELECT DISTINCT domain, snapshot_date, user_id FROM fx_landing"))
def stream_dedup(spark, sf):
    keys = ["domain", "snapshot_date", "user_id"]
    landed = with_response(event_stream(spark, sf))
    return drain(spark, L.dedup_stream(landed, keys, "ts", spread=["event_id"]).select(*keys), "dedup")


@query(with_fx("fx_landing", """
SELECT event_id, concat(domain, '/ingest_date=', CAST(snapshot_date AS VARCHAR), '/', domain, '_',
       CAST(snapshot_date AS VARCHAR), '_', CAST(epoch_us(ts) // 1000 AS VARCHAR), '_', md5(CAST(event_id AS VARCHAR)), '.json') AS object_key
FROM fx_landing"""))
def landing_path(spark, sf):
    millis = F.unix_millis(F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp"))
    token = F.md5(F.col("event_id").cast("string"))
    return landing(spark, sf).select(
        "event_id",
        L.object_key(F.col("domain"), F.col("snapshot_date"), millis, token).alias("object_key"),
    )


@query(with_fx("fx_landing", f"""
, tried AS (SELECT event_id, CAST(event_id % 6 AS INT) AS before, status = 500 AS failed FROM fx_landing)
SELECT event_id, CAST(before + CAST(failed AS INT) AS INT) AS attempts,
       CASE WHEN NOT failed THEN 'done' WHEN before + 1 > {K.MAX_RETRIES} THEN 'dead_letter' ELSE 'retry' END AS next_stop
FROM tried"""))
def retry_route(spark, sf):
    tried = landing(spark, sf).select(
        "event_id", "status", (F.col("event_id") % 6).cast("int").alias("attempts")
    )
    return L.retry_route(tried, F.col("status") == 500, "attempts").drop("status")


@query(with_fx("fx_landing", """
SELECT domain, snapshot_date, user_id, CAST(count(*) AS BIGINT) AS n_arrivals,
       CAST(count(*) - 1 AS BIGINT) AS n_duplicates
FROM fx_landing GROUP BY 1, 2, 3 HAVING count(*) > 1"""))
def duplicate_report(spark, sf):
    return L.duplicate_report(landing(spark, sf), ["domain", "snapshot_date", "user_id"])


def _plain(df):
    """Window bounds as wall-clock timestamps."""
    return df.withColumns({
        c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")
    })


@query(with_fx("fx_landing", """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
       domain, CAST(count(*) AS BIGINT) AS n_events
FROM fx_landing GROUP BY 1, 2, 3"""))
def throughput_tumbling(spark, sf):
    base = scratch_path(spark, "throughput")
    return _plain(M.stream_throughput(with_response(event_stream(spark, sf)), "ts", "5 minutes", ["domain"],
                                      f"{base}/counts", f"{base}/checkpoint"))


@query(with_fx("fx_landing", """
, opened AS (
    SELECT time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE * k AS window_start, domain
    FROM fx_landing, (VALUES (0), (1), (2)) AS panes(k))
SELECT window_start, window_start + INTERVAL 15 MINUTE AS window_end, domain, CAST(count(*) AS BIGINT) AS n_events
FROM opened GROUP BY 1, 2, 3"""))
def throughput_sliding(spark, sf):
    return M.sliding_throughput(landing(spark, sf), "ts", "15 minutes", "5 minutes", ["domain"])


@query(with_fx("fx_landing", """
SELECT domain, ts AS silence_start, next_ts AS silence_end FROM (
    SELECT domain, ts, lead(ts) OVER (PARTITION BY domain ORDER BY ts) AS next_ts FROM fx_landing)
WHERE next_ts > ts + INTERVAL 2 HOUR"""))
def silence_gaps(spark, sf):
    return gaps.silences(landing(spark, sf), "ts", ["domain"], "2 hours")


@query(with_fx("fx_landing", """
, marked AS (
    SELECT user_id, ts, CAST(value AS DECIMAL(12,2)) AS value,
           CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens
    FROM fx_landing)
, numbered AS (
    SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session_no FROM marked)
SELECT user_id, CAST(session_no AS BIGINT) AS session_no, min(ts) AS session_start, max(ts) AS session_last,
       CAST(count(*) AS BIGINT) AS n_events, CAST(sum(value) AS DECIMAL(22,2)) AS total_value
FROM numbered GROUP BY 1, 2"""))
def session_activity(spark, sf):
    events = landing(spark, sf).withColumn("value", F.col("value").cast("decimal(12,2)"))
    found = gaps.sessions(events, "ts", ["user_id"], "6 hours", "value")
    return found.withColumn("total_value", F.col("total_value").cast("decimal(22,2)"))


def ship_days(spark, sf):
    return table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day"))


def order_days(spark, sf):
    return table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))


PENDING = """
SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem
WHERE CAST(l_shipdate AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)"""


@query(PENDING)
def pending_dates(spark, sf):
    return I.pending(ship_days(spark, sf), order_days(spark, sf), "day")


@query(PENDING + " ORDER BY day LIMIT 5")
def pending_dates_limited(spark, sf):
    return I.pending(ship_days(spark, sf), order_days(spark, sf), "day", limit=5)


@query("SELECT max(CAST(ts AS DATE)) AS anchor FROM events")
def anchor_date(spark, sf):
    return I.anchor(landing(spark, sf), "snapshot_date", "2024-01-01")


def landed_orders(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("domain"), F.to_date("o_orderdate").alias("day")
    )


def order_calendar(spark, sf):
    return C.days_of(order_days(spark, sf), "day", "day")


CALENDAR = """
WITH landed AS (SELECT DISTINCT o_orderpriority AS domain, CAST(o_orderdate AS DATE) AS day FROM orders)
, days AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM landed)
"""


@query(CALENDAR + f"""
, counted AS (SELECT domain, CAST(count(*) AS BIGINT) AS n_landed,
                     CAST((SELECT count(*) FROM days) AS BIGINT) AS n_expected FROM landed GROUP BY domain)
SELECT *, {quotient('n_landed', 'n_expected', 9, 4)} AS coverage_rate FROM counted""")
def coverage_rate(spark, sf):
    return I.coverage(landed_orders(spark, sf), order_calendar(spark, sf), "domain", "day")


@query(CALENDAR + """
SELECT domain, day FROM (SELECT DISTINCT domain FROM landed), days
EXCEPT SELECT domain, day FROM landed""")
def missing_dates(spark, sf):
    return I.missing_days(landed_orders(spark, sf), order_calendar(spark, sf), "domain", "day")


REQUIRED = ("1-URGENT", "2-HIGH")


@query(CALENDAR + f"""
SELECT day, domain FROM days, (VALUES ('{REQUIRED[0]}'), ('{REQUIRED[1]}')) AS required(domain)
EXCEPT SELECT day, domain FROM landed""")
def missing_domains(spark, sf):
    return I.missing_domains(
        landed_orders(spark, sf), "domain", "day", REQUIRED, order_calendar(spark, sf)
    )


@query("""
WITH span AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders)
, days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d, hi FROM span)
SELECT d AS date_key, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day,
       CAST(weekofyear(d) AS INT) AS week_of_year, dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend,
       CAST(date_trunc('month', d) AS DATE) AS month_start,
       CAST(datediff('day', hi, d) + 179 AS INT) AS day_index
FROM days""")
def calendar_dim(spark, sf):
    return C.calendar_of(order_days(spark, sf), "day")
