"""The landing flow as a stream: late rows, replays, two sinks."""

import datetime as dt
import json

from compare import rows
from pyspark.sql import functions as F

from tidemark.streaming import landing as L

RESPONSES = "domain string, snapshot_date string, ts timestamp, status int, mime string, body string"
BODY = "x" * 30


def write(folder, name, records):
    folder.mkdir(parents=True, exist_ok=True)
    text = "\n".join(json.dumps(r) for r in records)
    (folder / name).write_text(text)


def response(domain, day, ts, status=200, body=BODY, mime="application/json"):
    return {"domain": domain, "snapshot_date": day, "ts": ts, "status": status, "mime": mime, "body": body}


def accepted():
    return L.is_conforming(F.col("status"), F.length("body"), F.col("mime"))


def drain(spark, source, base, spread=()):
    df = L.read_stream(spark, str(source), RESPONSES, max_files=1)
    queries = L.land(df, accepted(), ["domain", "snapshot_date"], "ts", f"{base}/ok", f"{base}/dead",
                     f"{base}/checkpoint", spread)
    for query in queries:
        query.awaitTermination()


def test_land_routes_deduplicates_and_resumes(spark, tmp_path):
    source, base = tmp_path / "in", tmp_path / "out"
    write(source, "a.json", [
        response("products", "2024-03-01", "2024-03-01T08:00:00Z"),
        response("products", "2024-03-01", "2024-03-01T09:00:00Z"),
        response("users", "2024-03-01", "2024-03-01T08:00:00Z", status=500),
        response("users", "2024-03-01", "2024-03-01T08:01:00Z", body="[]"),
        response("users", "2024-03-01", "2024-03-01T08:02:00Z", mime="text/html"),
    ])
    drain(spark, source, base, ["ts"])
    ok = spark.read.json(f"{base}/ok")
    assert rows(ok.select("domain", F.col("ingest_date").cast("string"))) == [("products", "2024-03-01")]
    assert spark.read.json(f"{base}/dead").count() == 3
    write(source, "b.json", [
        response("products", "2024-03-01", "2024-03-01T20:00:00Z"),
        response("users", "2024-03-01", "2024-03-01T20:00:00Z"),
    ])
    drain(spark, source, base, ["ts"])
    ok = spark.read.json(f"{base}/ok")
    assert rows(ok.select("domain")) == [("products",), ("users",)]
    drain(spark, source, base, ["ts"])
    assert spark.read.json(f"{base}/ok").count() == 2 and spark.read.json(f"{base}/dead").count() == 3


def test_late_events_land_and_keys_age_by_arrival(spark, tmp_path):
    source, base = tmp_path / "in", tmp_path / "out"
    batches = [
        [response("p", "d1", "2024-03-01T00:00:00Z")],
        [response("p", "d2", "2024-03-05T00:00:00Z")],
        [response("p", "d3", "2024-03-02T00:00:00Z"), response("p", "d1", "2024-03-05T01:00:00Z")],
    ]
    for n, batch in enumerate(batches):
        write(source, f"{n}.json", batch)
        drain(spark, source, base)
    found = rows(spark.read.json(f"{base}/ok").select(F.col("ingest_date").cast("string")))
    # d3's event lies days behind, but its key is new; d1 arrived moments ago, so it is a duplicate.
    assert found == [("d1",), ("d2",), ("d3",)]


def test_many_keys_of_a_day_make_few_files(spark, tmp_path):
    source, base, n = tmp_path / "in", tmp_path / "out", 16 * L.FOLDER_TASKS
    write(source, "a.json", [dict(response("products", "2024-03-01", f"2024-03-01T08:{i % 60:02d}:00Z"), k=i) for i in range(n)])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(4 * L.FOLDER_TASKS))
    try:
        df = L.read_stream(spark, str(source), RESPONSES + ", k int")
        for query in L.land(df, accepted(), ["k"], "ts", f"{base}/ok", f"{base}/dead", f"{base}/c"):
            query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(r["k"] for r in spark.read.json(f"{base}/ok").select("k").collect()) == list(range(n))
    assert 1 < len(list((base / "ok").glob("*/*/*.json"))) <= L.FOLDER_TASKS


def test_late_arrivals_are_counted(spark):
    at = dt.datetime(2024, 3, 5)
    df = spark.createDataFrame([("p", at, at), ("p", at - dt.timedelta(days=2), at), ("u", at - dt.timedelta(hours=5), at)],
                               f"domain string, ts timestamp, {L.ARRIVED} timestamp")
    assert [tuple(r)[:2] for r in L.late_report(df, "ts", ["domain"]).collect()] == [("p", 1)]


def test_batch_frames_are_deduplicated_too(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 3, 5)), (1, dt.datetime(2020, 1, 1)), (2, None)], "k int, ts timestamp")
    assert L.dedup_stream(df, ["k"], "ts").count() == 2


def test_refused_rows_are_tried_again_until_the_limit(spark, tmp_path):
    source, base = tmp_path / "in", tmp_path / "out"
    write(source, "a.json", [dict(response("p", "2024-03-01", "2024-03-01T08:00:00Z", status=500), attempts=n)
                             for n in (0, 2, 3)])
    df = L.read_stream(spark, str(source), RESPONSES + ", attempts int")
    for query in L.land(df, accepted(), ["domain"], "ts", f"{base}/ok", f"{base}/dead", f"{base}/c",
                        retry_path=f"{base}/retry"):
        query.awaitTermination()
    assert rows(spark.read.json(f"{base}/retry").select("attempts")) == [(1,), (3,)]
    assert rows(spark.read.json(f"{base}/dead").select("attempts")) == [(4,)]

def test_requests_are_parsed_and_split(spark):
    body = json.dumps({"snapshot_date": "2024-03-01", "domains": ["products", " users2 "], "run_id": "r"})
    df = spark.createDataFrame([(body,), ("{broken",)], "body string")
    split = L.split_domains(L.parse_requests(df, "body").drop("body"))
    assert rows(split.select("snapshot_date", "run_id", "domain")) == [
        ("2024-03-01", "r", "products"), ("2024-03-01", "r", "users")]


def test_retry_and_keys(spark):
    df = spark.createDataFrame([(False, 2), (True, None), (True, 2), (True, 3)], "failed boolean, n int")
    found = [tuple(r)[1:] for r in L.retry_route(df, F.col("failed"), "n").collect()]
    assert found == [(2, "done"), (1, "retry"), (3, "retry"), (4, "dead_letter")]
    keys = spark.range(1).select(
        L.object_key(F.lit("users"), F.lit("2024-03-01"), F.lit(5), F.lit("t")),
        L.dead_letter_key(F.lit(""), F.lit(None).cast("string"), F.lit("t")),
    ).first()
    assert tuple(keys) == ("users/ingest_date=2024-03-01/users_2024-03-01_5_t.json",
                           "_dead_letter/inconnu/sans-date/t.json")
    assert dt.date(2024, 3, 1).isoformat() in keys[0]


def test_a_silence_is_told_while_it_lasts(spark, tmp_path):
    from tidemark.streaming import monitor as M

    source, base = tmp_path / "in", tmp_path / "out"
    at = lambda d, h: response(d, "d", f"2024-03-01T{h:02d}:00:00Z")
    runs, seen = [[at("a", 1), at("b", 1), at("b", 2)], [at("a", 3)], [at("a", 7), at("a", 10)], [at("b", 12)]], []
    for n, batch in enumerate(runs):
        write(source, f"{n}.json", batch)
        stream = L.read_stream(spark, str(source), RESPONSES, max_files=1)
        found = L.run_to_table(M.silence_alerts(stream, "ts", ["domain"], "3 hours"), f"{base}/t", f"{base}/c")
        seen.append(rows(found.select("domain", F.hour("silence_start"), "n_events")))
    # b has been silent since 2 when a speaks at 7 and at 10, just in time; nobody has to wait until b speaks again.
    assert seen[1] == [] and ("b", 2, 2) in seen[2] and ("a", 3, 2) in seen[2]
    batch = M.silence_alerts(spark.read.schema(RESPONSES).json(str(source)), "ts", ["domain"], "3 hours")
    newest = F.lit("2024-03-01T12:00:00Z").cast("timestamp")
    assert seen[3] == rows(batch.where(F.col("alert_at") <= newest).select("domain", F.hour("silence_start"), "n_events"))
