"""The landing flow over several runs: retries, the ledger of the raw zone, waiting for upstream."""

import json
import os
import time

import pytest
from compare import rows
from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.config import Lake
from tidemark.sources import ledger as LG
from tidemark.sources import raw as R

DAY = "2024-03-01"
OLD = time.time() - 3600


def respond(source, name, *lines):
    source.mkdir(exist_ok=True)
    whole = [{"domain": "products", "snapshot_date": DAY, "ts": "2024-03-01T08:00:00Z", "status": 200,
              "mime": "application/json", "body": json.dumps([{"id": 1, "title": "t", "price": 2.0}]), **x} for x in lines]
    (source / name).write_text("\n".join(map(json.dumps, whole)))


def place(lake, domain, day, millis, changed=OLD):
    folder = f"{lake.raw}/{domain}/ingest_date={day}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{domain}_{day}_{millis}_0a-1b.json", "w") as f:
        json.dump([{"id": 1, "title": "t", "price": 2.0}], f)
    os.utime(folder, (changed, changed))


def found(spark, path):
    fields = "domain string, attempts int"
    return spark.read.schema(fields).json(path) if R.present(spark, path) else spark.createDataFrame([], fields)


def test_a_refused_response_becomes_a_dead_letter_once(spark, tmp_path):
    lake, source = Lake(str(tmp_path / "lake")), tmp_path / "in"
    respond(source, "a.json", {"status": 500}, {"domain": "users"})
    waiting = []
    for _ in range(6):
        jobs.run_landing(spark, lake, str(source))
        waiting.append(found(spark, f"{lake.root}/_dead_letter").count())
    assert waiting == [0, 0, 0, 1, 1, 1]
    assert rows(spark.read.json(f"{lake.root}/_retry").select("attempts")) == [(1,), (2,), (3,)]
    assert rows(spark.read.json(f"{lake.root}/_dead_letter").select("domain", "attempts")) == [("products", 4)]
    assert rows(spark.read.json(f"{lake.raw}/landed").select("domain")) == [("users",)]


def test_a_response_that_recovers_lands_once(spark, tmp_path):
    lake, source = Lake(str(tmp_path / "lake")), tmp_path / "in"
    respond(source, "a.json", {"status": 500})
    recall = lambda df: df.withColumn("status", F.when(F.col("attempts") >= 2, 200).otherwise(F.col("status")))
    for _ in range(5):
        jobs.run_landing(spark, lake, str(source), recall)
    assert rows(spark.read.json(f"{lake.raw}/landed").select("domain", "attempts")) == [("products", 2)]
    assert found(spark, f"{lake.root}/_dead_letter").count() == 0


def test_a_day_landed_by_a_later_response_ends_the_retries(spark, tmp_path):
    lake, source = Lake(str(tmp_path / "lake")), tmp_path / "in"
    respond(source, "a.json", {"status": 500})
    jobs.run_landing(spark, lake, str(source))
    respond(source, "b.json", {"ts": "2024-03-01T09:00:00Z"})
    for _ in range(5):
        jobs.run_landing(spark, lake, str(source))
    assert spark.read.json(f"{lake.raw}/landed").count() == 1
    assert found(spark, f"{lake.root}/_dead_letter").count() == 0
    assert rows(spark.read.json(f"{lake.root}/_retry").select("attempts")) == [(1,), (2,)]


def test_only_changed_folders_are_listed(spark, tmp_path, monkeypatch):
    lake, listed = Lake(str(tmp_path)), []
    plain = R.objects
    monkeypatch.setattr(R, "objects", lambda spark, root, *a: listed.append(len(root)) or plain(spark, root, *a))
    for n in range(5):
        place(lake, "products", f"2024-03-0{n + 1}", 1709290800123)
    ledger = jobs.ledger(lake)
    assert len(LG.follow_objects(spark, lake.raw, "products", ledger)) == 5
    assert LG.follow_objects(spark, lake.raw, "products", ledger) == []
    place(lake, "products", "2024-03-06", 1709290800123)
    place(lake, "products", "2024-03-02", 1709290800100, OLD + 60)  # late, and called before the first
    assert LG.follow_objects(spark, lake.raw, "products", ledger) == ["2024-03-02", "2024-03-06"]
    assert listed == [5, 2]
    counts = {str(r.ingest_date): r.n_objects for r in LG.entries(spark, ledger).collect()}
    assert counts["2024-03-02"] == 2 and len(counts) == 6 and sum(counts.values()) == 7


def test_a_folder_that_may_still_change_is_listed_again(spark, tmp_path):
    lake = Lake(str(tmp_path))
    place(lake, "products", DAY, 1, time.time())
    assert LG.follow_objects(spark, lake.raw, "products", jobs.ledger(lake)) == [DAY]
    assert LG.follow_objects(spark, lake.raw, "products", jobs.ledger(lake)) == [DAY]


def test_bronze_takes_late_objects_of_old_days(spark, tmp_path):
    lake = Lake(str(tmp_path))
    place(lake, "products", DAY, 1709290800123)
    assert jobs.run_bronze(spark, lake, "products")["days"] == [DAY]
    assert jobs.run_bronze(spark, lake, "products")["days"] == []
    place(lake, "products", DAY, 1709290800000, OLD + 60)
    assert jobs.run_bronze(spark, lake, "products")["days"] == [DAY]
    assert jobs.run_bronze(spark, lake, "products")["days"] == []


def test_the_ledger_reads_each_landed_file_once(spark, tmp_path):
    lake, source = Lake(str(tmp_path / "lake")), tmp_path / "in"
    for n in range(3):
        respond(source, f"{n}.json", {"snapshot_date": f"2024-03-0{n + 1}"})
        jobs.run_landing(spark, lake, str(source))
        LG.follow_landed(spark, lake.raw, jobs.ledger(lake))
    per_run = spark.read.parquet(f"{jobs.ledger(lake)}/landed").groupBy("batch").agg(F.sum("n_objects")).collect()
    assert [r[1] for r in per_run] == [1, 1, 1]
    assert LG.entries(spark, jobs.ledger(lake)).count() == 3


def test_misplaced_objects_are_counted_apart(spark, tmp_path):
    lake = Lake(str(tmp_path))
    place(lake, "products", DAY, 1)
    os.makedirs(f"{lake.raw}/products/upload")
    with open(f"{lake.raw}/products/upload/x.json", "w") as f:
        f.write("[]")
    counts = {(r.domain, str(r.ingest_date)): r.n_objects for r in R.raw_inventory(spark, lake.raw).collect()}
    assert counts == {("products", DAY): 1, ("products", "None"): 1}


class Clock:
    def __init__(self, on_sleep=None):
        self.now, self.on_sleep = 0.0, on_sleep

    def __call__(self):
        return self.now

    def sleep(self, seconds):
        self.now += seconds
        if self.on_sleep:
            self.on_sleep(self.now)


def test_waiting_ends_when_every_domain_has_landed(spark, tmp_path):
    lake, source = Lake(str(tmp_path / "lake")), tmp_path / "in"
    respond(source, "a.json", {})
    clock = Clock(lambda now: respond(source, f"{now}.json", {"domain": "users" if now == 60 else "carts"}))
    assert jobs.run_wait(spark, lake, str(source), DAY, 600, 60, ("products", "users", "carts"), clock, clock.sleep) == []
    assert clock.now == 120


def test_waiting_stops_at_the_deadline_with_an_exit_code(spark, tmp_path):
    lake, source = Lake(str(tmp_path / "lake")), tmp_path / "in"
    respond(source, "a.json", {})
    clock = Clock()
    assert jobs.run_wait(spark, lake, str(source), DAY, 100, 60, ("products", "users"), clock, clock.sleep) == ["users"]
    args = jobs._arguments(["wait", "--lake", lake.root, "--source", str(source), "--day", "2024-03-09",
                            "--timeout-seconds", "0", "--poll-seconds", "1"])
    assert jobs.run(spark, args) == 2


@pytest.mark.parametrize("name", ["not-a-day.json"])
def test_nothing_is_entered_when_a_name_does_not_fit(spark, tmp_path, name):
    lake = Lake(str(tmp_path))
    place(lake, "products", DAY, 1)
    with open(f"{lake.raw}/products/ingest_date={DAY}/{name}", "w") as f:
        f.write("[]")
    with pytest.raises(ValueError, match=name):
        LG.follow_objects(spark, lake.raw, "products", jobs.ledger(lake))
    assert LG.entries(spark, jobs.ledger(lake)).count() == 0
