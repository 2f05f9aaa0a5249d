"""Operators against brute force and on edge rows."""

import datetime as dt
import random

import pytest
from compare import rows
from pyspark.sql import functions as F

from tidemark.operators import quality as Q
from tidemark.operators import (
    as_of, calendar_fill, coverage, day_range, dedup_latest, explode_lines, flatten, history_window, lagged,
    latest_state, merge_schema, missing_days, missing_domains, moving, moving_days,
    ntile_distributed, ntile_scores, pending, replicate_and_thin, retention, running_in_month,
    salted_left_join, sessions, silences, snapshot_history, temporal_snapshot_join, top1_by,
    version_diff, with_total,
)

D = dt.date


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_each_key_before_the_shuffle(spark):
    data = [(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (2, None, "d")]
    df = dedup_latest(
        spark.createDataFrame(data, "id int, ts int, src string"), ["id"],
        [F.col("ts").desc(), F.col("src").desc()],
    )
    assert rows(df) == [(1, 7, "c"), (2, None, "d")]
    text = plan(df)
    assert "Partial" in text[text.index("Exchange"):]


def test_latest_state_and_as_of(spark):
    df = spark.createDataFrame(
        [("a", D(2024, 1, 1), 1), ("a", D(2024, 1, 3), 2), ("b", D(2024, 1, 2), 3)],
        "k string, d date, v int",
    )
    assert [r[2] for r in rows(latest_state(df, "k", "d"))] == [2, 3]
    assert rows(as_of(df, "k", "d", "2024-01-02")) == [("a", D(2024, 1, 1), 1), ("b", D(2024, 1, 2), 3)]


def test_top1_breaks_ties_by_label(spark):
    df = spark.createDataFrame(
        [(1, "z", 5), (1, "b", 3), (1, "b", 2), (2, None, 9), (2, "q", 1)], "k int, c string, v int"
    )
    assert rows(top1_by(df, ["k"], "c", F.col("v"))) == [(1, "b", 5), (2, "q", 1)]


def test_temporal_join_keeps_and_flags_unmatched(spark):
    facts = spark.createDataFrame(
        [(1, D(2024, 1, 1), 2), (1, D(2024, 1, 2), 3), (9, D(2024, 1, 1), 1)],
        "product_id int, order_date date, quantity int",
    )
    dim = spark.createDataFrame([(1, D(2024, 1, 1), 10)], "product_id int, snapshot_date date, price int")
    found = temporal_snapshot_join(facts, dim, "product_id", "order_date", "snapshot_date")
    assert [(r["quantity"], r["price"], r["is_unmatched"]) for r in found.orderBy("quantity").collect()] == [
        (1, None, True), (2, 10, False), (3, None, True)
    ]


@pytest.mark.parametrize("salts", [1, 5])
def test_salted_join_equals_plain_join_on_a_hot_key(spark, salts):
    left = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("k"), F.col("id").alias("v")
    )
    right = spark.createDataFrame([(0, "zero"), (1, "one"), (2, "two")], "k long, name string")
    expected = rows(left.join(right, "k", "left").select("k", "v", "name"))
    assert rows(salted_left_join(left, right, ["k"], salts, ["v"]).select("k", "v", "name")) == expected


def test_with_total_separates_a_null_category_from_the_total(spark):
    df = spark.createDataFrame(
        [(D(2024, 1, 1), "a", 1), (D(2024, 1, 1), None, 2), (D(2024, 1, 2), "a", 4)], "d date, c string, v int"
    )
    found = with_total(df, "d", "c", [F.sum("v").alias("v")])
    assert rows(found) == sorted([
        (D(2024, 1, 1), "a", 1), (D(2024, 1, 1), None, 2), (D(2024, 1, 1), "TOTAL", 3),
        (D(2024, 1, 2), "a", 4), (D(2024, 1, 2), "TOTAL", 4),
    ], key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_calendar_fill_against_brute_force(spark):
    rng = random.Random(3)
    days = [D(2024, 1, 1) + dt.timedelta(n) for n in range(30)]
    present = {(rng.choice("abc"), rng.choice(days[4:25])): rng.randint(1, 9) for _ in range(25)}
    df = spark.createDataFrame(
        [(c, d, c.upper(), v, v) for (c, d), v in present.items()],
        "c string, d date, label string, v long, raw long",
    )
    low, high = (F.lit(str(d)).cast("date") for d in (days[0], days[-1]))
    found = calendar_fill(df, "d", "c", (low, high), {"v": F.lit(0)}, ["label"])
    expected = [
        (c, d, c.upper(), present.get((c, d), 0), present.get((c, d)))
        for c in sorted({c for c, _ in present}) for d in days
    ]
    assert rows(found) == sorted(expected, key=lambda r: tuple((v is not None, str(v)) for v in r))
    assert "CartesianProduct" not in plan(found) and "NestedLoop" not in plan(found)


def test_label_drift_gives_one_label_per_category(spark):
    df = spark.createDataFrame(
        [("a", D(2024, 1, 1), "Old", 1), ("a", D(2024, 1, 3), "New", 2)], "c string, d date, label string, v int"
    )
    low, high = F.lit("2024-01-01").cast("date"), F.lit("2024-01-03").cast("date")
    found = rows(calendar_fill(df, "d", "c", (low, high), {"v": F.lit(0)}, ["label"]))
    assert [(r[2], r[3]) for r in found] == [("Old", 1), ("Old", 0), ("Old", 2)]


def test_windows_on_rows_and_on_days(spark):
    data = [("a", D(2024, 1, 1), 1.0), ("a", D(2024, 1, 2), 2.0), ("a", D(2024, 1, 9), 6.0), ("a", D(2024, 2, 1), 8.0)]
    df = spark.createDataFrame(data, "k string, d date, v double")
    found = df.select(
        "d", moving("v", "k", "d", 2), moving_days("v", "k", "d", 3), running_in_month("v", "k", "d"),
        lagged("v", "k", "d"),
    ).orderBy("d").collect()
    assert [tuple(r)[1:] for r in found] == [
        (1.0, 1.0, 1.0, None), (1.5, 1.5, 3.0, 1.0), (4.0, 6.0, 9.0, 2.0), (7.0, 8.0, 8.0, 6.0)
    ]


@pytest.mark.parametrize("n, size, descending", [(4, 1501, False), (4, 1501, True), (10, 7, False), (3, 3, True), (1, 5, False)])
def test_ntile_equals_the_global_window(spark, n, size, descending):
    rng = random.Random(n * size)
    # A third of the rows share one value and some have none.
    data = [(i, None if rng.random() < 0.1 else 5 if rng.random() < 0.33 else rng.randint(-50, 50)) for i in range(size)]
    df = spark.createDataFrame(data, "id long, v int").repartition(4)
    order = "v DESC" if descending else "v"
    df.createOrReplaceTempView("ranked")
    expected = rows(spark.sql(f"SELECT id, v, ntile({n}) OVER (ORDER BY {order}, id) AS tile FROM ranked"))
    assert rows(ntile_distributed(df, n, F.col("v"), "id", descending)) == expected


def test_ntile_on_text_ids_and_several_rankings(spark):
    data = [(f"c{i:03d}", i % 7, 100 - i) for i in range(103)]
    df = spark.createDataFrame(data, "id string, a int, b int")
    df.createOrReplaceTempView("several")
    expected = rows(spark.sql(
        "SELECT *, ntile(4) OVER (ORDER BY a DESC, id) AS x, ntile(4) OVER (ORDER BY b, id) AS y FROM several"
    ))
    assert rows(ntile_scores(df, "id", {"x": (F.col("a"), True), "y": (F.col("b"), False)}, 4)) == expected


@pytest.mark.parametrize("n,size", [(1001, 5003), (2000, 500), (100_000, 3000), (1500, 3000)])
def test_many_tiles_are_joined_back(spark, n, size):
    df = spark.range(size).selectExpr("id", "IF(id % 11 = 0, NULL, id * 7 % 31) AS v")
    df.createOrReplaceTempView("many")
    expected = rows(spark.sql(f"SELECT id, v, ntile({n}) OVER (ORDER BY v DESC, id) AS tile FROM many"))
    found = ntile_distributed(df, n, F.col("v"), "id", True)
    assert rows(found) == expected and dict(found.dtypes)["tile"] == "int"


def test_ntile_of_nothing(spark):
    df = spark.createDataFrame([], "id long, v int")
    assert ntile_distributed(df, 4, F.col("v"), "id").count() == 0


def test_flatten_and_explode(spark):
    schema = "id int, name struct<first: string, geo: struct<lat: string>>, items array<struct<p: int, q: int>>"
    df = spark.createDataFrame([(1, ("a", ("1.5",)), [(7, 2), (8, 1)]), (2, None, [])], schema)
    assert flatten(df).columns == ["id", "name_first", "name_geo_lat", "items"]
    assert rows(explode_lines(flatten(df).drop("name_first", "name_geo_lat"), "items")) == [(1, 7, 2), (1, 8, 1)]


def test_replicate_and_thin(spark):
    df = spark.range(4)
    assert replicate_and_thin(df, 3, F.lit(0.1), F.lit(0.5)).count() == 12
    assert replicate_and_thin(df, 3, F.lit(0.6), F.lit(0.5)).count() == 0


def test_pending_modes(spark):
    day = "d date, at int"
    up = spark.createDataFrame([(D(2024, 1, n), n) for n in (1, 2, 3, 4)] + [(None, 0)], day)
    done = spark.createDataFrame([(D(2024, 1, 1), 1), (D(2024, 1, 3), 2)], day)
    days = lambda df: [r[0].day for r in df.collect()]
    assert days(pending(up, done, "d")) == [2, 4]
    assert days(pending(up, done, "d", limit=1)) == [2]
    assert days(pending(up, None, "d")) == [1, 2, 3, 4]
    assert days(pending(up, done, "d", "full")) == [1, 2, 3, 4]
    assert days(pending(up, done, "d", "explicit", explicit=["2024-01-03", "2030-01-01"])) == [3]
    # Day 3 was landed again after it was processed.
    assert days(pending(up, done, "d", stamp="at")) == [2, 3, 4]
    with pytest.raises(ValueError):
        pending(up, done, "d", "sometimes")


def test_coverage_and_missing(spark):
    calendar = day_range(spark, "2024-01-01", "2024-01-04", "d")
    landed = spark.createDataFrame(
        [("p", D(2024, 1, n)) for n in (1, 2, 2, 4)] + [("u", D(2024, 1, 1)), ("u", D(2023, 1, 1))],
        "domain string, d date",
    )
    found = {r["domain"]: (r["n_landed"], r["n_expected"], float(r["coverage_rate"]))
             for r in coverage(landed, calendar, "domain", "d").collect()}
    assert found == {"p": (3, 4, 0.75), "u": (1, 4, 0.25)}
    assert rows(missing_days(landed, calendar, "domain", "d")) == [
        ("p", D(2024, 1, 3)), ("u", D(2024, 1, 2)), ("u", D(2024, 1, 3)), ("u", D(2024, 1, 4))
    ]
    check = Q.coverage_check(coverage(landed, calendar, "domain", "d"), "landed").first()
    assert (check["passed"], check["detail"]) == (False, "lowest coverage 0.2500")
    assert Q.coverage_check(coverage(landed, calendar, "domain", "d"), "landed", 0.25).first()["passed"]
    required = coverage(landed, calendar, "domain", "d", ["p", "carts"])
    assert rows(required.select("domain", "n_landed")) == [("carts", 0), ("p", 3)]
    outside = coverage(landed.where("d < '2024-01-01'"), calendar, "domain", "d")
    assert rows(outside.select("domain", "n_landed")) == [("u", 0)]
    assert not Q.coverage_check(coverage(landed.limit(0), calendar, "domain", "d"), "landed").first()["passed"]
    window = history_window(spark, "2024-06-30").agg(F.min("date_key"), F.count("*")).first()
    assert tuple(window) == (D(2024, 1, 3), 180)
    last = calendar.where("d = '2024-01-04'")
    assert rows(missing_domains(landed, "domain", "d", ["p", "u", "carts"], last)) == [
        (D(2024, 1, 4), "carts"), (D(2024, 1, 4), "u")
    ]


def _events(seed, size=400):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    return [("hot" if rng.random() < 0.6 else "cold", start + dt.timedelta(seconds=rng.randint(0, 400_000)), 1)
            for _ in range(size)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_silences_and_sessions_against_brute_force(spark, seed):
    data = _events(seed)
    df = spark.createDataFrame(data, "src string, ts timestamp_ntz, v int")
    gap = dt.timedelta(minutes=30)
    quiet, runs = [], {}
    for src in ("hot", "cold"):
        times = sorted(t for s, t, _ in data if s == src)
        quiet += [(src, a, b) for a, b in zip(times, times[1:]) if b - a > gap]
        current = []
        for t in times:
            if current and t - current[-1] >= gap:
                runs.setdefault(src, []).append(current)
                current = []
            current.append(t)
        runs.setdefault(src, []).append(current)
    assert rows(silences(df, "ts", ["src"], "30 minutes")) == sorted(
        quiet, key=lambda r: tuple((True, str(v)) for v in r))
    expected = [(src, i + 1, r[0], r[-1], len(r), len(r)) for src, rs in runs.items() for i, r in enumerate(rs)]
    assert sorted(rows(sessions(df, "ts", ["src"], "30 minutes", "v"))) == sorted(expected)


def test_versions(spark):
    schema = "k int, h string"
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], schema)
    new = spark.createDataFrame([(1, "a"), (2, "x"), (4, "d")], schema)
    assert rows(version_diff(old, new, ["k"], "h")) == [(2, "changed"), (3, "removed"), (4, "added")]
    merged = merge_schema(old, new.withColumn("extra", F.lit(1)))
    assert merged.columns == ["k", "h", "extra"] and merged.where("extra IS NULL").count() == 3


def test_snapshot_history_and_retention(spark):
    data = [("a", D(2024, 1, n)) for n in range(1, 9)] + [("b", D(2023, 1, 1))]
    df = spark.createDataFrame(data, "k string, d date")
    totals = [r["total_records"] for r in snapshot_history(df, ["k"], "d").where("k = 'a'").orderBy("d").collect()]
    assert totals == list(range(1, 9))
    kept = rows(retention(df, ["k"], "d", "2024-01-07", keep_last=3))
    assert kept == [("a", D(2024, 1, 6)), ("a", D(2024, 1, 7)), ("a", D(2024, 1, 8)), ("b", D(2023, 1, 1))]
    kept = retention(df, ["k"], "d", "2024-01-02", keep_last=3)
    assert kept.where("k = 'a'").count() == 7
