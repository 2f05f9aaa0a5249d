"""Batch jobs over a lake: `python -m tidemark.jobs <job> --lake <root> [options]`."""

from __future__ import annotations

import argparse
import sys
import time
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import constants as K
from .config import Lake, Settings
from .constants import BRONZE_TABLES, DOMAINS, GOLD_TABLES, SILVER_TABLES
from .operators import coverage, missing_domains, pending
from .operators import quality as Q
from .plans import bronze as B
from .plans.analytics import publish_views
from .plans import gold as G
from .plans import silver as S
from .session import build_session, drop_scratch, materialise
from .sources import ledger as LG
from .sources import raw as R
from .sources import tables as T
from .streaming import landing as L

MODES = ("incremental", "full", "explicit")


def ledger(lake: Lake) -> str:
    return f"{lake.root}/_ledger"


def landed_days(spark: SparkSession, lake: Lake, *domains: str) -> DataFrame:
    """domain, day, origin and stamp (newest call instant and number of objects) of all that was landed.

    The ledger is brought up to date first; names that do not fit their folder stop the run.
    """
    LG.follow_landed(spark, lake.raw, ledger(lake))
    for domain in domains:
        LG.follow_objects(spark, lake.raw, domain, ledger(lake))
    found = LG.entries(spark, ledger(lake)).where(F.col("domain").isin(*domains))
    return materialise(found.select(
        "domain", F.col("ingest_date").alias("_ingest_date"), "origin", F.struct("newest", "n_objects").alias("_stamp")),
        "landed-days")


def _listed(days: DataFrame) -> list[str]:
    """Days as text: one short row per partition to process, needed to prune the scan."""
    return [str(row[0]) for row in days.collect()]


def _raw_rows(spark: SparkSession, lake: Lake, domain: str, days: list[str], landed: DataFrame) -> DataFrame:
    """Records of the days, from the origins that have them; listed days nobody has are asked for
    as objects, so that an explicit wrong day fails."""
    have = {(r["origin"], str(r["_ingest_date"]))
            for r in landed.select("origin", "_ingest_date").distinct().where(
                F.col("_ingest_date").isin([F.lit(d).cast("date") for d in days])).collect()}
    flowed = [d for d in days if ("landed", d) in have]
    named = [d for d in days if ("object", d) in have or ("landed", d) not in have]
    parts = []
    if named:
        parts.append(R.read_raw(spark, R.input_paths(lake.raw, domain, named), domain))
    if flowed:
        root = R.landed_root(lake.raw, domain)
        parts.append(R.read_landed(spark, [f"{root}/ingest_date={d}" for d in flowed], domain))
    return reduce(DataFrame.unionByName, parts)


def run_bronze(
    spark: SparkSession, lake: Lake, domain: str, mode: str = "incremental",
    dates: Sequence[str] = (), limit: int | None = None,
) -> dict:
    """Lands the pending days of a domain and returns the counts seen while writing."""
    landed = landed_days(spark, lake, domain)
    table = BRONZE_TABLES[domain]
    seen_before = _done_days(spark, lake.path("bronze", f"_processed/{table}"), _BRONZE_DONE)
    per_day = landed.groupBy("_ingest_date").agg(F.struct(
        F.max("_stamp.newest").alias("newest"), F.sum("_stamp.n_objects").alias("n_objects")).alias("_stamp"))
    days = _listed(pending(per_day, seen_before, "_ingest_date", mode, dates, limit, "_stamp"))
    if not days:
        return {"days": []}
    rows = _raw_rows(spark, lake, domain, days, landed)
    batch = f"bronze-{domain}-{uuid.uuid4().hex[:12]}"
    ready, seen = B.observed(B.dated_or_fail(B.bronze(rows, domain, batch)), domain)
    T.overwrite_partitions(ready, lake.path("bronze", table), ["_ingest_date"], ["id"])
    (per_day.where(F.col("_ingest_date").isin([F.lit(d).cast("date") for d in days])).coalesce(1)
     .write.mode("append").parquet(lake.path("bronze", f"_processed/{table}")))
    return {"days": days, **seen.get}


#: Days that Bronze has taken in, with what was landed then.
_BRONZE_DONE = "_ingest_date date, _stamp struct<newest: timestamp, n_objects: bigint>"


def _done_days(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    return spark.read.schema(schema).parquet(path) if R.present(spark, path) else None


def _processed(lake: Lake, table: str) -> str:
    """The small table of processed days: day, and the newest landing it has seen."""
    return lake.path("silver", f"_processed/{table}")


def _silver_days(
    spark: SparkSession, lake: Lake, table: str, source: DataFrame, mode: str, dates: Sequence[str],
    limit: int | None,
) -> list[str]:
    """Days not processed yet, or landed again since; a day without results counts as processed."""
    done = _done_days(spark, _processed(lake, table), "_ingest_date date, _bronze_ts timestamp")
    return _listed(pending(source, done, "_ingest_date", mode, dates, limit, "_bronze_ts"))


def run_silver(
    spark: SparkSession, lake: Lake, domain: str, settings: Settings, mode: str = "incremental",
    dates: Sequence[str] = (), limit: int | None = None, end_date: str | None = None,
) -> list[str]:
    """Conforms the pending days of a domain and returns them.

    `end_date` fixes the history anchor; without it the newest landed day is the anchor.
    """
    source = lake.find(spark, "bronze", BRONZE_TABLES[domain])
    if source is None:
        return []
    table = SILVER_TABLES[domain]
    day = "order_date" if domain == "carts" else "snapshot_date"
    days = _silver_days(spark, lake, table, source, mode, dates, limit)
    if not days:
        return []
    wanted = source.where(F.col("_ingest_date").isin([F.lit(d).cast("date") for d in days]))
    seen = materialise(wanted.groupBy("_ingest_date").agg(
        F.max("_bronze_ts").alias("_bronze_ts"), F.bool_or("_is_valid").alias("valid")), "days-seen")
    model = {"reconstruct": settings.reconstruct, "seed": settings.seed}
    if domain == "products":
        newest = source.agg(F.max("_ingest_date").alias("d")).select("d").scalar()
        anchor = F.lit(end_date).cast("date") if end_date else newest
        rows = S.dim_products(source, anchor, days, days=settings.history_days, **model)
        order = ["product_id"]
    elif domain == "users":
        rows, order = S.dim_customers(source, days), ["customer_id"]
    else:
        known = lake.read(spark, "silver", SILVER_TABLES["users"])
        buyers = known.select("customer_id").distinct().agg(F.count("*").alias("n")).select("n").scalar()
        rows, order = S.fct_order_items(source, buyers, days, **model), ["customer_id", "order_id"]
    T.overwrite_partitions(rows, lake.path("silver", table), [day], order)
    # A day whose records are all invalid by now has no rows to put in place of its old ones.
    T.drop_days(spark, lake.path("silver", table), day, _listed(seen.where("NOT valid").select("_ingest_date")))
    seen.drop("valid").coalesce(1).write.mode("append").parquet(_processed(lake, table))
    return days


# What the landing job reads, one JSON line per response.
RESPONSE_FIELDS = "domain STRING, snapshot_date STRING, ts TIMESTAMP, status INT, mime STRING, body STRING, attempts INT"


def run_landing(spark: SparkSession, lake: Lake, source: str, recall=None) -> None:
    """Lands all responses that have come into `source` since the last run. Refused ones wait in `_retry`; each run
    tries them again until they are accepted, their day is landed otherwise, or they are dead letters."""
    responses = L.read_stream(spark, source, RESPONSE_FIELDS)
    accepted = L.is_conforming(F.col("status"), F.length("body"), F.col("mime"))
    LG.follow_landed(spark, lake.raw, ledger(lake))
    settled = materialise(LG.entries(spark, ledger(lake)).where("origin = 'landed'").select(
        "domain", F.col("ingest_date").cast("string").alias("snapshot_date")).distinct(), "settled")
    for query in L.land(
        responses, accepted, ["domain", "snapshot_date"], "ts", f"{lake.raw}/landed", f"{lake.root}/_dead_letter",
        f"{lake.root}/_checkpoints/landing", retry_path=f"{lake.root}/_retry", recall=recall, settled=settled,
    ):
        query.awaitTermination()


def run_wait(
    spark: SparkSession, lake: Lake, source: str, day: str, timeout: float, poll: float,
    required: Sequence[str] = K.MANDATORY_DOMAINS, clock=time.monotonic, sleep=time.sleep,
) -> list[str]:
    """Lands in rounds until every required domain has an object on the day, or the time is over; returns the
    domains that are still missing. A round reads only what has come since the last one."""
    deadline = clock() + timeout
    wanted = spark.createDataFrame([(day,)], "d string").select(F.col("d").cast("date").alias("_ingest_date"))
    while True:
        if R.present(spark, source):
            run_landing(spark, lake, source)
        landed = landed_days(spark, lake, *DOMAINS)
        # At most one row a required domain.
        lacking = sorted(r["domain"] for r in
                         missing_domains(landed, "domain", "_ingest_date", required, wanted).collect())
        if not lacking or clock() + poll > deadline:
            return lacking
        sleep(poll)


def run_views(spark: SparkSession, lake: Lake, sql: str, limit: int) -> None:
    """Publishes the report views over the Gold tables and shows a query on them."""
    publish_views(lake.read(spark, "gold", GOLD_TABLES["sales_daily"]), lake.read(spark, "gold", GOLD_TABLES["customer_360"]))
    spark.sql(sql).show(limit, truncate=False)


#: Stored parts of the analytics tables, each replaced by day.
PARTS = ("sales_totals", "customer_orders", "customer_value")


def _changed_days(spark: SparkSession, lake: Lake) -> tuple[dict[str, str], list[str], list[str]]:
    """Folder times of all order days, those that differ from the times seen last, and days that are gone.

    A day depends on its orders, its product prices and its customers, so on three folders. Days are folder names.
    """
    folders = [LG.day_folders(spark, lake.path("silver", SILVER_TABLES[d]), day)
               for d, day in (("carts", "order_date"), ("products", "snapshot_date"), ("users", "snapshot_date"))]
    now = {day: " ".join(str(f.get(day)) for f in folders) for day in folders[0]}
    place = f"{lake.root}/gold/_parts/_seen"
    # One row a day.
    seen = ({r["day"]: r["times"] for r in spark.read.schema("day string, times string").parquet(place).collect()}
            if R.present(spark, place) else {})
    return now, sorted(d for d in now if seen.get(d) != now[d]), sorted(set(seen) - set(now))


def refresh_parts(
    spark: SparkSession, lake: Lake, lines: DataFrame, products: DataFrame, customers: DataFrame, full: bool = False,
) -> list[str]:
    """Brings the stored parts up to date: only days whose orders, prices or customers have been written since are read,
    and their parts replaced. Returns those days."""
    now, changed, gone = _changed_days(spark, lake)
    days = sorted(now) if full else changed
    if days:
        wanted = [F.lit(d).cast("date") for d in days]
        lines = lines.where(F.col("order_date").isin(wanted))
        products, customers = (df.where(F.col("snapshot_date").isin(wanted)) for df in (products, customers))
        made = (G.sales_totals(lines, products, customers), *G.customer_parts(lines, products))
        for name, part in zip(PARTS, made):
            T.overwrite_partitions(part, f"{lake.root}/gold/_parts/{name}", ["order_date"])
    for name in PARTS:
        T.drop_days(spark, f"{lake.root}/gold/_parts/{name}", "order_date", gone)
    if days or gone:
        T.replace_table(spark.createDataFrame(list(now.items()), "day string, times string"),
                        f"{lake.root}/gold/_parts/_seen")
    return days


def run_gold(spark: SparkSession, lake: Lake, full: bool = False) -> list[str]:
    """Writes the four analytics tables; sales and customers from stored parts, of which only changed days are made
    anew (all with `full`)."""
    products = lake.read(spark, "silver", SILVER_TABLES["products"])
    customers = lake.read(spark, "silver", SILVER_TABLES["users"])
    lines = lake.read(spark, "silver", SILVER_TABLES["carts"])
    profile = customers.select(
        "customer_id", "full_name", "email_masked", "email_domain", "city", "zip_code", "latitude",
        "longitude", "has_complete_address", "snapshot_date",
    )
    trend = products.select(
        "product_id", "snapshot_date", "title", "category_slug", "category_label", "price_band",
        "unit_price", "unit_price_observed", "rating_score", "review_count", "is_reconstructed",
    )
    refresh_parts(spark, lake, lines, products, customers, full)
    totals, orders, value = (spark.read.parquet(f"{lake.root}/gold/_parts/{name}") for name in PARTS)
    newest = orders.agg(F.max("order_date").alias("newest")).select("newest").scalar()
    base = materialise(G.with_profile(profile, G.totals_of_parts(orders, value), newest), "customer-base")
    built = {
        "catalog_kpi": (G.catalog_kpi(products), ["snapshot_date", "category_slug"]),
        "price_trend": (G.price_trend(trend), ["product_id", "snapshot_date"]),
        "sales_daily": (G.sales_series(totals), ["order_date", "category_slug"]),
        "customer_360": (G.rfm(base, "customer_id"), ["customer_id"]),
    }
    for name, (frame, order) in built.items():
        stamped = frame.withColumn("gold_ts", F.current_timestamp())
        T.replace_table(stamped, lake.path("gold", GOLD_TABLES[name]), (), order)
    return [GOLD_TABLES[name] for name in built]


def raw_checks(spark: SparkSession, lake: Lake, expected_days: int) -> list[DataFrame]:
    """Coverage of the window that ends on the newest landed day, and that day's mandatory domains.

    A domain without any object scores 0.
    """
    landed = materialise(landed_days(spark, lake, *DOMAINS).select("domain", "_ingest_date").distinct(), "landed-days")
    newest = landed.agg(F.max("_ingest_date").alias("d")).select("d")
    window = newest.where("d IS NOT NULL").select(
        F.explode(F.sequence(F.date_sub("d", expected_days - 1), "d")).alias("_ingest_date"))
    rates = coverage(landed, window, "domain", "_ingest_date", DOMAINS)
    last = newest.where("d IS NOT NULL").select(F.col("d").alias("_ingest_date"))
    lacking = missing_domains(landed, "domain", "_ingest_date", K.MANDATORY_DOMAINS, last)
    return [Q.coverage_check(rates, "raw.coverage"),
            Q.total_check(lacking.agg(F.count("*").alias("n")), "raw.mandatory_domains", Q.HARD, F.col("n"),
                          "mandatory domain(s) without an object on the newest day")]


def quality_report(spark: SparkSession, lake: Lake, expected_days: int) -> DataFrame:
    """All rules of the lake; a table that is missing or empty fails its rules."""
    parts = raw_checks(spark, lake, expected_days)

    def check(layer: str, table: str, rules) -> None:
        found = lake.find(spark, layer, table)
        parts.append(Q.absent(spark, f"{layer}.{table}.exists") if found is None else rules(found))

    for domain, table in BRONZE_TABLES.items():
        check("bronze", table, lambda df, d=domain: Q.row_checks(df, non_empty=f"bronze.{d}.not_empty"))
    grains = {
        "products": ["product_id", "snapshot_date"], "users": ["customer_id", "snapshot_date"],
        "carts": ["order_line_id"],
    }
    for domain, keys in grains.items():
        table = SILVER_TABLES[domain]
        check("silver", table, lambda df, t=table, k=keys: Q.report(
            Q.grain_check(df, f"{t}.unique_grain", k), Q.row_checks(df, non_empty=f"silver.{t}.not_empty")))
    check("silver", SILVER_TABLES["products"], lambda df: Q.row_checks(df, [
        Q.Violation("silver.products.price_positive", Q.HARD, F.col("unit_price") <= 0, "price(s) <= 0"),
        Q.Violation("silver.products.complete", Q.SOFT, ~F.coalesce("is_complete", F.lit(False)),
                    "incomplete record(s)"),
    ], depth=("history.depth", "snapshot_date", expected_days)))
    for table in GOLD_TABLES.values():
        check("gold", table, lambda df, t=table: Q.row_checks(df, non_empty=f"gold.{t}.not_empty"))
    sales = lake.find(spark, "gold", GOLD_TABLES["sales_daily"])
    customers = lake.find(spark, "gold", GOLD_TABLES["customer_360"])
    if sales is not None:
        totals = sales.where(F.col("category_slug") == G.K.TOTAL_SLUG)
        unmatched = totals.agg(F.coalesce(F.sum("nb_unmatched_lines"), F.lit(0)).alias("n"))
        parts.append(Q.total_check(
            unmatched, "gold.sales.matched", Q.HARD, F.col("n"), "line(s) without a product that day"))
        parts.append(Q.row_checks(sales, [
            Q.Violation("gold.sales.revenue_positive", Q.HARD, F.col("revenue") < 0, "day(s) below zero")]))
        if customers is not None:
            parts.append(Q.reconcile(
                "gold.reconciliation", totals, F.sum("revenue"), customers, F.sum("lifetime_value")))
    return Q.report(*parts)


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidemark.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("bronze", "silver"):
        job = jobs.add_parser(name)
        job.add_argument("--domain", choices=DOMAINS, required=True)
        job.add_argument("--mode", choices=MODES, default="incremental")
        job.add_argument("--dates", default="", help="comma-separated days, implies explicit mode")
        job.add_argument("--max-partitions", type=int, default=0)
        if name == "silver":
            job.add_argument("--end-date", default="")
    gold = jobs.add_parser("gold")
    gold.add_argument("--full", action="store_true", help="make the parts of all days anew")
    quality = jobs.add_parser("quality")
    quality.add_argument("--expected-days", type=int, default=0)
    compact = jobs.add_parser("compact")
    compact.add_argument("--layer", required=True)
    compact.add_argument("--table", required=True)
    compact.add_argument("--partition-by", default="")
    compact.add_argument("--target-file-size-mb", type=int, default=64)
    waiting = jobs.add_parser("wait", help="lands until every mandatory domain has the day; exit code 2 at the deadline")
    waiting.add_argument("--source", required=True, help="folder of JSON response lines")
    waiting.add_argument("--day", required=True)
    waiting.add_argument("--timeout-seconds", type=float, default=3600)
    waiting.add_argument("--poll-seconds", type=float, default=60)
    landing = jobs.add_parser("land")
    landing.add_argument("--source", required=True, help="folder of JSON response lines")
    views = jobs.add_parser("views")
    views.add_argument("--sql", default="SELECT * FROM v_monthly_summary ORDER BY year, month, category_label")
    views.add_argument("--limit", type=int, default=20)
    expire = jobs.add_parser("expire")
    expire.add_argument("--layer", required=True)
    expire.add_argument("--table", required=True)
    expire.add_argument("--day", default="snapshot_date", help="partition column")
    expire.add_argument("--retain-days", type=int, default=K.RETAIN_DAYS)
    expire.add_argument("--retain-last", type=int, default=K.RETAIN_LAST)
    for job in jobs.choices.values():
        job.add_argument("--lake", required=True, help="root folder of the lake")
        job.add_argument("--history-months", type=int, default=Settings.history_months)
        job.add_argument("--history-seed", type=int, default=Settings.seed)
        job.add_argument("--no-history", action="store_true", help="measures as observed, nothing reconstructed")
        job.add_argument("--shuffle-partitions", type=int, default=0,
                         help="about the bytes of the largest shuffle divided by 200 MB")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    lake = Lake(args.lake.rstrip("/"))
    settings = Settings(args.history_months, not args.no_history, args.history_seed)
    if args.job in {"bronze", "silver"}:
        dates = [d.strip() for d in args.dates.split(",") if d.strip()]
        mode = "explicit" if dates else args.mode
        limit = args.max_partitions or None
        if args.job == "bronze":
            print(run_bronze(spark, lake, args.domain, mode, dates, limit))
        else:
            print(run_silver(
                spark, lake, args.domain, settings, mode, dates, limit, args.end_date or None))
    elif args.job == "gold":
        print(run_gold(spark, lake, args.full))
    elif args.job == "compact":
        keys = [k for k in args.partition_by.split(",") if k]
        target = args.target_file_size_mb * 1024 * 1024
        print(T.compact(spark, lake.path(args.layer, args.table), keys, target_bytes=target))
    elif args.job == "land":
        run_landing(spark, lake, args.source)
    elif args.job == "wait":
        lacking = run_wait(spark, lake, args.source, args.day, args.timeout_seconds, args.poll_seconds)
        print(lacking)
        return 2 if lacking else 0
    elif args.job == "views":
        run_views(spark, lake, args.sql, args.limit)
    elif args.job == "expire":
        print(T.expire(spark, lake.path(args.layer, args.table), args.day, args.retain_days, args.retain_last))
    else:
        checks = quality_report(spark, lake, args.expected_days or settings.history_days)
        found = checks.collect()  # one row per rule
        for row in found:
            print(f"[{'ok' if row['passed'] else row['severity']}] {row['name']}: {row['detail']}")
        return int(any(not r["passed"] and r["severity"] == Q.HARD for r in found))
    return 0


def main(argv: Sequence[str] | None = None) -> int:
    args = _arguments(argv)
    spark = build_session(
        f"tidemark-{args.job}", shuffle_partitions=args.shuffle_partitions or None
    )
    try:
        return run(spark, args)
    finally:
        drop_scratch(spark)
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
