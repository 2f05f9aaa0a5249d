"""Analytics tables refreshed from stored parts: only changed days are read, results equal the full build."""

import json
from pathlib import Path

import pytest
from compare import rows
from test_lake import DAYS, cart, land, product, user

from tidemark import jobs
from tidemark.config import Lake, Settings
from tidemark.plans import gold as G


def take(spark, lake):
    for domain in ("products", "users", "carts"):
        jobs.run_bronze(spark, lake, domain)
        jobs.run_silver(spark, lake, domain, Settings())


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("refresh")
    for n, day in enumerate(DAYS):
        land(root, "products", day, [product(i, 10.0 * i + n) for i in range(1, 5)])
        land(root, "users", day, [user(i) for i in range(1, 6)])
        land(root, "carts", day, [cart(10 * n + i, i, [(1 + i % 4, 2), (1 + (i + 1) % 4, 1)]) for i in range(1, 5)])
    lake = Lake(str(root))
    take(spark, lake)
    jobs.run_gold(spark, lake)
    return lake


def tables(spark, lake):
    return {t: rows(lake.read(spark, "gold", jobs.GOLD_TABLES[t]).drop("gold_ts")) for t in ("sales_daily", "customer_360")}


def test_parts_give_what_the_facts_give(spark, built):
    lines, products, users = (built.read(spark, "silver", jobs.SILVER_TABLES[d]) for d in ("carts", "products", "users"))
    direct = G.sales_by_category(lines, products, users)
    assert rows(built.read(spark, "gold", jobs.GOLD_TABLES["sales_daily"]).select(direct.columns)) == rows(direct)
    direct = G.customer_360(users.select(
        "customer_id", "full_name", "email_masked", "email_domain", "city", "zip_code", "latitude",
        "longitude", "has_complete_address", "snapshot_date"), lines, products)
    assert rows(built.read(spark, "gold", jobs.GOLD_TABLES["customer_360"]).select(direct.columns)) == rows(direct)


def test_a_day_written_again_is_the_only_one_read(spark, built, monkeypatch):
    read = []
    plain = G.sales_totals
    monkeypatch.setattr(G, "sales_totals", lambda lines, *a, **k: read.append(
        sorted(str(r[0]) for r in lines.select("order_date").distinct().collect())) or plain(lines, *a, **k))
    jobs.run_gold(spark, built)
    assert read == []
    facts = built.read(spark, "silver", jobs.SILVER_TABLES["carts"])
    day = max(str(r[0]) for r in facts.select("order_date").distinct().collect())
    land(Path(built.root), "carts", day, json.dumps([cart(90, 3, [(2, 7)])]), millis=1709290900000, token="0b-2c")
    jobs.run_bronze(spark, built, "carts")
    jobs.run_silver(spark, built, "carts", Settings())
    jobs.run_gold(spark, built)
    assert read and all(days == [day] for days in read)
    partly = tables(spark, built)
    jobs.run_gold(spark, built, full=True)
    assert tables(spark, built) == partly
