"""Restructured aggregations against the direct formula, on data where one key holds a third."""

import random
from decimal import Decimal

import pytest
from compare import rows
from pyspark.sql import functions as F

from tidemark.plans import gold as G

DAYS = [f"2024-03-{n:02d}" for n in range(1, 9)]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(11)
    hot = lambda n: 0 if rng.random() < 0.34 else rng.randrange(n)
    products = [(p, d, Decimal(rng.randrange(100, 9000)) / 100, "abc"[(p + i) % 3], "ABC"[(p + i) % 3],
                 rng.choice([None, 3.5, 4.0]))
                for p in range(20) for i, d in enumerate(DAYS) if rng.random() < 0.8]
    lines = [(f"o{n // 3}", DAYS[hot(8)], hot(15), hot(20), rng.randint(1, 5)) for n in range(1500)]
    customers = [(c, d, f"city{(c + i) % 4}") for c in range(14) for i, d in enumerate(DAYS) if rng.random() < 0.9]
    made = {
        "products": spark.createDataFrame(products, "product_id int, snapshot_date string, unit_price decimal(10,2),"
                                          " category_slug string, category_label string, rating_score double"),
        "lines": spark.createDataFrame(lines, "order_id string, order_date string, customer_id int,"
                                       " product_id int, quantity int"),
        "customers": spark.createDataFrame(customers, "customer_id int, snapshot_date string, city string"),
    }
    for name, day in (("products", "snapshot_date"), ("lines", "order_date"), ("customers", "snapshot_date")):
        made[name] = made[name].withColumn(day, F.col(day).cast("date"))
        made[name].createOrReplaceTempView(f"skew_{name}")
    return made


JOINED = """
    SELECT o.*, p.unit_price, coalesce(p.category_slug, 'inconnu') AS slug, p.category_slug, p.category_label,
           p.product_id IS NULL AS lost, c.city, o.quantity * p.unit_price AS value
    FROM skew_lines o
    LEFT JOIN skew_products p ON p.product_id = o.product_id AND p.snapshot_date = o.order_date
    LEFT JOIN skew_customers c ON c.customer_id = o.customer_id AND c.snapshot_date = o.order_date"""

MEASURES = """count(DISTINCT order_id), count(*), sum(quantity), count(DISTINCT customer_id),
    count(DISTINCT product_id), count(DISTINCT city), cast(sum(value) AS decimal(20,2)),
    cast(round(sum(unit_price) / count(unit_price), 2) AS decimal(10,2)), count_if(lost)"""

COLUMNS = ["order_date", "category_slug", "nb_orders", "nb_order_lines", "nb_items_sold",
           "nb_active_customers", "nb_distinct_products", "nb_cities", "revenue", "avg_unit_price",
           "nb_unmatched_lines"]


@pytest.mark.parametrize("salts", [1, 4])
def test_sales_totals_equal_the_direct_formula(spark, tables, salts):
    expected = spark.sql(f"""
        WITH j AS ({JOINED})
        SELECT order_date, slug, {MEASURES} FROM j GROUP BY order_date, slug
        UNION ALL SELECT order_date, 'TOTAL', {MEASURES} FROM j GROUP BY order_date""")
    found = G.sales_totals(tables["lines"], tables["products"], tables["customers"], salts=salts)
    assert rows(found.select(*COLUMNS)) == rows(expected)


def test_customer_totals_equal_the_direct_formula(spark, tables):
    expected = spark.sql(f"""
        WITH j AS ({JOINED}),
        liked AS (SELECT customer_id, category_label, row_number() OVER (
                      PARTITION BY customer_id ORDER BY sum(value) DESC, category_label) AS rn
                  FROM j WHERE category_label IS NOT NULL GROUP BY 1, 2),
        sums AS (SELECT customer_id, count(DISTINCT order_id), count(*), sum(quantity),
                        count(DISTINCT product_id), count(DISTINCT category_slug),
                        cast(sum(value) AS decimal(20,2)), min(order_date), max(order_date),
                        count(DISTINCT trunc(order_date, 'month')) FROM j GROUP BY customer_id)
        SELECT s.*, l.category_label FROM sums s LEFT JOIN liked l ON l.customer_id = s.customer_id AND rn = 1""")
    found = G.customer_totals(tables["lines"], tables["products"]).select(
        "customer_id", "nb_orders", "nb_order_lines", "nb_items", "nb_distinct_products",
        "nb_distinct_categories", "lifetime_value", "first_order_date", "last_order_date",
        "nb_active_months", "favorite_category",
    )
    assert rows(found) == rows(expected)


def test_favorite_category_helper_agrees(spark, tables):
    totals = G.customer_totals(tables["lines"], tables["products"]).where("favorite_category IS NOT NULL")
    helper = G.favorite_category(G.category_value(tables["lines"], tables["products"]))
    assert rows(helper.select("customer_id", "favorite_category")) == rows(
        totals.select("customer_id", "favorite_category"))
