"""Quality rules over the fixture tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..plans import gold as G
from ..session import materialise
from .core import query
from .fixtures import customers, order_lines, product_snapshots, with_fx
from .sales import ALL, PRICED

SNAP = "fx_product_snapshots"


@query(with_fx(SNAP, """
SELECT 'products.price_positive' AS name, 'hard' AS severity, count(*) FILTER (WHERE unit_price <= 0) = 0 AS passed,
       concat(count(*) FILTER (WHERE unit_price <= 0), ' price(s) <= 0') AS detail FROM fx_product_snapshots
UNION ALL
SELECT 'products.few_reviews', 'soft', count(*) FILTER (WHERE review_count < 2) = 0,
       concat(count(*) FILTER (WHERE review_count < 2), ' row(s)') FROM fx_product_snapshots"""))
def value_domain(spark, sf):
    return Q.row_checks(product_snapshots(spark, sf), [
        Q.Violation("products.price_positive", Q.HARD, F.col("unit_price") <= 0, "price(s) <= 0"),
        Q.Violation("products.few_reviews", Q.SOFT, F.col("review_count") < 2),
    ])


EXPECTED_MONTHS = 84


@query(with_fx(SNAP, f"""
SELECT 'history.depth' AS name, 'soft' AS severity, count(DISTINCT snapshot_date) >= {EXPECTED_MONTHS} * 0.9 AS passed,
       concat(count(DISTINCT snapshot_date), ' distinct day(s), about {EXPECTED_MONTHS} expected') AS detail
FROM fx_product_snapshots"""))
def history_depth(spark, sf):
    return Q.row_checks(
        product_snapshots(spark, sf), depth=("history.depth", "snapshot_date", EXPECTED_MONTHS)
    )


def _count(name: str, severity: str, passed: str, count: str, text: str, source: str) -> str:
    return (f"SELECT '{name}' AS name, '{severity}' AS severity, {passed} AS passed, "
            f"concat({count}, '{text}') AS detail FROM {source}")


@query(with_fx(ALL, PRICED + """
, dup AS (SELECT count(*) AS n FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1))
, twice AS (SELECT count(*) AS n FROM (SELECT product_id, snapshot_date FROM fx_product_snapshots GROUP BY 1, 2 HAVING count(*) > 1))
, sides AS (SELECT CAST((SELECT coalesce(sum(v), 0) FROM (SELECT sum(line_revenue) AS v FROM priced GROUP BY order_date)) AS DECIMAL(30,2)) AS a,
                   CAST((SELECT coalesce(sum(v), 0) FROM (SELECT sum(line_revenue) AS v FROM priced GROUP BY customer_id)) AS DECIMAL(30,2)) AS b)
, totals AS (SELECT coalesce(sum(line_revenue), 0) AS total, count(*) FILTER (WHERE is_unmatched) AS unmatched FROM priced)
""" + "\nUNION ALL\n".join([
    _count("products.not_empty", "hard", "count(*) > 0", "count(*)", " row(s)", SNAP),
    _count("customers.not_empty", "hard", "count(*) > 0", "count(*)", " row(s)", "fx_customers"),
    _count("products.grain", "hard", "n = 0", "n", " duplicate key(s) on (product_id, snapshot_date)", "twice"),
    _count("lines.grain", "hard", "n = 0", "n", " duplicate key(s) on (order_id, line_no)", "dup"),
    _count("products.price_positive", "hard", "count(*) FILTER (WHERE unit_price <= 0) = 0",
           "count(*) FILTER (WHERE unit_price <= 0)", " price(s) <= 0", SNAP),
    _count("products.complete", "soft", "count(*) FILTER (WHERE NOT is_complete) = 0",
           "count(*) FILTER (WHERE NOT is_complete)", " incomplete record(s)", SNAP),
    _count("history.depth", "soft", f"count(DISTINCT snapshot_date) >= {EXPECTED_MONTHS} * 0.9",
           "count(DISTINCT snapshot_date)", f" distinct day(s), about {EXPECTED_MONTHS} expected", SNAP),
    _count("sales.matched", "hard", "unmatched = 0", "unmatched", " unmatched line(s)", "totals"),
    _count("sales.revenue_positive", "hard", "count(*) FILTER (WHERE line_revenue < 0) = 0",
           "count(*) FILTER (WHERE line_revenue < 0)", " negative total(s)", "priced"),
    """SELECT 'sales.reconciliation', 'hard', CAST(abs(a - b) AS DOUBLE) <= greatest(1.0, CAST(a AS DOUBLE) * 0.001),
       concat('left=', CAST(a AS VARCHAR), ' right=', CAST(b AS VARCHAR), ' gap=', CAST(abs(a - b) AS VARCHAR)) FROM sides""",
])))
def quality_report(spark, sf):
    # Five rules read the snapshots, so they are written once as a table of the lake would be.
    products = materialise(product_snapshots(spark, sf), "snapshots")
    lines = order_lines(spark, sf)
    sales = G.priced_lines(lines, products.select(
        "product_id", "snapshot_date", "unit_price"), "price_month")
    # Three rules read the daily sums: one row per day, written once.
    by_day = materialise(sales.groupBy("order_date").agg(
        F.sum("line_revenue").alias("revenue"), F.count_if("is_unmatched").alias("unmatched")
    ), "daily-sums")
    by_customer = G.customer_value(lines, products, "price_month")
    unmatched = by_day.agg(F.sum("unmatched").alias("unmatched"))
    return Q.report(
        Q.row_checks(products, [
            Q.Violation("products.price_positive", Q.HARD, F.col("unit_price") <= 0, "price(s) <= 0"),
            Q.Violation("products.complete", Q.SOFT, ~F.coalesce("is_complete", F.lit(False)),
                        "incomplete record(s)"),
        ], non_empty="products.not_empty", depth=("history.depth", "snapshot_date", EXPECTED_MONTHS)),
        Q.row_checks(customers(spark, sf), non_empty="customers.not_empty"),
        Q.grain_check(products, "products.grain", ["product_id", "snapshot_date"]),
        Q.grain_check(lines, "lines.grain", ["order_id", "line_no"]),
        Q.total_check(unmatched, "sales.matched", Q.HARD, F.col("unmatched"), "unmatched line(s)"),
        Q.row_checks(by_day, [Q.Violation(
            "sales.revenue_positive", Q.HARD, F.col("revenue") < 0, "negative total(s)")]),
        Q.reconcile("sales.reconciliation", by_day, F.sum("revenue"), by_customer, F.sum("lifetime_value")),
    )
