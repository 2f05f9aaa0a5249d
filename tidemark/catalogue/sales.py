"""Order lines at the price of their day, daily sales series and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import change_pct
from ..functions.measures import MONEY_TOTAL
from ..operators import lagged, moving, running_in_month
from ..operators import calendar as C
from ..operators import quality as Q
from ..plans import analytics as A
from ..plans import gold as G
from ..session import materialise
from .core import cents, half_up, query, quotient, scaled, table
from .fixtures import customers, order_lines, product_snapshots, with_fx

BOTH = "fx_order_lines fx_product_snapshots"
ALL = BOTH + " fx_customers"


def priced(spark, sf) -> DataFrame:
    price = product_snapshots(spark, sf).select(
        "product_id", "snapshot_date", "unit_price", "category_slug", "category_label", "rating_score"
    )
    return G.priced_lines(order_lines(spark, sf), price, "price_month")


def order_bounds(spark, sf):
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("order_date"))
    return G.day_bounds(days, "order_date")


def daily_sales(spark, sf) -> DataFrame:
    # Prices and categories are read separately, from a table as in the lake.
    products = materialise(product_snapshots(spark, sf), "snapshots")
    return G.sales_by_category(
        order_lines(spark, sf), products, customers(spark, sf),
        price_date="price_month", customer_date=None, bounds=order_bounds(spark, sf),
    )


def sold(spark, sf) -> DataFrame:
    return A.sold_lines(
        order_lines(spark, sf), product_snapshots(spark, sf), customers(spark, sf),
        "price_month", None,
    )


PRICED = """
, priced AS (
    SELECT o.*, p.unit_price, p.category_slug, p.category_label, p.rating_score,
           p.product_id IS NULL AS is_unmatched,
           CAST(o.quantity * p.unit_price AS DECIMAL(14,2)) AS line_revenue
    FROM fx_order_lines o LEFT JOIN fx_product_snapshots p
      ON p.product_id = o.product_id AND p.snapshot_date = o.price_month)"""

# Revenue, items and lines only: the light form of the daily totals.
LIGHT = PRICED + f"""
, named AS (SELECT *, coalesce(category_slug, '{K.UNKNOWN_SLUG}') AS slug FROM priced)
, totals AS (
    SELECT order_date, slug AS category_slug,
           coalesce(max(category_label), '{K.UNMATCHED_LABEL}') AS category_label,
           CAST(count(*) AS BIGINT) AS nb_order_lines, CAST(sum(quantity) AS BIGINT) AS nb_items_sold,
           CAST(sum(line_revenue) AS DECIMAL(20,2)) AS revenue
    FROM named GROUP BY order_date, slug
    UNION ALL
    SELECT order_date, '{K.TOTAL_SLUG}', '{K.ALL_SALES_LABEL}', CAST(count(*) AS BIGINT),
           CAST(sum(quantity) AS BIGINT), CAST(sum(line_revenue) AS DECIMAL(20,2))
    FROM named GROUP BY order_date)"""

SKELETON = """
, days AS (
    SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
                                       INTERVAL 1 DAY)) AS DATE) AS order_date
    FROM orders)
, skeleton AS (
    SELECT d.order_date, c.category_slug, c.category_label
    FROM days d, (SELECT category_slug, max(category_label) AS category_label FROM totals GROUP BY 1) c)"""

FILLED = LIGHT + SKELETON + """
, filled AS (
    SELECT s.order_date, s.category_slug, s.category_label,
           coalesce(t.nb_order_lines, 0) AS nb_order_lines, coalesce(t.nb_items_sold, 0) AS nb_items_sold,
           coalesce(t.revenue, CAST(0 AS DECIMAL(20,2))) AS revenue
    FROM skeleton s LEFT JOIN totals t USING (order_date, category_slug))"""


def light_totals(spark, sf) -> DataFrame:
    totals = G.sales_value(order_lines(spark, sf), product_snapshots(spark, sf), "price_month")
    return totals.select(
        "order_date", "category_slug", "category_label", "nb_order_lines", "nb_items_sold", "revenue"
    )


def filled_series(spark, sf) -> DataFrame:
    zeros = {
        "nb_order_lines": F.lit(0).cast("bigint"), "nb_items_sold": F.lit(0).cast("bigint"),
        "revenue": F.lit(0).cast(MONEY_TOTAL),
    }
    return C.calendar_fill(
        light_totals(spark, sf), "order_date", "category_slug", order_bounds(spark, sf), zeros,
        ["category_label"],
    )


@query(with_fx(BOTH, PRICED + """
SELECT order_id, line_no, order_date, price_month, customer_id, product_id, quantity, unit_price,
       category_slug, line_revenue, is_unmatched FROM priced"""))
def temporal_snapshot_join(spark, sf):
    return priced(spark, sf).select(
        "order_id", "line_no", "order_date", "price_month", "customer_id", "product_id", "quantity",
        "unit_price", "category_slug", "line_revenue", "is_unmatched",
    )


@query(with_fx(BOTH, LIGHT + "\nSELECT * FROM totals"))
def grouping_sets_total(spark, sf):
    return light_totals(spark, sf)


@query(with_fx(BOTH, FILLED + "\nSELECT * FROM filled"))
def calendar_fill(spark, sf):
    return filled_series(spark, sf)


MA7_MICRO = half_up(
    f"{cents('sum(revenue) OVER w')}*10000", "count(*) OVER w"
)


@query(with_fx(BOTH, FILLED + f"""
SELECT order_date, category_slug, revenue,
       {scaled(half_up(MA7_MICRO, '10000'), 20, 2)} AS revenue_ma7
FROM filled
WINDOW w AS (PARTITION BY category_slug ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""))
def moving_average(spark, sf):
    ma = moving("revenue", "category_slug", "order_date", 7)
    return filled_series(spark, sf).select(
        "order_date", "category_slug", "revenue", F.round(ma, 2).cast(MONEY_TOTAL).alias("revenue_ma7")
    )


@query(with_fx(BOTH, FILLED + """
SELECT order_date, category_slug, revenue,
       CAST(sum(revenue) OVER (PARTITION BY category_slug, date_trunc('month', order_date)
                               ORDER BY order_date) AS DECIMAL(20,2)) AS revenue_mtd
FROM filled"""))
def month_to_date(spark, sf):
    mtd = running_in_month("revenue", "category_slug", "order_date").cast(MONEY_TOTAL)
    return filled_series(spark, sf).select(
        "order_date", "category_slug", "revenue", mtd.alias("revenue_mtd")
    )


@query(with_fx(BOTH, FILLED + f"""
, week AS (SELECT *, lag(revenue, 7) OVER (PARTITION BY category_slug ORDER BY order_date) AS week_ago FROM filled)
SELECT order_date, category_slug, revenue,
       {quotient(f"100*{cents('revenue - week_ago')}", cents('week_ago'), 10, 2)} AS revenue_wow_pct
FROM week"""))
def wow_pct(spark, sf):
    series = filled_series(spark, sf).withColumn(
        "_week_ago", lagged("revenue", "category_slug", "order_date", 7)
    )
    return series.select(
        "order_date", "category_slug", "revenue",
        change_pct(F.col("revenue"), F.col("_week_ago")).alias("revenue_wow_pct"),
    )


def _measures() -> str:
    price = scaled(half_up(cents("sum(unit_price)"), "count(unit_price)"), 10, 2)
    rating = scaled(half_up("CAST(sum(rating_score)*1000 AS HUGEINT)", "count(rating_score)"), 4, 3)
    return f"""
        CAST(count(DISTINCT order_id) AS BIGINT) AS nb_orders, CAST(count(*) AS BIGINT) AS nb_order_lines,
        CAST(sum(quantity) AS BIGINT) AS nb_items_sold,
        CAST(count(DISTINCT customer_id) AS BIGINT) AS nb_active_customers,
        CAST(count(DISTINCT product_id) AS BIGINT) AS nb_distinct_products,
        CAST(count(DISTINCT city) AS BIGINT) AS nb_cities,
        CAST(sum(line_revenue) AS DECIMAL(20,2)) AS revenue,
        {price} AS avg_unit_price, {rating} AS avg_rating_sold,
        CAST(count(*) FILTER (WHERE is_unmatched) AS BIGINT) AS nb_unmatched_lines"""


DAILY = PRICED + f"""
, named AS (
    SELECT p.*, c.city, coalesce(p.category_slug, '{K.UNKNOWN_SLUG}') AS slug
    FROM priced p LEFT JOIN fx_customers c ON c.customer_id = p.customer_id)
, totals AS (
    SELECT order_date, slug AS category_slug,
           coalesce(max(category_label), '{K.UNMATCHED_LABEL}') AS category_label, {_measures()}
    FROM named GROUP BY order_date, slug
    UNION ALL
    SELECT order_date, '{K.TOTAL_SLUG}', '{K.ALL_SALES_LABEL}', {_measures()}
    FROM named GROUP BY order_date)""" + SKELETON + f"""
, filled AS (
    SELECT s.order_date, s.category_slug, s.category_label,
           coalesce(nb_orders, 0) AS nb_orders, coalesce(nb_order_lines, 0) AS nb_order_lines,
           coalesce(nb_items_sold, 0) AS nb_items_sold,
           coalesce(nb_active_customers, 0) AS nb_active_customers,
           coalesce(nb_distinct_products, 0) AS nb_distinct_products,
           coalesce(nb_cities, 0) AS nb_cities,
           coalesce(revenue, CAST(0 AS DECIMAL(20,2))) AS revenue, avg_unit_price, avg_rating_sold,
           coalesce(nb_unmatched_lines, 0) AS nb_unmatched_lines
    FROM skeleton s LEFT JOIN totals t USING (order_date, category_slug))
, week AS (
    SELECT *, lag(revenue, 7) OVER (PARTITION BY category_slug ORDER BY order_date) AS week_ago FROM filled)
, daily AS (
    SELECT order_date, category_slug, category_label, year(order_date) AS year, month(order_date) AS month,
           weekofyear(order_date) AS week_of_year, dayname(order_date) AS day_name,
           dayofweek(order_date) IN (0, 6) AS is_weekend, nb_orders, nb_order_lines, nb_items_sold,
           nb_active_customers, nb_distinct_products, nb_cities, revenue, avg_unit_price, avg_rating_sold,
           {scaled(half_up(cents('revenue'), 'nb_orders'), 12, 2)} AS avg_order_value,
           {quotient('nb_items_sold', 'nb_orders', 8, 2)} AS avg_items_per_order,
           {scaled(half_up(MA7_MICRO, '10000'), 20, 2)} AS revenue_ma7,
           CAST(sum(revenue) OVER (PARTITION BY category_slug, date_trunc('month', order_date)
                                   ORDER BY order_date) AS DECIMAL(20,2)) AS revenue_mtd,
           {quotient(f"100*{cents('revenue - week_ago')}", cents('week_ago'), 10, 2)} AS revenue_wow_pct,
           nb_unmatched_lines
    FROM week
    WINDOW w AS (PARTITION BY category_slug ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""


@query(with_fx(ALL, DAILY + """
SELECT * REPLACE (CAST(year AS INT) AS year, CAST(month AS INT) AS month,
                  CAST(week_of_year AS INT) AS week_of_year) FROM daily"""))
def daily_sales_category(spark, sf):
    return daily_sales(spark, sf)


MONTHLY = f"""
    SELECT CAST(year(order_date) AS INT) AS year, CAST(month(order_date) AS INT) AS month, category_label,
           CAST(sum(nb_orders) AS BIGINT) AS nb_orders, CAST(sum(nb_items_sold) AS BIGINT) AS nb_items,
           CAST(sum(revenue) AS DECIMAL(20,2)) AS revenue,
           {scaled(half_up(cents('sum(avg_order_value)'), 'count(avg_order_value)'), 12, 2)} AS avg_order_value"""
MONTHLY_END = f"""
    FROM daily WHERE category_slug <> '{K.TOTAL_SLUG}'
    GROUP BY year(order_date), month(order_date), category_label"""


@query(with_fx(ALL, DAILY + MONTHLY + ", CAST(count(DISTINCT order_date) AS BIGINT) AS nb_days" + MONTHLY_END))
def q6_monthly_revenue(spark, sf):
    return A.monthly_revenue(daily_sales(spark, sf))


@query(with_fx(ALL, DAILY + MONTHLY + MONTHLY_END))
def v_monthly_summary(spark, sf):
    return A.monthly_summary_view(daily_sales(spark, sf))


@query(with_fx(ALL, DAILY + MONTHLY + MONTHLY_END + "\nORDER BY 1, 2, revenue DESC, category_label LIMIT 20"))
def q9_monthly_view(spark, sf):
    view = A.monthly_summary_view(daily_sales(spark, sf))
    return view.orderBy("year", "month", F.col("revenue").desc(), "category_label").limit(20)


@query(with_fx(ALL, DAILY + f"""
SELECT order_date, category_label, nb_orders, nb_items_sold, revenue, avg_order_value, revenue_ma7,
       revenue_wow_pct, day_name, is_weekend
FROM daily WHERE category_slug <> '{K.TOTAL_SLUG}'"""))
def v_daily_sales(spark, sf):
    return A.daily_sales_view(daily_sales(spark, sf))


@query(with_fx(ALL, DAILY + f"""
SELECT order_date, nb_orders, nb_items_sold, revenue, avg_order_value, revenue_ma7, revenue_wow_pct
FROM daily WHERE category_slug = '{K.TOTAL_SLUG}' ORDER BY order_date DESC LIMIT 7"""))
def last_total_sales(spark, sf):
    return A.total_sales(daily_sales(spark, sf))


SOLD = """
, sold AS (
    SELECT o.*, p.unit_price, p.category_label, p.title, c.full_name, c.city
    FROM fx_order_lines o
    JOIN fx_product_snapshots p ON p.product_id = o.product_id AND p.snapshot_date = o.price_month
    JOIN fx_customers c ON c.customer_id = o.customer_id)"""


@query(with_fx(ALL, SOLD + """
SELECT order_date, order_id, line_no, full_name, city, product_id, title, quantity, unit_price,
       CAST(quantity * unit_price AS DECIMAL(12,2)) AS line_amount
FROM sold WHERE order_date >= (SELECT max(CAST(o_orderdate AS DATE)) - 7 FROM orders)
ORDER BY order_date DESC, order_id, line_no, product_id, quantity LIMIT 25"""))
def q4_domain_join(spark, sf):
    _, newest = order_bounds(spark, sf)
    return A.recent_orders(sold(spark, sf), F.date_sub(newest, 7))


@query(with_fx(ALL, SOLD + f"""
SELECT city, category_label, CAST(count(DISTINCT order_id) AS BIGINT) AS nb_orders,
       CAST(count(DISTINCT customer_id) AS BIGINT) AS nb_customers,
       CAST(sum(quantity) AS BIGINT) AS nb_items,
       CAST(sum(CAST(quantity * unit_price AS DECIMAL(14,2))) AS DECIMAL(20,2)) AS revenue,
       {scaled(half_up(cents('sum(unit_price)'), 'count(unit_price)'), 10, 2)} AS avg_unit_price
FROM sold GROUP BY city, category_label HAVING sum(quantity * unit_price) > 0
ORDER BY revenue DESC, city, category_label LIMIT 20"""))
def q5_city_category(spark, sf):
    return A.city_category(sold(spark, sf))


@query(with_fx(BOTH, """
SELECT o.* FROM fx_order_lines o
ANTI JOIN fx_product_snapshots p ON p.product_id = o.product_id AND p.snapshot_date = o.price_month"""))
def orphan_lines(spark, sf):
    dim = product_snapshots(spark, sf).withColumnRenamed("snapshot_date", "price_month")
    return Q.orphan_lines(order_lines(spark, sf), dim, ["product_id", "price_month"]).select(
        "order_id", "line_no", "order_date", "price_month", "customer_id", "product_id", "quantity"
    )


# Both sides are summed for themselves; `kept` tells which days the left one has.
def _reconciled(kept: str) -> str:
    return f"""
, by_day AS (SELECT order_date, sum(line_revenue) AS v FROM priced WHERE {kept} GROUP BY order_date)
, by_customer AS (SELECT customer_id, sum(line_revenue) AS v FROM priced GROUP BY customer_id)
, sides AS (SELECT CAST((SELECT coalesce(sum(v), 0) FROM by_day) AS DECIMAL(30,2)) AS a,
                   CAST((SELECT coalesce(sum(v), 0) FROM by_customer) AS DECIMAL(30,2)) AS b)
SELECT 'sales.reconciliation' AS name, 'hard' AS severity,
       CAST(abs(a - b) AS DOUBLE) <= greatest(1.0, CAST(a AS DOUBLE) * 0.001) AS passed,
       concat('left=', CAST(a AS VARCHAR), ' right=', CAST(b AS VARCHAR), ' gap=', CAST(abs(a - b) AS VARCHAR)) AS detail
FROM sides"""


@query(with_fx(ALL, PRICED + _reconciled("month(order_date) <> 3")))
def reconciliation_failing(spark, sf):
    """One side lacks the orders of every March."""
    lines, products = order_lines(spark, sf), product_snapshots(spark, sf)
    by_customer = G.customer_value(lines, products, "price_month")
    by_day = light_totals(spark, sf).where(
        (F.col("category_slug") == K.TOTAL_SLUG) & (F.month("order_date") != 3))
    return Q.reconcile(
        "sales.reconciliation", by_day, F.sum("revenue"), by_customer, F.sum("lifetime_value")
    )


@query(with_fx(ALL, PRICED + _reconciled("TRUE")))
def reconciliation(spark, sf):
    lines, products = order_lines(spark, sf), product_snapshots(spark, sf)
    by_customer = G.customer_value(lines, products, "price_month")
    by_day = light_totals(spark, sf).where(F.col("category_slug") == K.TOTAL_SLUG)
    return Q.reconcile(
        "sales.reconciliation", by_day, F.sum("revenue"), by_customer, F.sum("lifetime_value")
    )
