"""Customer segmentation and its rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions.measures import MONEY_TOTAL
from ..operators import ntile_distributed, top1_by
from ..plans import analytics as A
from ..plans import gold as G
from .core import cents, half_up, query, scaled, table
from .fixtures import customers, order_lines, product_snapshots, with_fx
from .sales import ALL, BOTH, PRICED, priced


def c360(spark, sf):
    return G.customer_360(
        customers(spark, sf), order_lines(spark, sf), product_snapshots(spark, sf),
        price_date="price_month",
    )


FAVORITE = """
, by_label AS (
    SELECT customer_id, category_label, sum(line_revenue) AS category_revenue
    FROM priced WHERE category_label IS NOT NULL GROUP BY 1, 2)
, favorite AS (
    SELECT customer_id, category_label AS favorite_category,
           CAST(category_revenue AS DECIMAL(20,2)) AS category_revenue
    FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                                       ORDER BY category_revenue DESC, category_label) AS rn FROM by_label)
    WHERE rn = 1)"""

RATING = scaled(half_up("CAST(sum(rating_score)*1000 AS HUGEINT)", "count(rating_score)"), 4, 3)

SEGMENTED = PRICED + FAVORITE + f"""
, sums AS (
    SELECT customer_id, CAST(count(DISTINCT order_id) AS BIGINT) AS nb_orders,
           CAST(count(*) AS BIGINT) AS nb_order_lines, CAST(sum(quantity) AS BIGINT) AS nb_items,
           CAST(count(DISTINCT product_id) AS BIGINT) AS nb_distinct_products,
           CAST(count(DISTINCT category_slug) AS BIGINT) AS nb_distinct_categories,
           CAST(sum(line_revenue) AS DECIMAL(20,2)) AS lifetime_value,
           min(order_date) AS first_order_date, max(order_date) AS last_order_date,
           {RATING} AS avg_rating_purchased,
           CAST(count(DISTINCT date_trunc('month', order_date)) AS BIGINT) AS nb_active_months
    FROM priced GROUP BY customer_id)
, base AS (
    SELECT c.customer_id, c.full_name, c.city, c.email_domain, c.email, c.acctbal,
           coalesce(nb_orders, 0) AS nb_orders, coalesce(nb_order_lines, 0) AS nb_order_lines,
           coalesce(nb_items, 0) AS nb_items, coalesce(nb_distinct_products, 0) AS nb_distinct_products,
           coalesce(nb_distinct_categories, 0) AS nb_distinct_categories,
           coalesce(nb_active_months, 0) AS nb_active_months,
           coalesce(lifetime_value, CAST(0 AS DECIMAL(20,2))) AS lifetime_value,
           first_order_date, last_order_date, avg_rating_purchased, f.favorite_category,
           {scaled(half_up(cents('coalesce(lifetime_value, 0)'), 'nb_orders'), 12, 2)} AS avg_order_value,
           CAST(datediff('day', last_order_date, (SELECT max(order_date) FROM fx_order_lines)) AS BIGINT) AS recency_days,
           CAST(datediff('day', first_order_date, last_order_date) AS BIGINT) AS customer_lifespan_days
    FROM fx_customers c LEFT JOIN sums s ON s.customer_id = c.customer_id
    LEFT JOIN favorite f ON f.customer_id = c.customer_id)
, scored AS (
    SELECT *,
      CAST(CASE WHEN nb_orders = 0 THEN 0 ELSE ntile(4) OVER (ORDER BY recency_days DESC NULLS LAST, customer_id) END AS INT) AS r_score,
      CAST(CASE WHEN nb_orders = 0 THEN 0 ELSE ntile(4) OVER (ORDER BY nb_orders NULLS FIRST, customer_id) END AS INT) AS f_score,
      CAST(CASE WHEN nb_orders = 0 THEN 0 ELSE ntile(4) OVER (ORDER BY lifetime_value NULLS FIRST, customer_id) END AS INT) AS m_score
    FROM base)
, c360 AS (
    SELECT *, concat(CAST(r_score AS VARCHAR), CAST(f_score AS VARCHAR), CAST(m_score AS VARCHAR)) AS rfm_score,
      CASE WHEN nb_orders = 0 THEN '{K.SEGMENT_NEVER}'
           WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN '{K.SEGMENT_CHAMPION}'
           WHEN r_score >= 3 AND m_score >= 3 THEN '{K.SEGMENT_LOYAL}'
           WHEN r_score >= 3 THEN '{K.SEGMENT_ACTIVE}'
           WHEN r_score = 2 THEN '{K.SEGMENT_REACTIVATE}'
           ELSE '{K.SEGMENT_AT_RISK}' END AS customer_segment
    FROM scored)"""


@query(with_fx(ALL, SEGMENTED + "\nSELECT * FROM c360"))
def customer_360(spark, sf):
    return c360(spark, sf)


@query(with_fx(ALL, SEGMENTED + """
SELECT customer_id, recency_days, nb_orders, lifetime_value, r_score, f_score, m_score, rfm_score FROM c360"""))
def rfm_scores(spark, sf):
    return c360(spark, sf).select(
        "customer_id", "recency_days", "nb_orders", "lifetime_value", "r_score", "f_score",
        "m_score", "rfm_score",
    )


@query(with_fx(BOTH, PRICED + FAVORITE + "\nSELECT customer_id, favorite_category, category_revenue FROM favorite"))
def favorite_category(spark, sf):
    best = top1_by(
        priced(spark, sf), ["customer_id"], "category_label", F.col("line_revenue"),
        "category_revenue",
    )
    return best.select(
        "customer_id", F.col("category_label").alias("favorite_category"),
        F.col("category_revenue").cast(MONEY_TOTAL).alias("category_revenue"),
    )


@query("""
SELECT o_orderkey AS order_id, CAST(o_totalprice AS DECIMAL(14,2)) AS total_price,
       CAST(ntile(10) OVER (ORDER BY CAST(o_totalprice AS DECIMAL(14,2)), o_orderkey) AS INT) AS decile
FROM orders""")
def distributed_ntile(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("total_price"),
    )
    return ntile_distributed(orders, 10, F.col("total_price"), "order_id", name="decile")


@query("""
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
       CAST(ntile(4096) OVER (ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey) AS INT) AS tile
FROM orders""")
def ntile_many_tiles(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("date").alias("order_date"))
    return ntile_distributed(orders, 4096, F.col("order_date"), "order_id", descending=True)


@query(with_fx(ALL, SEGMENTED + f"""
SELECT customer_segment, CAST(count(*) AS BIGINT) AS nb_customers,
       CAST(sum(lifetime_value) AS DECIMAL(20,2)) AS total_value,
       {scaled(half_up(cents('sum(lifetime_value)'), 'count(lifetime_value)'), 12, 2)} AS avg_value,
       {scaled(half_up(cents('sum(avg_order_value)'), 'count(avg_order_value)'), 12, 2)} AS avg_order_value,
       {scaled(half_up('sum(nb_orders)*100', 'count(nb_orders)'), 8, 2)} AS avg_orders,
       {scaled(half_up('sum(recency_days)*10', 'count(recency_days)'), 8, 1)} AS avg_recency_days
FROM c360 GROUP BY customer_segment"""))
def q7_segment_summary(spark, sf):
    return A.segment_summary(c360(spark, sf))


@query(with_fx(ALL, SEGMENTED + """
SELECT customer_id, full_name, city, customer_segment, rfm_score, nb_orders, lifetime_value,
       avg_order_value, favorite_category, recency_days, last_order_date
FROM c360 WHERE nb_orders > 0"""))
def v_valued_customers(spark, sf):
    return A.valued_customers_view(c360(spark, sf))
