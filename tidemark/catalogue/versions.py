"""Versioned reads of the product snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import versions as V
from .core import query, table
from .fixtures import product_snapshots, with_fx

SNAP = "fx_product_snapshots"
BEFORE, AFTER = "1998-01-01", "1999-01-01"


@query(with_fx(SNAP, f"""
SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY snapshot_date DESC) AS rn
    FROM fx_product_snapshots WHERE snapshot_date <= DATE '{BEFORE}') WHERE rn = 1"""))
def as_of_read(spark, sf):
    return V.as_of(product_snapshots(spark, sf), "product_id", "snapshot_date", BEFORE)


def _fingerprinted(df):
    text = F.concat_ws("|", F.col("unit_price").cast("string"), F.col("review_count").cast("string"))
    return df.withColumn("fingerprint", F.md5(text))


def _version_sql(day: str) -> str:
    return f"""
    SELECT product_id, md5(concat_ws('|', CAST(unit_price AS VARCHAR), CAST(review_count AS VARCHAR))) AS h
    FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY snapshot_date DESC) AS rn
          FROM fx_product_snapshots WHERE snapshot_date <= DATE '{day}') WHERE rn = 1"""


@query(with_fx(SNAP, f"""
, a AS ({_version_sql(BEFORE)})
, b AS ({_version_sql(AFTER)})
SELECT * FROM (
    SELECT coalesce(a.product_id, b.product_id) AS product_id,
           CASE WHEN a.h IS NULL THEN 'added' WHEN b.h IS NULL THEN 'removed' WHEN a.h <> b.h THEN 'changed' END AS change
    FROM a FULL JOIN b ON a.product_id = b.product_id)
WHERE change IS NOT NULL"""))
def version_diff(spark, sf):
    products = _fingerprinted(product_snapshots(spark, sf))
    before = V.as_of(products, "product_id", "snapshot_date", BEFORE)
    after = V.as_of(products, "product_id", "snapshot_date", AFTER)
    return V.version_diff(before, after, ["product_id"], "fingerprint")


@query(with_fx(SNAP, f"""
, a AS (SELECT category_slug, count(*) AS n FROM fx_product_snapshots WHERE snapshot_date <= DATE '{BEFORE}' GROUP BY 1)
, b AS (SELECT category_slug, count(*) AS n FROM fx_product_snapshots WHERE snapshot_date <= DATE '{AFTER}' GROUP BY 1)
SELECT coalesce(a.category_slug, b.category_slug) AS category_slug, CAST(a.n AS BIGINT) AS n_before, CAST(b.n AS BIGINT) AS n_after
FROM a FULL JOIN b ON a.category_slug = b.category_slug"""))
def version_counts(spark, sf):
    products = product_snapshots(spark, sf)
    before = products.where(F.col("snapshot_date") <= F.lit(BEFORE).cast("date"))
    after = products.where(F.col("snapshot_date") <= F.lit(AFTER).cast("date"))
    return V.version_counts(before, after, "category_slug")


@query("""
SELECT order_id, ship_date, discount, return_flag FROM (
    SELECT l_orderkey AS order_id, CAST(l_shipdate AS DATE) AS ship_date, l_discount AS discount, NULL AS return_flag
    FROM lineitem WHERE l_linestatus = 'O'
    UNION ALL
    SELECT l_orderkey, CAST(l_shipdate AS DATE), NULL, l_returnflag FROM lineitem WHERE l_linestatus <> 'O')""")
def schema_merge(spark, sf):
    lines = table(spark, sf, "lineitem")
    shared = [F.col("l_orderkey").alias("order_id"), F.to_date("l_shipdate").alias("ship_date")]
    is_open = F.col("l_linestatus") == "O"
    old = lines.where(is_open).select(*shared, F.col("l_discount").alias("discount"))
    new = lines.where(~is_open).select(*shared, F.col("l_returnflag").alias("return_flag"))
    return V.merge_schema(old, new)


@query(with_fx(SNAP, """
, added AS (SELECT category_slug, snapshot_date, CAST(count(*) AS BIGINT) AS added_records FROM fx_product_snapshots GROUP BY 1, 2)
SELECT *, CAST(sum(added_records) OVER (PARTITION BY category_slug ORDER BY snapshot_date) AS BIGINT) AS total_records FROM added"""))
def snapshot_history(spark, sf):
    return V.snapshot_history(product_snapshots(spark, sf), ["category_slug"], "snapshot_date")


@query(with_fx(SNAP, """
SELECT product_id, snapshot_date, unit_price FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY snapshot_date DESC) AS rn FROM fx_product_snapshots)
WHERE rn <= 5 OR snapshot_date >= DATE '2001-01-01'"""))
def retention_filter(spark, sf):
    kept = V.retention(product_snapshots(spark, sf), ["product_id"], "snapshot_date", "2001-01-01")
    return kept.select("product_id", "snapshot_date", "unit_price")
