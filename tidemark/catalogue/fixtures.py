"""The retail domain expressed over the given tables, in Spark and in SQL.

Order lines are lineitem x orders, product snapshots are monthly prices per part, customers are
customer x nation, landing events are the event stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import input_bytes
from .core import table

#: Bytes of input files for each task that lines are dealt out to by product.
TASK_BYTES = 4 << 20


def month(column: str):
    return F.trunc(F.col(column), "month")


def line_tasks(spark: SparkSession, sf: str) -> int:
    """Tasks for the lines: their number follows the size of the table, so that what one task holds does not."""
    return max(spark.sparkContext.defaultParallelism, -(-input_bytes(spark, f"{sf}/lineitem.parquet") // TASK_BYTES))


def product_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Lines are reduced to one row per (part, month) before parts are joined.

    A part has few lines in a month, so adding up before the shuffle would hold nearly every line of a task; slim lines
    are dealt out by part instead, and windows over a part find its months together.
    """
    lines = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("product_id"), month("l_shipdate").alias("snapshot_date"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"), "l_discount",
    ).repartition(line_tasks(spark, sf), "product_id")
    monthly = lines.groupBy("product_id", "snapshot_date").agg(
        F.min("price").alias("unit_price"),
        F.count("*").alias("review_count"),
        F.round(F.max("l_discount") * 50, 1).cast("decimal(4,1)").alias("rating_score"),
    )
    part = table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("title"),
        F.lower("p_type").alias("category_slug"), F.initcap("p_type").alias("category_label"),
        F.col("p_brand").alias("brand"), (F.col("p_size") > 5).alias("is_complete"),
    )
    return monthly.join(part, "product_id").withColumn(
        "is_reconstructed", F.col("review_count") == 1
    )


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity"),
    )
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.to_date("o_orderdate").alias("order_date"),
        month("o_orderdate").alias("price_month"), F.col("o_custkey").alias("customer_id"),
    )
    return lines.join(orders, "order_id")


def customers(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city")
    )
    domain = F.lower("c_mktsegment")
    name = F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit(".")))
    return table(spark, sf, "customer").join(nation, "c_nationkey").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"), "city",
        domain.alias("email_domain"),
        F.concat(name, F.lit("@"), domain, F.lit(".example")).alias("email"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("acctbal"),
    )


def price_series(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy(
        F.col("l_partkey").alias("product_id"), F.to_date("l_shipdate").alias("snapshot_date")
    ).agg(F.min(F.col("l_extendedprice").cast("decimal(10,2)")).alias("unit_price"))


def landing(spark: SparkSession, sf: str) -> DataFrame:
    return with_response(table(spark, sf, "events"))


def with_response(events: DataFrame) -> DataFrame:
    """Events as API responses: status, type and size next to domain and logical day."""
    return events.select(
        "event_id", "ts", "user_id", F.col("event_type").alias("domain"),
        F.to_date("ts").alias("snapshot_date"), "value", "props",
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        F.when(F.col("user_id") % 50 == 0, "text/html").otherwise("application/json").alias("mime"),
        F.length(F.concat_ws("|", F.col("event_id").cast("string"), "event_type", "props"))
        .alias("n_bytes"),
    )


FX = {
    "fx_product_snapshots": """
        SELECT l.l_partkey AS product_id, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS snapshot_date,
               min(p.p_name) AS title, min(lower(p.p_type)) AS category_slug,
               min(upper(substr(p.p_type, 1, 1)) || lower(substr(p.p_type, 2))) AS category_label,
               min(p.p_brand) AS brand,
               CAST(min(CAST(l.l_extendedprice AS DECIMAL(10,2))) AS DECIMAL(10,2)) AS unit_price,
               CAST(count(*) AS BIGINT) AS review_count,
               CAST(round(max(l.l_discount) * 50, 1) AS DECIMAL(4,1)) AS rating_score,
               min(p.p_size) > 5 AS is_complete, count(*) = 1 AS is_reconstructed
        FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
        GROUP BY l.l_partkey, CAST(date_trunc('month', l.l_shipdate) AS DATE)""",
    "fx_order_lines": """
        SELECT o.o_orderkey AS order_id, l.l_linenumber AS line_no, CAST(o.o_orderdate AS DATE) AS order_date,
               CAST(date_trunc('month', o.o_orderdate) AS DATE) AS price_month,
               o.o_custkey AS customer_id, l.l_partkey AS product_id, CAST(l.l_quantity AS INT) AS quantity
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""",
    "fx_customers": """
        SELECT c.c_custkey AS customer_id, c.c_name AS full_name, n.n_name AS city,
               lower(c.c_mktsegment) AS email_domain,
               concat(lower(replace(c.c_name, '#', '.')), '@', lower(c.c_mktsegment), '.example') AS email,
               CAST(c.c_acctbal AS DECIMAL(12,2)) AS acctbal
        FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "fx_price_series": """
        SELECT l_partkey AS product_id, CAST(l_shipdate AS DATE) AS snapshot_date,
               CAST(min(CAST(l_extendedprice AS DECIMAL(10,2))) AS DECIMAL(10,2)) AS unit_price
        FROM lineitem GROUP BY l_partkey, CAST(l_shipdate AS DATE)""",
    "fx_landing": """
        SELECT event_id, ts, user_id, event_type AS domain, CAST(ts AS DATE) AS snapshot_date, value, props,
               CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
               CASE WHEN user_id % 50 = 0 THEN 'text/html' ELSE 'application/json' END AS mime,
               length(concat_ws('|', CAST(event_id AS VARCHAR), event_type, props)) AS n_bytes
        FROM events""",
}


def with_fx(names: str, body: str) -> str:
    """`body` preceded by the named fixture views; a body with own views starts with a comma."""
    views = ",\n".join(f"{name} AS ({FX[name]})" for name in names.split())
    return f"WITH {views}{body}" if body.lstrip().startswith(",") else f"WITH {views}\n{body}"
