"""Published views and report queries over the analytics tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from .. import functions as X
from ..functions.measures import MONEY_TOTAL
from ..operators import latest_partition, temporal_snapshot_join


def _detail(sales: DataFrame) -> DataFrame:
    return sales.where(F.col("category_slug") != K.TOTAL_SLUG)


def bronze_trace(bronze_products: DataFrame, n: int = 10) -> DataFrame:
    """First records of the newest landed day with the object each came from."""
    newest = latest_partition(bronze_products, "_ingest_date")
    return newest.select(
        F.col("id").alias("product_id"), "title", "price", "category",
        F.col("rating.rate").alias("rating_rate"), F.col("rating.count").alias("rating_count"),
        F.col("_ingest_date").alias("snapshot_date"), F.col("_ingest_ts").alias("called_at"),
        F.col("_is_valid").alias("is_valid"),
        F.regexp_replace("_source_file", "^.*/", "").alias("object_name"),
    ).orderBy("product_id", "object_name").limit(n)


def latest_catalogue(products: DataFrame, n: int = 15) -> DataFrame:
    """Most expensive products of the newest snapshot."""
    newest = latest_partition(products, "snapshot_date")
    return newest.orderBy(F.col("unit_price").desc(), "product_id").limit(n)


def total_series(kpi: DataFrame, n: int = 30) -> DataFrame:
    """Newest TOTAL rows of the catalogue indicators."""
    return kpi.where(F.col("category_slug") == K.TOTAL_SLUG).select(
        "snapshot_date", "nb_products", "avg_unit_price", "median_unit_price",
        "avg_rating_weighted", "total_reviews", "new_reviews", "catalog_completeness_pct",
    ).orderBy(F.col("snapshot_date").desc()).limit(n)


def total_sales(sales: DataFrame, n: int = 7) -> DataFrame:
    """Newest TOTAL rows of the daily sales."""
    return sales.where(F.col("category_slug") == K.TOTAL_SLUG).select(
        "order_date", "nb_orders", "nb_items_sold", "revenue", "avg_order_value", "revenue_ma7",
        "revenue_wow_pct",
    ).orderBy(F.col("order_date").desc()).limit(n)


def sold_lines(
    lines: DataFrame, products: DataFrame, customers: DataFrame,
    price_date: str = "order_date", customer_date: str | None = "snapshot_date",
) -> DataFrame:
    """Order lines whose product and customer are both known on the day."""
    priced = temporal_snapshot_join(lines, products, "product_id", price_date, "snapshot_date")
    matched = priced.where(~F.col("is_unmatched")).drop("is_unmatched")
    if customer_date:
        who = customers.withColumnRenamed(customer_date, "order_date")
        return matched.join(who, ["customer_id", "order_date"])
    return matched.join(customers, "customer_id")


def _amount(precision: int) -> Column:
    return (F.col("quantity") * F.col("unit_price")).try_cast(f"decimal({precision},2)")


def recent_orders(sold: DataFrame, since: Column, n: int = 25) -> DataFrame:
    """Newest order lines with customer, product and amount."""
    return sold.where(F.col("order_date") >= since).select(
        "order_date", "order_id", "line_no", "full_name", "city", "product_id", "title",
        "quantity", "unit_price", _amount(12).alias("line_amount"),
    ).orderBy(F.col("order_date").desc(), "order_id", "line_no", "product_id", "quantity").limit(n)


def city_category(sold: DataFrame, category: str = "category_label", n: int = 20) -> DataFrame:
    """Which cities buy which categories, by revenue."""
    summed = sold.groupBy("city", category).agg(
        F.count_distinct("order_id").alias("nb_orders"),
        F.count_distinct("customer_id").alias("nb_customers"),
        F.sum("quantity").cast("bigint").alias("nb_items"),
        F.sum(_amount(14)).cast(MONEY_TOTAL).alias("revenue"),
        X.mean(F.col("unit_price"), 10, 2).alias("avg_unit_price"),
    )
    return summed.where(F.col("revenue") > 0).orderBy(
        F.col("revenue").desc(), "city", category
    ).limit(n)


def monthly_revenue(sales: DataFrame) -> DataFrame:
    """Revenue per month and category; `nb_days` counts calendar days, zero-filled ones included."""
    return _detail(sales).groupBy(
        F.year("order_date").alias("year"), F.month("order_date").alias("month"), "category_label"
    ).agg(
        F.sum("nb_orders").alias("nb_orders"),
        F.sum("nb_items_sold").alias("nb_items"),
        F.sum("revenue").cast(MONEY_TOTAL).alias("revenue"),
        X.mean(F.col("avg_order_value"), 12, 2).alias("avg_order_value"),
        F.count_distinct("order_date").alias("nb_days"),
    ).orderBy("year", "month", F.col("revenue").desc(), "category_label")


def segment_summary(c360: DataFrame) -> DataFrame:
    """Size and value of each customer segment."""
    return c360.groupBy("customer_segment").agg(
        F.count("*").alias("nb_customers"),
        F.sum("lifetime_value").cast(MONEY_TOTAL).alias("total_value"),
        X.mean(F.col("lifetime_value"), 12, 2).alias("avg_value"),
        X.mean(F.col("avg_order_value"), 12, 2).alias("avg_order_value"),
        X.mean(F.col("nb_orders").cast("decimal(20,0)"), 8, 2).alias("avg_orders"),
        X.mean(F.col("recency_days").cast("decimal(20,0)"), 8, 1).alias("avg_recency_days"),
    ).orderBy(F.col("total_value").desc(), "customer_segment")


def price_summary(trend: DataFrame, by: tuple[str, ...], n: int = 15) -> DataFrame:
    """Price range, volatility and promotion days of each product."""
    return trend.groupBy(*by).agg(
        F.min("price_min_window").alias("lowest_price"),
        F.max("price_max_window").alias("highest_price"),
        X.mean(F.col("price_volatility_30d"), 10, 3).alias("avg_volatility"),
        F.count_if("is_promotion").alias("promotion_days"),
        F.max("cumulative_change_pct").alias("max_change_pct"),
    ).orderBy(F.col("promotion_days").desc(), F.col("avg_volatility").desc(), *by).limit(n)


def most_volatile(trend: DataFrame, by: tuple[str, ...], n: int = 5) -> DataFrame:
    return trend.groupBy(*by).agg(
        F.max("price_volatility_30d").alias("max_volatility"),
        F.count_if("is_promotion").alias("promotion_days"),
    ).orderBy(F.col("max_volatility").desc(), *by).limit(n)


def daily_sales_view(sales: DataFrame) -> DataFrame:
    return _detail(sales).select(
        "order_date", "category_label", "nb_orders", "nb_items_sold", "revenue", "avg_order_value",
        "revenue_ma7", "revenue_wow_pct", "day_name", "is_weekend",
    )


def monthly_summary_view(sales: DataFrame) -> DataFrame:
    return _detail(sales).groupBy(
        F.year("order_date").alias("year"), F.month("order_date").alias("month"), "category_label"
    ).agg(
        F.sum("nb_orders").alias("nb_orders"),
        F.sum("nb_items_sold").alias("nb_items"),
        F.sum("revenue").cast(MONEY_TOTAL).alias("revenue"),
        X.mean(F.col("avg_order_value"), 12, 2).alias("avg_order_value"),
    )


def valued_customers_view(c360: DataFrame) -> DataFrame:
    return c360.where("nb_orders > 0").select(
        "customer_id", "full_name", "city", "customer_segment", "rfm_score", "nb_orders",
        "lifetime_value", "avg_order_value", "favorite_category", "recency_days", "last_order_date",
    )


def publish_views(sales: DataFrame, c360: DataFrame) -> None:
    """Registers the three published views in the session."""
    daily_sales_view(sales).createOrReplaceTempView("v_daily_sales")
    monthly_summary_view(sales).createOrReplaceTempView("v_monthly_summary")
    valued_customers_view(c360).createOrReplaceTempView("v_valued_customers")
