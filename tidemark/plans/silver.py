"""Conformed layer: typed, flat, privacy-minimised daily snapshots and order facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from .. import functions as X
from ..operators import dedup_latest, explode_lines, replicate_and_thin


def current_records(bronze: DataFrame, dates: Sequence[str] | None = None) -> DataFrame:
    """Valid records, the last landed one per (id, day). `dates` prunes partitions."""
    rows = bronze.where(F.col("_is_valid"))
    if dates is not None:
        rows = rows.where(F.col("_ingest_date").isin([F.lit(d).cast("date") for d in dates]))
    order = [F.col("_ingest_ts").desc(), F.col("_source_file").desc(), F.col("_record_hash")]
    return dedup_latest(rows, ["id", "_ingest_date"], order)


def dim_products(
    bronze: DataFrame, anchor: Column, dates: Sequence[str] | None = None, *,
    days: int = K.HISTORY_DAYS, reconstruct: bool = True, seed: int = K.HISTORY_SEED,
    method: str = "murmur3",
) -> DataFrame:
    """Product x day. The observed measures stay beside those carried back from the anchor."""
    base = current_records(bronze, dates).select(
        F.col("id").alias("product_id"),
        F.col("_ingest_date").alias("snapshot_date"),
        F.trim("title").alias("title"),
        X.slug(F.col("category")).alias("category_slug"),
        X.title_label(F.col("category")).alias("category_label"),
        X.money(F.col("price")).alias("unit_price_observed"),
        F.coalesce(F.col("rating.count"), F.lit(0)).alias("review_count_observed"),
        F.col("rating.rate").alias("rating_score"),
        F.trim("description").alias("description"),
        F.col("image").alias("image_url"),
        F.col("_ingest_ts").alias("source_ingest_ts"),
        F.col("_record_hash").alias("source_record_hash"),
    )
    day, price = F.col("snapshot_date"), F.col("unit_price_observed")
    if reconstruct:
        factor = X.back_projection(F.col("product_id"), day, anchor, days, seed, method)
        reached = X.growth(day, anchor, days)
    else:
        factor = reached = F.lit(1.0)
    size = F.length("description")
    return base.select(
        X.surrogate_key("product", F.col("product_id"), day).alias("product_sk"),
        "product_id", "snapshot_date", "title", "category_slug", "category_label",
        "unit_price_observed", "review_count_observed",
        F.round(price * factor, 2).try_cast("decimal(10,2)").alias("unit_price"),
        F.round(F.col("review_count_observed") * reached).cast("int").alias("review_count"),
        "rating_score",
        X.bucketize(price, K.PRICE_BAND_BOUNDS, K.PRICE_BAND_LABELS).alias("price_band"),
        size.alias("description_length"),
        "image_url",
        X.complete(
            F.col("title").isNotNull(), F.col("category_slug").isNotNull(),
            F.col("rating_score").isNotNull(), size > 30,
        ).alias("is_complete"),
        F.lit(reconstruct).alias("is_reconstructed"),
        "source_ingest_ts", "source_record_hash",
        F.current_timestamp().alias("silver_ts"),
    )


def dim_customers(bronze: DataFrame, dates: Sequence[str] | None = None) -> DataFrame:
    """Customer x day. Passwords do not reach this layer."""
    base = current_records(bronze, dates).select(
        F.col("id").alias("customer_id"),
        F.col("_ingest_date").alias("snapshot_date"),
        X.slug(F.col("email")).alias("email"),
        X.slug(F.col("username")).alias("username"),
        F.initcap(F.trim("name.firstname")).alias("first_name"),
        F.initcap(F.trim("name.lastname")).alias("last_name"),
        F.initcap(F.trim("address.city")).alias("city"),
        F.initcap(F.trim("address.street")).alias("street"),
        F.col("address.number").alias("street_number"),
        F.trim("address.zipcode").alias("zip_code"),
        F.col("address.geolocation.lat").alias("_lat"),
        F.col("address.geolocation.long").alias("_long"),
        X.digits(F.col("phone")).alias("phone_digits"),
        F.col("phone").alias("phone_raw"),
        F.col("_ingest_ts").alias("source_ingest_ts"),
        F.col("_record_hash").alias("source_record_hash"),
    )
    latitude = X.valid_range(F.col("_lat"), -90, 90)
    longitude = X.valid_range(F.col("_long"), -180, 180)
    return base.select(
        X.surrogate_key("customer", F.col("customer_id"), F.col("snapshot_date")).alias("customer_sk"),
        "customer_id", "snapshot_date", "email",
        X.mask_email(F.col("email")).alias("email_masked"),
        X.email_domain(F.col("email")).alias("email_domain"),
        "username", "first_name", "last_name",
        X.join_words(F.col("first_name"), F.col("last_name")).alias("full_name"),
        "city", "street", "street_number", "zip_code",
        X.join_words(F.col("street_number"), F.col("street"), F.col("zip_code"), F.col("city"))
        .alias("full_address"),
        latitude.alias("latitude"),
        longitude.alias("longitude"),
        (latitude.isNotNull() & longitude.isNotNull()).alias("has_valid_geolocation"),
        "phone_digits", "phone_raw",
        (F.length("phone_digits") >= 10).alias("has_valid_phone"),
        X.complete(
            F.col("city").isNotNull(), F.col("zip_code").isNotNull(), F.col("street").isNotNull()
        ).alias("has_complete_address"),
        "source_ingest_ts", "source_record_hash",
        F.current_timestamp().alias("silver_ts"),
    )


def fct_order_items(
    bronze: DataFrame, customer_count: int | Column, dates: Sequence[str] | None = None, *,
    copies: int = K.ORDER_REPLICAS, reconstruct: bool = True, seed: int = K.HISTORY_SEED,
    method: str = "murmur3",
) -> DataFrame:
    """Order x product: template carts replicated, thinned by weekday and opened into lines."""

    def uniform(key: Column, salt: str) -> Column:
        return X.hash_uniform(key, F.col("order_date"), salt, seed, method)

    templates = current_records(bronze, dates).select(
        F.col("id").alias("template_cart_id"),
        F.col("userId").alias("source_customer_id"),
        F.col("date").alias("_cart_date"),
        F.col("products").alias("_lines"),
        F.col("_ingest_date").alias("order_date"),
        F.col("_record_hash").alias("source_record_hash"),
    )
    order = F.concat_ws(":", F.col("template_cart_id").cast("string"), F.col("template_replica").cast("string"))
    orders = replicate_and_thin(
        templates, copies, uniform(order, "occur"), X.weekday_rate(F.col("order_date")),
        "template_replica",
    ).withColumns({
        "customer_id": F.when(F.col("template_replica") == 0, F.col("source_customer_id")).otherwise(
            X.hash_pick(order, F.col("order_date"), "cust", customer_count, seed, method)
        ),
        "order_ts": X.order_time(
            F.col("order_date"), uniform(order, "hour"), uniform(order, "minute")
        ),
        "order_id": X.business_key(
            "ORD", F.col("order_date"), (F.col("template_cart_id"), 3), F.col("template_replica")
        ),
    })
    lines = explode_lines(orders, "_lines").withColumnsRenamed(
        {"productId": "product_id", "quantity": "quantity_source"}
    )
    line = F.concat_ws(":", order, F.col("product_id").cast("string"))
    drawn = F.round(F.col("quantity_source") * (F.lit(0.7) + F.lit(0.6) * uniform(line, "qty")))
    return lines.select(
        "order_id",
        F.concat_ws("-", "order_id", X.padded(F.col("product_id"), 3)).alias("order_line_id"),
        F.col("order_date").alias("snapshot_date"),
        "order_date", "order_ts", "customer_id", "product_id",
        F.greatest(F.lit(1), drawn.cast("int")).alias("quantity"),
        "quantity_source", "template_cart_id", "template_replica", "source_customer_id",
        F.try_to_timestamp("_cart_date").alias("source_cart_ts"),
        "source_record_hash",
        F.lit(reconstruct).alias("is_reconstructed"),
        F.current_timestamp().alias("silver_ts"),
    )
