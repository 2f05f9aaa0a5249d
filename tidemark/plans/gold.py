"""Analytics layer: catalogue indicators, price trends, daily sales, customer segmentation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from .. import functions as X
from ..functions.measures import MONEY_TOTAL
from ..operators import (
    calendar_attributes, calendar_fill, dedup_latest, lagged, latest_state, moving,
    ntile_scores, running_in_month, temporal_snapshot_join, with_total,
)
from ..session import materialise


def catalog_kpi(products: DataFrame, accuracy: int = 10000) -> DataFrame:
    """Day x category with a TOTAL row: price level, ratings, reviews and completeness.

    The median is a sketch of bounded size: its rank is off by about 1/`accuracy` of the rows,
    so small groups get their exact median.
    """
    price, reviews, rating = F.col("unit_price"), F.col("review_count"), F.col("rating_score")
    known = price.isNotNull()
    # All but the median adds up: products are summed per (day, category, label) once, and TOTAL
    # rows and labels come from these few sums.
    sums = products.groupBy("snapshot_date", "category_slug", "category_label").agg(
        F.count("*").alias("nb_products"), F.sum(price).alias("_price"), F.count_if(known).alias("_priced"),
        F.min(price).alias("_low"), F.max(price).alias("_high"),
        F.sum(rating).alias("_rating"), F.count(rating).alias("_rated"),
        F.sum(rating * reviews).alias("_weighted"),
        F.sum(reviews).alias("_reviews"), F.count_if("is_complete").alias("nb_complete_products"),
        F.bool_or("is_reconstructed").alias("is_reconstructed"),
    )
    median = F.percentile_approx(price, 0.5, accuracy).cast("decimal(10,2)").alias("median_unit_price")
    slim = products.select(F.col("snapshot_date").alias("_day"), F.col("category_slug").alias("_slug"), "unit_price")
    medians = slim.groupBy("_day", "_slug").agg(median).unionByName(
        slim.groupBy("_day").agg(median).withColumn("_slug", F.lit(K.TOTAL_SLUG)))
    kpi = with_total(
        sums, "snapshot_date", "category_slug",
        [
            F.sum("nb_products").alias("nb_products"),
            X.ratio(F.sum("_price"), F.sum("_priced"), 10, 2).alias("avg_unit_price"),
            F.min("_low").cast("decimal(10,2)").alias("min_unit_price"),
            F.max("_high").cast("decimal(10,2)").alias("max_unit_price"),
            F.sum("_price").cast(MONEY_TOTAL).alias("catalog_value"),
            X.ratio(F.sum("_rating"), F.sum("_rated"), 4, 3).alias("avg_rating_simple"),
            X.ratio(F.sum("_weighted"), F.sum("_reviews"), 4, 3).alias("avg_rating_weighted"),
            F.sum("_reviews").cast("bigint").alias("total_reviews"),
            F.sum("nb_complete_products").alias("nb_complete_products"),
            F.bool_or("is_reconstructed").alias("is_reconstructed"),
        ],
        label=F.max("category_label"), total_label=K.ALL_CATALOGUE_LABEL,
    )
    kpi = kpi.join(medians, F.col("snapshot_date").eqNullSafe(F.col("_day"))
                   & F.col("category_slug").eqNullSafe(F.col("_slug"))).drop("_day", "_slug")
    complete = F.col("nb_complete_products").cast("decimal(20,0)")
    before = lagged("total_reviews", "category_slug", "snapshot_date")
    return kpi.select(
        "snapshot_date", "category_slug", "category_label", "nb_products", "avg_unit_price",
        "median_unit_price", "min_unit_price", "max_unit_price", "catalog_value",
        X.ratio(F.col("max_unit_price"), F.col("min_unit_price"), 10, 2).alias("price_spread_ratio"),
        "avg_rating_simple", "avg_rating_weighted", "total_reviews",
        (F.col("total_reviews") - before).alias("new_reviews"),
        "nb_complete_products",
        X.pct(complete, F.col("nb_products"), 5, 1).alias("catalog_completeness_pct"),
        "is_reconstructed",
    )


def price_trend(products: DataFrame) -> DataFrame:
    """Product x day: change, moving averages, volatility, promotions and window extremes.

    A window holds one row per day of a product, and one shuffle by product serves all of them.
    """
    key, day, price = "product_id", "snapshot_date", F.col("unit_price")
    ordered = Window.partitionBy(key).orderBy(day)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    windows = products.withColumns({
        "_prev": F.lag("unit_price").over(ordered),
        "_first": F.first("unit_price").over(whole),
        "_ma7": moving("unit_price", key, day, 7),
        "_ma30": moving("unit_price", key, day, 30),
        "_std30": moving("unit_price", key, day, 30, F.stddev_samp),
        "_low": F.min("unit_price").over(whole),
        "_high": F.max("unit_price").over(whole),
        "day_rank": F.row_number().over(ordered).cast("bigint"),
    })
    prev, first, ma30 = F.col("_prev"), F.col("_first"), F.col("_ma30")
    falling = (price < ma30 * F.lit("0.95").cast("decimal(3,2)")) & prev.isNotNull() & (price < prev)
    return windows.select(
        *products.columns,
        X.money(prev).alias("price_prev_day"),
        X.change_pct(price, prev, 8).alias("price_dod_pct"),
        F.round("_ma7", 2).try_cast("decimal(10,2)").alias("price_ma7"),
        F.round(ma30, 2).try_cast("decimal(10,2)").alias("price_ma30"),
        F.round(F.coalesce("_std30", F.lit(0.0)), 3).try_cast("decimal(10,3)")
        .alias("price_volatility_30d"),
        X.change_pct(price, ma30, 8).alias("price_vs_ma30_pct"),
        falling.alias("is_promotion"),
        X.pct(price, first, 8, 2).alias("price_index_100"),
        X.change_pct(price, first, 8).alias("cumulative_change_pct"),
        X.money(F.col("_low")).alias("price_min_window"),
        X.money(F.col("_high")).alias("price_max_window"),
        (price == F.col("_low")).alias("is_window_low"),
        "day_rank",
    )


def priced_lines(
    lines: DataFrame, products: DataFrame, price_date: str = "order_date", salts: int = 1
) -> DataFrame:
    """Order lines valued at the price of their day."""
    valued = temporal_snapshot_join(
        lines, products, "product_id", price_date, "snapshot_date", salts, ["order_id"]
    )
    revenue = (F.col("quantity") * F.col("unit_price")).try_cast("decimal(14,2)")
    return valued.withColumn("line_revenue", revenue)


def sales_value(lines: DataFrame, products: DataFrame, price_date: str = "order_date") -> DataFrame:
    """Lines, items, revenue and price level per day x category and TOTAL.

    Lines are summed per (day, product) before prices are joined: the join meets each product
    once a day, however often it was sold, and the distinct products of a day are its rows.
    `price_date` must follow from `order_date`, such as its month.
    """
    bought = lines.groupBy(*dict.fromkeys(("order_date", price_date, "product_id"))).agg(
        F.count("*").alias("_lines"), F.sum("quantity").alias("_items")
    )
    price = products.select(
        "product_id", "snapshot_date", "unit_price", "category_slug", "category_label", "rating_score"
    )
    valued = temporal_snapshot_join(bought, price, "product_id", price_date, "snapshot_date")
    n, unit_price, rating = F.col("_lines"), F.col("unit_price"), F.col("rating_score")
    # Everything but the ratios adds up, so TOTAL and labels come from these few sums.
    sums = _named(valued).groupBy("order_date", "category_slug", "category_label").agg(
        F.sum(n).alias("nb_order_lines"),
        F.sum("_items").alias("nb_items_sold"),
        F.count("product_id").alias("nb_distinct_products"),
        F.sum((F.col("_items") * unit_price).try_cast(MONEY_TOTAL)).cast(MONEY_TOTAL).alias("revenue"),
        F.sum(unit_price * n).alias("_price"),
        F.sum(F.when(unit_price.isNotNull(), n)).alias("_priced"),
        F.sum(rating * n).alias("_rating"),
        F.sum(F.when(rating.isNotNull(), n)).alias("_rated"),
        F.sum(F.when(F.col("is_unmatched"), n).otherwise(F.lit(0))).alias("nb_unmatched_lines"),
    )
    added = ("nb_order_lines", "nb_items_sold", "nb_distinct_products", "nb_unmatched_lines")
    return with_total(
        sums, "order_date", "category_slug",
        [
            *[F.sum(c).alias(c) for c in added],
            F.sum("revenue").cast(MONEY_TOTAL).alias("revenue"),
            X.ratio(F.sum("_price"), F.sum("_priced"), 10, 2).alias("avg_unit_price"),
            X.ratio(F.sum("_rating"), F.sum("_rated"), 4, 3).alias("avg_rating_sold"),
        ],
        label=F.coalesce(F.max("category_label"), F.lit(K.UNMATCHED_LABEL)),
        total_label=K.ALL_SALES_LABEL,
    )


def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("category_slug", F.coalesce("category_slug", F.lit(K.UNKNOWN_SLUG)))


#: What a row of the daily sums stands for: an order, a customer or a product of one day and category.
ORDER, CUSTOMER, PRODUCT = "o", "c", "p"


def _sold_keys(
    lines: DataFrame, products: DataFrame, price_date: str, salts: int = 1,
) -> DataFrame:
    """One row per day, category and order, customer or product sold, the products with lines, items and price.

    One aggregation serves all three kinds. It adds up before the shuffle and spreads by the keys themselves,
    so a customer or product with a third of all lines is one row a task and day.
    """
    slim = lines.select(*dict.fromkeys(
        ("order_date", price_date, "order_id", "customer_id", "product_id", "quantity")))
    price = products.select(
        "product_id", "snapshot_date", "unit_price", "category_slug", "category_label", "rating_score"
    )
    sold = _named(temporal_snapshot_join(
        slim, price, "product_id", price_date, "snapshot_date", salts, ["order_id"]))
    carried = ("category_label", "unit_price", "rating_score", "is_unmatched", "quantity")
    types = dict(sold.dtypes)

    def row(kind: str, key: str) -> Column:
        held = [(F.col(c) if kind == PRODUCT else F.lit(None).cast(types[c])).alias(c) for c in carried]
        marked = F.concat(F.lit(kind), F.col(key).cast("string"))
        return F.struct(F.lit(kind).alias("_kind"), marked.alias("_key"), *held)

    kinds = F.inline(F.array(row(ORDER, "order_id"), row(CUSTOMER, "customer_id"), row(PRODUCT, "product_id")))
    return sold.select("order_date", "category_slug", kinds).groupBy(
        "order_date", "category_slug", "_kind", "_key", *carried[:-1]
    ).agg(F.count("*").alias("_lines"), F.sum("quantity").alias("_items"))


def sales_totals(
    lines: DataFrame, products: DataFrame, customers: DataFrame, *,
    price_date: str = "order_date", customer_date: str | None = "snapshot_date", salts: int = 1,
) -> DataFrame:
    """Day x category and TOTAL, only for days with orders.

    `customer_date` names the snapshot day of `customers`, None for an undated dimension. Distinct orders,
    customers, products and cities are counted as rows; the TOTAL counts a key under its first category of the day,
    in the partitioning that the join with customers needs anyway.
    """
    keyed = _sold_keys(lines, products, price_date, salts)
    place = customers.select(
        F.concat(F.lit(CUSTOMER), F.col("customer_id").cast("string")).alias("_key"),
        *([F.col(customer_date).alias("order_date")] if customer_date else []), "city")
    located = keyed.join(place, ["order_date", "_key"] if customer_date else ["_key"], "left")
    own = Window.partitionBy("order_date", "_key").orderBy("category_slug")
    n, unit_price, rating = F.col("_lines"), F.col("unit_price"), F.col("rating_score")
    kind, known = F.col("_kind"), F.col("_key").isNotNull()
    once = located.withColumn("_first", F.row_number().over(own) == 1)
    # A city counts once a day in the TOTAL: its customers go there as rows of their own.
    to_total = F.when(kind == CUSTOMER, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    spread = once.withColumn("_total", F.explode(to_total))
    keys = spread.groupBy(
        "order_date", "_total", F.when(~F.col("_total"), F.col("category_slug")).alias("category_slug"), "_kind",
        F.when(kind == CUSTOMER, F.col("city")).when(kind == PRODUCT, F.col("category_label")).alias("_tag"),
    ).agg(
        F.count_if(known).alias("_keys"),
        F.count_if(known & F.col("_first")).alias("_firsts"),
        F.sum(F.when(kind == PRODUCT, n)).alias("nb_order_lines"),
        F.sum("_items").alias("nb_items_sold"),
        F.sum((F.col("_items") * unit_price).try_cast(MONEY_TOTAL)).cast(MONEY_TOTAL).alias("revenue"),
        F.sum(unit_price * n).alias("_price"),
        F.sum(F.when(unit_price.isNotNull(), n)).alias("_priced"),
        F.sum(rating * n).alias("_rating"),
        F.sum(F.when(rating.isNotNull(), n)).alias("_rated"),
        F.sum(F.when(F.col("is_unmatched"), n).otherwise(F.lit(0))).alias("nb_unmatched_lines"),
    )
    # A few sums per day, category and city or label are left: each adds to its category and to the TOTAL.
    sums = keys.withColumnRenamed("_total", "_of_total").withColumn(
        "_total", F.explode(F.when(F.col("_of_total"), F.array(F.lit(True))).otherwise(
            F.array(F.lit(False), F.lit(True)))))
    own_row, total = ~F.col("_of_total"), F.col("_total")

    def counted(of: str) -> Column:
        return F.sum(F.when((kind == of) & own_row, F.when(total, F.col("_firsts")).otherwise(F.col("_keys")))
                     .otherwise(F.lit(0)))

    label = F.coalesce(F.max(F.when(kind == PRODUCT, F.col("_tag"))), F.lit(K.UNMATCHED_LABEL))
    found = sums.groupBy(
        "order_date", "_total", F.when(~total, F.col("category_slug")).alias("_slug")
    ).agg(
        counted(ORDER).alias("nb_orders"),
        counted(CUSTOMER).alias("nb_active_customers"),
        counted(PRODUCT).alias("nb_distinct_products"),
        F.count_if((kind == CUSTOMER) & (F.col("_of_total") == total) & F.col("_tag").isNotNull()).alias("nb_cities"),
        *[F.sum(c).alias(c) for c in ("nb_order_lines", "nb_items_sold", "nb_unmatched_lines")],
        F.sum("revenue").cast(MONEY_TOTAL).alias("revenue"),
        X.ratio(F.sum("_price"), F.sum("_priced"), 10, 2).alias("avg_unit_price"),
        X.ratio(F.sum("_rating"), F.sum("_rated"), 4, 3).alias("avg_rating_sold"),
        label.alias("_label"),
    )
    return found.withColumns({
        "category_slug": F.when(total, F.lit(K.TOTAL_SLUG)).otherwise(F.col("_slug")),
        "category_label": F.when(total, F.lit(K.ALL_SALES_LABEL)).otherwise(F.col("_label")),
    }).drop("_total", "_slug", "_label")


COUNTS = (
    "nb_orders", "nb_order_lines", "nb_items_sold", "nb_active_customers", "nb_distinct_products",
    "nb_cities", "nb_unmatched_lines",
)


def complete_series(totals: DataFrame, bounds: tuple[Column, Column]) -> DataFrame:
    """Every category on every day, zero where nothing was sold."""
    zeros = {c: F.lit(0).cast("bigint") for c in COUNTS}
    zeros["revenue"] = F.lit(0).cast(MONEY_TOTAL)
    return calendar_fill(
        totals, "order_date", "category_slug", bounds, zeros, same_per_category=["category_label"]
    )


def day_bounds(df: DataFrame, day: str) -> tuple[Column, Column]:
    """First and last day of the data from one scalar subquery over that column."""
    span = df.agg(F.struct(F.min(day).alias("low"), F.max(day).alias("high")).alias("span"))
    found = span.select("span").scalar()
    return found.getField("low"), found.getField("high")


def sales_by_category(
    lines: DataFrame, products: DataFrame, customers: DataFrame, *,
    price_date: str = "order_date", customer_date: str | None = "snapshot_date",
    bounds: tuple[Column, Column] | None = None, salts: int = 1,
) -> DataFrame:
    """Calendar-complete daily sales with moving average, month-to-date and week-on-week change."""
    totals = sales_totals(
        lines, products, customers,
        price_date=price_date, customer_date=customer_date, salts=salts,
    )
    return sales_series(totals, bounds or day_bounds(lines, "order_date"))


def sales_series(totals: DataFrame, bounds: tuple[Column, Column] | None = None) -> DataFrame:
    """The daily sales table out of the totals of single days, which may be stored and replaced day by day."""
    series = complete_series(totals, bounds or day_bounds(totals, "order_date"))
    dated = calendar_attributes(series, "order_date")
    revenue, orders = F.col("revenue"), F.col("nb_orders")
    keys = ("category_slug", "order_date")
    windows = dated.withColumns({
        "_ma7": moving("revenue", *keys, 7),
        "_mtd": running_in_month("revenue", *keys),
        "_week_ago": lagged("revenue", *keys, 7),
    })
    return windows.select(
        "order_date", "category_slug", "category_label", "year", "month", "week_of_year",
        "day_name", "is_weekend", "nb_orders", "nb_order_lines", "nb_items_sold",
        "nb_active_customers", "nb_distinct_products", "nb_cities", "revenue", "avg_unit_price",
        "avg_rating_sold",
        X.ratio(revenue, orders, 12, 2).alias("avg_order_value"),
        X.ratio(F.col("nb_items_sold").cast("decimal(20,0)"), orders, 8, 2)
        .alias("avg_items_per_order"),
        F.round("_ma7", 2).cast(MONEY_TOTAL).alias("revenue_ma7"),
        F.col("_mtd").cast(MONEY_TOTAL).alias("revenue_mtd"),
        X.change_pct(revenue, F.col("_week_ago")).alias("revenue_wow_pct"),
        "nb_unmatched_lines",
    )


def customer_activity(lines: DataFrame) -> DataFrame:
    """Orders, items and active months per customer, from one row per order."""
    orders = lines.groupBy("customer_id", "order_id", "order_date").agg(
        F.count("*").alias("_lines"), F.sum("quantity").alias("_items")
    )
    return orders.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("nb_orders"),
        F.sum("_lines").alias("nb_order_lines"),
        F.sum("_items").alias("nb_items"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.count_distinct(F.trunc("order_date", "month")).alias("nb_active_months"),
    )


def customer_totals(
    lines: DataFrame, products: DataFrame, price_date: str = "order_date"
) -> DataFrame:
    """Per customer: activity and variety from the lines alone, value from lines summed per
    product first, so prices are joined to one row per (customer, product, day)."""
    variety = lines.select("customer_id", "product_id").distinct().groupBy("customer_id").agg(
        F.count("product_id").alias("nb_distinct_products")
    )
    value = customer_value(lines, products, price_date)
    return customer_activity(lines).join(variety, "customer_id").join(value, "customer_id", "left")


def category_value(
    lines: DataFrame, products: DataFrame, price_date: str = "order_date"
) -> DataFrame:
    """Revenue and ratings per (customer, category); unmatched lines under a NULL category."""
    return _per_category(_product_value(lines, products, price_date, ["customer_id", "product_id", price_date]))


def _product_value(lines: DataFrame, products: DataFrame, price_date: str, keys: list[str]) -> DataFrame:
    """Revenue and ratings per key; the keys hold the product and the day of its price."""
    bought = lines.groupBy(*dict.fromkeys(keys)).agg(F.sum("quantity").alias("_items"), F.count("*").alias("_lines"))
    price = products.select(
        "product_id", "snapshot_date", "unit_price", "category_slug", "category_label", "rating_score"
    )
    valued = temporal_snapshot_join(bought, price, "product_id", price_date, "snapshot_date")
    return valued.withColumns({
        "_revenue": (F.col("_items") * F.col("unit_price")).try_cast(MONEY_TOTAL),
        "_rating": F.col("rating_score") * F.col("_lines"),
        "_rated": F.when(F.col("rating_score").isNotNull(), F.col("_lines")),
    })


def _per_category(valued: DataFrame) -> DataFrame:
    return valued.groupBy("customer_id", "category_slug", "category_label").agg(
        *[F.sum(c).alias(c) for c in ("_revenue", "_rating", "_rated")])


def customer_parts(lines: DataFrame, products: DataFrame, price_date: str = "order_date") -> tuple[DataFrame, DataFrame]:
    """What single days add to customers, to be stored by `order_date` and replaced day by day: orders per customer, and
    value per customer and product. An order has one day."""
    orders = lines.groupBy("order_date", "customer_id", "order_id").agg(
        F.count("*").alias("_lines"), F.sum("quantity").alias("_items"))
    value = _product_value(lines, products, price_date, ["order_date", price_date, "customer_id", "product_id"])
    return (orders.groupBy("order_date", "customer_id").agg(
                F.count("order_id").alias("nb_orders"), F.sum("_lines").alias("nb_order_lines"),
                F.sum("_items").alias("nb_items")),
            value.select("order_date", "customer_id", "product_id", "category_slug", "category_label",
                         "_revenue", "_rating", "_rated"))


def totals_of_parts(orders: DataFrame, value: DataFrame) -> DataFrame:
    """The totals per customer that `customer_totals` gives, out of stored parts."""
    months = F.size(F.collect_set(F.trunc("order_date", "month"))).cast("bigint")
    activity = orders.groupBy("customer_id").agg(
        *[F.sum(c).alias(c) for c in ("nb_orders", "nb_order_lines", "nb_items")],
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"),
        months.alias("nb_active_months"))
    variety = value.select("customer_id", "product_id").distinct().groupBy("customer_id").agg(
        F.count("product_id").alias("nb_distinct_products"))
    return (activity.join(variety, "customer_id")
            .join(value_per_customer(_per_category(value)), "customer_id", "left"))


def favorite_category(by_category: DataFrame) -> DataFrame:
    """Category label with the largest revenue of each customer, ties to the smaller label."""
    labelled = by_category.where(F.col("category_label").isNotNull()).groupBy(
        "customer_id", "category_label"
    ).agg(F.sum("_revenue").alias("category_revenue"))
    best = dedup_latest(
        labelled, ["customer_id"], [F.col("category_revenue").desc(), F.col("category_label")]
    )
    return best.withColumnRenamed("category_label", "favorite_category")


def customer_value(
    lines: DataFrame, products: DataFrame, price_date: str = "order_date"
) -> DataFrame:
    return value_per_customer(category_value(lines, products, price_date))


def value_per_customer(by_category: DataFrame) -> DataFrame:
    """Value, variety of categories and favourite out of rows per (customer, category)."""
    labels = Window.partitionBy("customer_id", "category_label")
    # A customer has at most one row per category here, so these windows stay small.
    named = by_category.withColumn(
        "_label_revenue",
        F.when(F.col("category_label").isNotNull(), F.sum("_revenue").over(labels)),
    )
    rank = F.struct(
        F.col("category_label").isNotNull().alias("known"), F.col("_label_revenue").alias("revenue")
    )
    best = Window.partitionBy("customer_id").orderBy(rank.desc(), F.col("category_label"))
    flagged = named.withColumn("_favorite", F.first("category_label").over(best))
    return flagged.groupBy("customer_id").agg(
        F.count_distinct("category_slug").alias("nb_distinct_categories"),
        F.sum("_revenue").cast(MONEY_TOTAL).alias("lifetime_value"),
        X.ratio(F.sum("_rating"), F.sum("_rated"), 4, 3).alias("avg_rating_purchased"),
        F.max("_favorite").alias("favorite_category"),
    )


def segment(never: Column, r: Column, f: Column, m: Column) -> Column:
    recent, valuable = r >= 3, m >= 3
    return (
        F.when(never, K.SEGMENT_NEVER)
        .when(recent & (f >= 3) & valuable, K.SEGMENT_CHAMPION)
        .when(recent & valuable, K.SEGMENT_LOYAL)
        .when(recent, K.SEGMENT_ACTIVE)
        .when(r == 2, K.SEGMENT_REACTIVATE)
        .otherwise(K.SEGMENT_AT_RISK)
    )


def rfm(base: DataFrame, id_col: str = "customer_id", rank_buyers_only: bool = False) -> DataFrame:
    """Quartile scores of recency, frequency and value; 0 without orders.

    By default everyone is ranked, never-buyers included, and ties fall to the id.
    """
    never = F.col("nb_orders") == 0
    rankings = {
        "r_score": (F.col("recency_days"), True),
        "f_score": (F.col("nb_orders"), False),
        "m_score": (F.col("lifetime_value"), False),
    }
    if rank_buyers_only:
        buyers = ntile_scores(base.where(~never), id_col, rankings, 4)
        others = base.where(never).withColumns({name: F.lit(0) for name in rankings})
        scored = buyers.unionByName(others)
    else:
        ranked = ntile_scores(base, id_col, rankings, 4)
        scored = ranked.withColumns(
            {name: F.when(never, F.lit(0)).otherwise(F.col(name)) for name in rankings}
        )
    r, f, m = (F.col(name) for name in rankings)
    return scored.withColumns({
        "rfm_score": F.concat(r.cast("string"), f.cast("string"), m.cast("string")),
        "customer_segment": segment(never, r, f, m),
    })


def customer_base(
    customers: DataFrame, lines: DataFrame, products: DataFrame, price_date: str = "order_date"
) -> DataFrame:
    """Newest profile of every customer with its order totals."""
    newest = lines.agg(F.max("order_date").alias("newest")).select("newest").scalar()
    return with_profile(customers, customer_totals(lines, products, price_date), newest)


def with_profile(customers: DataFrame, totals: DataFrame, newest: Column) -> DataFrame:
    """Every customer's newest profile beside its totals; `newest` is the newest day with orders."""
    profile = customers
    if "snapshot_date" in customers.columns:
        profile = latest_state(customers, "customer_id", "snapshot_date").withColumnRenamed(
            "snapshot_date", "profile_snapshot_date"
        )
    zero = ("nb_orders", "nb_order_lines", "nb_items", "nb_distinct_products",
            "nb_distinct_categories", "nb_active_months")
    joined = profile.join(totals, "customer_id", "left")
    value = F.coalesce("lifetime_value", F.lit(0).cast(MONEY_TOTAL))
    return joined.withColumns({
        **{c: F.coalesce(c, F.lit(0).cast("bigint")) for c in zero},
        "avg_order_value": X.ratio(value, F.col("nb_orders"), 12, 2),
        "lifetime_value": value,
        "recency_days": F.datediff(newest, F.col("last_order_date")).cast("bigint"),
        "customer_lifespan_days":
            F.datediff("last_order_date", "first_order_date").cast("bigint"),
    })


def customer_360(
    customers: DataFrame, lines: DataFrame, products: DataFrame, *,
    price_date: str = "order_date", rank_buyers_only: bool = False,
) -> DataFrame:
    """Customer profile, order totals, RFM scores and segment.

    The base is written once: ranking and scoring read it without repeating the joins.
    """
    base = materialise(customer_base(customers, lines, products, price_date), "customer-base")
    return rfm(base, "customer_id", rank_buyers_only)
