"""Product snapshots: indicators, trends, latest states and the product builder."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from .. import functions as X
from ..operators import dedup, lagged, moving, versions, with_total
from ..plans import analytics as A
from ..plans import gold as G
from ..plans import silver as S
from .core import cents, half_up, query, quotient, scaled, table
from .fixtures import month, price_series, product_snapshots, with_fx

SNAP = "fx_product_snapshots"


def _kpi_measures() -> str:
    return f"""
        CAST(count(*) AS BIGINT) AS nb_products,
        {scaled(half_up(cents('sum(unit_price)'), 'count(unit_price)'), 10, 2)} AS avg_unit_price,
        CAST(quantile_disc(unit_price, 0.5) AS DECIMAL(10,2)) AS median_unit_price,
        CAST(min(unit_price) AS DECIMAL(10,2)) AS min_unit_price,
        CAST(max(unit_price) AS DECIMAL(10,2)) AS max_unit_price,
        CAST(sum(unit_price) AS DECIMAL(20,2)) AS catalog_value,
        {scaled(half_up('CAST(sum(rating_score)*1000 AS HUGEINT)', 'count(rating_score)'), 4, 3)} AS avg_rating_simple,
        {scaled(half_up('CAST(sum(rating_score*review_count)*1000 AS HUGEINT)', 'sum(review_count)'), 4, 3)} AS avg_rating_weighted,
        CAST(sum(review_count) AS BIGINT) AS total_reviews,
        CAST(count(*) FILTER (WHERE is_complete) AS BIGINT) AS nb_complete_products,
        bool_or(is_reconstructed) AS is_reconstructed"""


KPI = f"""
, totals AS (
    SELECT snapshot_date, category_slug, max(category_label) AS category_label, {_kpi_measures()}
    FROM fx_product_snapshots GROUP BY snapshot_date, category_slug
    UNION ALL
    SELECT snapshot_date, '{K.TOTAL_SLUG}', '{K.ALL_CATALOGUE_LABEL}', {_kpi_measures()}
    FROM fx_product_snapshots GROUP BY snapshot_date)
, kpi AS (
    SELECT snapshot_date, category_slug, category_label, nb_products, avg_unit_price, median_unit_price,
           min_unit_price, max_unit_price, catalog_value,
           {quotient(cents('max_unit_price'), cents('min_unit_price'), 10, 2)} AS price_spread_ratio,
           avg_rating_simple, avg_rating_weighted, total_reviews,
           CAST(total_reviews - lag(total_reviews) OVER (PARTITION BY category_slug ORDER BY snapshot_date) AS BIGINT) AS new_reviews,
           nb_complete_products,
           {quotient('100*nb_complete_products', 'nb_products', 5, 1)} AS catalog_completeness_pct,
           is_reconstructed
    FROM totals)"""


@query(with_fx(SNAP, KPI + "\nSELECT * FROM kpi"))
def catalog_kpi(spark, sf):
    return G.catalog_kpi(product_snapshots(spark, sf))


@query(with_fx(SNAP, KPI + f"""
SELECT snapshot_date, nb_products, avg_unit_price, median_unit_price, avg_rating_weighted, total_reviews,
       new_reviews, catalog_completeness_pct
FROM kpi WHERE category_slug = '{K.TOTAL_SLUG}' ORDER BY snapshot_date DESC LIMIT 30"""))
def q3_total_series(spark, sf):
    return A.total_series(G.catalog_kpi(product_snapshots(spark, sf)))


@query(with_fx(SNAP, f"""
SELECT category_slug, CAST(sum(review_count) AS BIGINT) AS total_reviews,
       {scaled(half_up('CAST(sum(rating_score*review_count)*1000 AS HUGEINT)', 'sum(review_count)'), 4, 3)} AS avg_rating_weighted
FROM fx_product_snapshots GROUP BY category_slug"""))
def weighted_mean(spark, sf):
    rating, weight = F.col("rating_score"), F.col("review_count")
    return product_snapshots(spark, sf).groupBy("category_slug").agg(
        F.sum(weight).alias("total_reviews"),
        X.weighted_mean(rating, weight, 4, 3).alias("avg_rating_weighted"),
    )


@query(with_fx(SNAP, f"""
, t AS (SELECT snapshot_date, category_slug, CAST(sum(review_count) AS BIGINT) AS total_reviews
        FROM fx_product_snapshots GROUP BY 1, 2
        UNION ALL
        SELECT snapshot_date, '{K.TOTAL_SLUG}', CAST(sum(review_count) AS BIGINT)
        FROM fx_product_snapshots GROUP BY 1)
SELECT *, CAST(total_reviews - lag(total_reviews) OVER (PARTITION BY category_slug ORDER BY snapshot_date) AS BIGINT) AS new_reviews
FROM t"""))
def flow_from_cumulative(spark, sf):
    totals = with_total(
        product_snapshots(spark, sf), "snapshot_date", "category_slug",
        [F.sum("review_count").alias("total_reviews")],
    )
    before = lagged("total_reviews", "category_slug", "snapshot_date")
    return totals.withColumn("new_reviews", F.col("total_reviews") - before)


MA30 = half_up(f"{cents('sum(unit_price) OVER w30')}*10000", "count(*) OVER w30")
MA7 = half_up(f"{cents('sum(unit_price) OVER w7')}*10000", "count(*) OVER w7")

TREND = f"""
, windows AS (
    SELECT *, lag(unit_price) OVER o AS prev, first_value(unit_price) OVER o AS first_price,
           {MA7} AS ma7, {MA30} AS ma30, stddev_samp(CAST(unit_price AS DOUBLE)) OVER w30 AS std30,
           min(unit_price) OVER f AS low, max(unit_price) OVER f AS high, row_number() OVER o AS day_rank
    FROM fx_price_series
    WINDOW o AS (PARTITION BY product_id ORDER BY snapshot_date),
           f AS (PARTITION BY product_id),
           w7 AS (PARTITION BY product_id ORDER BY snapshot_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
           w30 AS (PARTITION BY product_id ORDER BY snapshot_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
, trend AS (
    SELECT product_id, snapshot_date, unit_price, CAST(prev AS DECIMAL(10,2)) AS price_prev_day,
           {quotient(f"100*{cents('unit_price - prev')}", cents('prev'), 8, 2)} AS price_dod_pct,
           {scaled(half_up('ma7', '10000'), 10, 2)} AS price_ma7,
           {scaled(half_up('ma30', '10000'), 10, 2)} AS price_ma30,
           CAST(round(coalesce(std30, 0), 3) AS DECIMAL(10,3)) AS price_volatility_30d,
           {quotient(f"100*({cents('unit_price')}*10000 - ma30)", 'ma30', 8, 2)} AS price_vs_ma30_pct,
           ({cents('unit_price')}*1000000 < ma30*95 AND prev IS NOT NULL AND unit_price < prev) AS is_promotion,
           {quotient(f"100*{cents('unit_price')}", cents('first_price'), 8, 2)} AS price_index_100,
           {quotient(f"100*{cents('unit_price - first_price')}", cents('first_price'), 8, 2)} AS cumulative_change_pct,
           CAST(low AS DECIMAL(10,2)) AS price_min_window, CAST(high AS DECIMAL(10,2)) AS price_max_window,
           unit_price = low AS is_window_low, CAST(day_rank AS BIGINT) AS day_rank
    FROM windows)"""


def trend(spark, sf):
    return G.price_trend(price_series(spark, sf))


@query(with_fx("fx_price_series", TREND + "\nSELECT * FROM trend"))
def price_trend(spark, sf):
    return trend(spark, sf)


@query(with_fx("fx_price_series", TREND + f"""
SELECT product_id, min(price_min_window) AS lowest_price, max(price_max_window) AS highest_price,
       {scaled(half_up('CAST(sum(price_volatility_30d)*1000 AS HUGEINT)', 'count(price_volatility_30d)'), 10, 3)} AS avg_volatility,
       CAST(count(*) FILTER (WHERE is_promotion) AS BIGINT) AS promotion_days,
       max(cumulative_change_pct) AS max_change_pct
FROM trend GROUP BY product_id ORDER BY promotion_days DESC, avg_volatility DESC, product_id LIMIT 15"""))
def q8_price_trend_summary(spark, sf):
    return A.price_summary(trend(spark, sf), ("product_id",))


@query(with_fx("fx_price_series", TREND + """
SELECT product_id, max(price_volatility_30d) AS max_volatility,
       CAST(count(*) FILTER (WHERE is_promotion) AS BIGINT) AS promotion_days
FROM trend GROUP BY product_id ORDER BY max_volatility DESC, product_id LIMIT 5"""))
def topk_volatile(spark, sf):
    return A.most_volatile(trend(spark, sf), ("product_id",))


@query(with_fx("fx_price_series", f"""
SELECT product_id, snapshot_date, unit_price, {scaled(half_up(MA7, '10000'), 10, 2)} AS price_ma7
FROM fx_price_series
WINDOW w7 AS (PARTITION BY product_id ORDER BY snapshot_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""))
def moving_average_rows(spark, sf):
    ma = moving("unit_price", "product_id", "snapshot_date", 7)
    return price_series(spark, sf).withColumn("price_ma7", F.round(ma, 2).cast("decimal(10,2)"))


@query(with_fx(SNAP, """
SELECT * FROM fx_product_snapshots WHERE snapshot_date = (SELECT max(snapshot_date) FROM fx_product_snapshots)
ORDER BY unit_price DESC, product_id LIMIT 15"""))
def q2_latest_catalogue(spark, sf):
    return A.latest_catalogue(product_snapshots(spark, sf))


@query(with_fx(SNAP, """
SELECT * FROM fx_product_snapshots WHERE snapshot_date = (SELECT max(snapshot_date) FROM fx_product_snapshots)"""))
def latest_partition(spark, sf):
    return versions.latest_partition(product_snapshots(spark, sf), "snapshot_date")


@query(with_fx(SNAP, """
SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY snapshot_date DESC) AS rn
    FROM fx_product_snapshots) WHERE rn = 1"""))
def latest_state(spark, sf):
    return dedup.latest_state(product_snapshots(spark, sf), "product_id", "snapshot_date")


BAND = " ".join(
    f"WHEN unit_price < {b} THEN '{name}'" for b, name in zip(K.PRICE_BAND_BOUNDS, K.PRICE_BAND_LABELS)
)


@query(f"""
WITH p AS (SELECT p_partkey AS product_id, CAST((p_retailprice - 890) * 5 AS DECIMAL(10,2)) AS unit_price FROM part)
SELECT product_id, unit_price, CASE {BAND} ELSE '{K.PRICE_BAND_LABELS[-1]}' END AS price_band FROM p""")
def price_band(spark, sf):
    price = ((F.col("p_retailprice") - 890) * 5).cast("decimal(10,2)")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), price.alias("unit_price")
    ).withColumn("price_band", X.bucketize(F.col("unit_price"), K.PRICE_BAND_BOUNDS, K.PRICE_BAND_LABELS))


@query("""
SELECT p_partkey AS product_id,
       coalesce(p_name IS NOT NULL AND p_brand IS NOT NULL
                AND nullif(p_size, 7) IS NOT NULL AND length(nullif(p_name, 'red widget')) > 8, FALSE) AS is_complete
FROM part""")
def completeness_flag(spark, sf):
    name = F.nullif(F.col("p_name"), F.lit("red widget"))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        X.complete(
            F.col("p_name").isNotNull(), F.col("p_brand").isNotNull(),
            F.nullif(F.col("p_size"), F.lit(7)).isNotNull(), F.length(name) > 8,
        ).alias("is_complete"),
    )


# The model window covers the whole span of the tables.
WINDOW_DAYS = 2600


def md5_uniform(key: str, day: str, salt: str) -> str:
    text = f"concat_ws('|', CAST({key} AS VARCHAR), CAST({day} AS VARCHAR), '{salt}', '{K.HISTORY_SEED}')"
    return f"(CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE))"


def md5_pick(key: str, day: str, salt: str, buckets: str) -> str:
    """One of 1..buckets from 52 bits of the hash."""
    text = f"concat_ws('|', CAST({key} AS VARCHAR), CAST({day} AS VARCHAR), '{salt}', '{K.HISTORY_SEED}')"
    uniform = f"(CAST(('0x' || substr(md5({text}), 1, 13)) AS BIGINT) / CAST({2**52} AS DOUBLE))"
    return f"CAST(floor({uniform} * {buckets}) + 1 AS BIGINT)"


def factor_sql(key: str, day: str, anchor: str) -> str:
    last = WINDOW_DAYS - 1
    index = f"CAST(datediff('day', {anchor}, {day}) + {last} AS DOUBLE)"
    phase = f"{md5_uniform(key, chr(39) + 'static' + chr(39), 'phase')} * CAST({K.FULL_TURN} AS DOUBLE)"
    return f"""CASE WHEN {index} >= {last} THEN CAST(1 AS DOUBLE) ELSE
        greatest(CAST({K.FACTOR_FLOOR} AS DOUBLE), least(CAST({K.FACTOR_CEILING} AS DOUBLE),
            CAST(1 AS DOUBLE) + CAST(-{K.TREND_AMPLITUDE} AS DOUBLE) * (1 - {index} / CAST({last} AS DOUBLE))
            + CAST({K.SEASON_AMPLITUDE} AS DOUBLE) * sin(CAST({2.0 * K.PI} AS DOUBLE) * {index} / CAST({K.SEASON_PERIOD_DAYS} AS DOUBLE) + {phase})
            + CAST({K.JITTER_AMPLITUDE} AS DOUBLE) * ({md5_uniform(key, day, 'price')} - CAST(0.5 AS DOUBLE)))) END"""


def growth_sql(day: str, anchor: str) -> str:
    last = WINDOW_DAYS - 1
    progress = f"(greatest(datediff('day', {anchor}, {day}) + {last}, 0) / CAST({last} AS DOUBLE))"
    return (f"least(CAST(1 AS DOUBLE), CAST({K.GROWTH_START} AS DOUBLE) + CAST({K.GROWTH_SPAN} AS DOUBLE)"
            f" * pow({progress}, CAST({K.GROWTH_POWER} AS DOUBLE)))")


ANCHOR = "(SELECT max(snapshot_date) FROM fx_product_snapshots)"


@query(with_fx(SNAP, f"""
SELECT product_id, snapshot_date,
       CAST(round(CAST(unit_price AS DOUBLE) * {factor_sql('product_id', 'snapshot_date', ANCHOR)}, 2) AS DECIMAL(10,2)) AS unit_price,
       CAST(round(review_count * 1000 * {growth_sql('snapshot_date', ANCHOR)}) AS BIGINT) AS review_count
FROM fx_product_snapshots"""))
def back_project(spark, sf):
    products = product_snapshots(spark, sf)
    newest = products.agg(F.max("snapshot_date").alias("d")).select("d").scalar()
    day = F.col("snapshot_date")
    factor = X.back_projection(F.col("product_id"), day, newest, WINDOW_DAYS, method="md5")
    reached = X.growth(day, newest, WINDOW_DAYS)
    return products.select(
        "product_id", "snapshot_date",
        F.round(F.col("unit_price") * factor, 2).cast("decimal(10,2)").alias("unit_price"),
        F.round(F.col("review_count") * 1000 * reached).cast("bigint").alias("review_count"),
    )


def landed_products(spark, sf):
    """One landed product record per line: a part seen several times in a month lands repeatedly."""
    part = table(spark, sf, "part")
    lines = table(spark, sf, "lineitem").join(part, F.col("p_partkey") == F.col("l_partkey"))
    return lines.select(
        F.col("l_partkey").alias("id"),
        F.concat(F.lit("  "), F.col("p_name")).alias("title"),
        F.col("l_extendedprice").alias("price"),
        F.concat_ws(" of ", "p_name", "p_brand", "p_type").alias("description"),
        F.concat(F.col("p_type"), F.lit("'s ")).alias("category"),
        F.concat(F.lit("img/"), F.col("p_brand")).alias("image"),
        F.struct(
            (F.col("l_discount") * 50).alias("rate"), F.col("l_quantity").cast("int").alias("count")
        ).alias("rating"),
        month("l_shipdate").alias("_ingest_date"),
        F.col("l_shipdate").alias("_ingest_ts"),
        F.concat_ws("/", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice",
                    F.col("l_quantity").cast("int"), F.round(F.col("l_discount") * 100).cast("int"),
                    F.round(F.col("l_tax") * 100).cast("int")).alias("_source_file"),
        F.concat_ws("/", "l_returnflag", "l_linestatus").alias("_record_hash"),
        (F.col("l_returnflag") != "R").alias("_is_valid"),
    )


LANDED = """
, landed AS (
    SELECT l.l_partkey AS id, '  ' || p_name AS title, l_extendedprice AS price,
           concat_ws(' of ', p_name, p_brand, p_type) AS description, p_type || '''s ' AS category,
           'img/' || p_brand AS image, l_discount * 50 AS rate, CAST(l_quantity AS INT) AS cnt,
           CAST(date_trunc('month', l_shipdate) AS DATE) AS _ingest_date, l_shipdate AS _ingest_ts,
           concat_ws('/', l_orderkey, l_linenumber, l_suppkey, l_extendedprice, CAST(l_quantity AS INT),
                     CAST(round(l_discount * 100) AS INT), CAST(round(l_tax * 100) AS INT)) AS _source_file,
           concat_ws('/', l_returnflag, l_linestatus) AS _record_hash
    FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey WHERE l_returnflag <> 'R')
, newest AS (SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id, _ingest_date
                                 ORDER BY _ingest_ts DESC, _source_file DESC, _record_hash) AS rn FROM landed)
    WHERE rn = 1)"""

LAND_ANCHOR = "(SELECT max(CAST(date_trunc('month', l_shipdate) AS DATE)) FROM lineitem)"


@query("WITH one AS (SELECT 1)" + LANDED + f"""
, base AS (SELECT *, CAST(price AS DECIMAL(10,2)) AS observed FROM newest)
SELECT sha256(concat_ws('|', 'product', CAST(id AS VARCHAR), CAST(_ingest_date AS VARCHAR))) AS product_sk,
       id AS product_id, _ingest_date AS snapshot_date, trim(title) AS title,
       lower(trim(category)) AS category_slug,
       upper(substr(category, 1, 1)) || lower(replace(substr(trim(category), 2, length(trim(category)) - 3), '''', ' ')) || ' S' AS category_label,
       observed AS unit_price_observed, cnt AS review_count_observed,
       CAST(round(CAST(observed AS DOUBLE) * {factor_sql('id', '_ingest_date', LAND_ANCHOR)}, 2) AS DECIMAL(10,2)) AS unit_price,
       CAST(round(cnt * {growth_sql('_ingest_date', LAND_ANCHOR)}) AS INT) AS review_count,
       rate AS rating_score,
       CASE {BAND.replace('unit_price', 'observed')} ELSE '{K.PRICE_BAND_LABELS[-1]}' END AS price_band,
       CAST(length(trim(description)) AS INT) AS description_length, image AS image_url,
       length(trim(description)) > 30 AS is_complete, TRUE AS is_reconstructed,
       _ingest_ts AS source_ingest_ts, _record_hash AS source_record_hash
FROM base""")
def dim_products(spark, sf):
    anchor = table(spark, sf, "lineitem").agg(F.max(month("l_shipdate")).alias("d")).select("d").scalar()
    return S.dim_products(
        landed_products(spark, sf), anchor, days=WINDOW_DAYS, method="md5"
    ).drop("silver_ts")
