"""The raw zone round trip: parts and customers are landed as JSON objects and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import nested
from ..operators.rules import CORRUPT, apply_rules, domain_rules, reject_breakdown as breakdown
from ..plans import analytics as A
from ..plans import bronze as B
from ..plans import silver as S
from ..session import scratch_path
from ..sources import raw as R
from ..sources import tables as T
from .core import query, table
from .fixtures import customers

RECORDS_PER_OBJECT = 500
FIRST_DAY = "2024-01-01"
FIRST_MILLIS = 1704067200123

_written: dict[tuple[str, str, str], str] = {}


def _object(key):
    return F.floor(F.col(key) / RECORDS_PER_OBJECT).cast("bigint")


def part_records(spark, sf):
    """Part rows as product JSON. Some sizes stand for a broken price, a missing or a negative
    one, or a missing title."""
    size = F.col("p_size") % 10
    price = F.col("p_retailprice").cast("string")
    text = (
        F.when(size == 3, F.lit('"n/a"')).when(size == 0, F.lit("null"))
        .when(size == 1, F.concat(F.lit("-"), price)).otherwise(price)
    )
    title = F.when(size == 2, F.lit("null")).otherwise(F.concat(F.lit('"'), F.col("p_name"), F.lit('"')))
    json = F.concat(
        F.lit('{"id":'), F.col("p_partkey"), F.lit(',"title":'), title, F.lit(',"price":'), text,
        F.lit(',"description":"'), F.col("p_brand"), F.lit('","category":"'), F.col("p_type"),
        F.lit('","image":"'), F.col("p_brand"), F.lit('","rating":{"rate":'), F.col("p_size"),
        F.lit(',"count":'), F.col("p_size"), F.lit("}}"),
    )
    return table(spark, sf, "part").select(_object("p_partkey").alias("object_no"), json.alias("record"))


def customer_records(spark, sf):
    """Customer rows as user JSON. Some cities stand for a missing or malformed e-mail."""
    nation = F.col("city")
    email = F.when(nation == "NATION_0", F.lit(None)).when(
        nation == "NATION_1", F.replace(F.col("email"), F.lit("@"), F.lit(" at "))
    ).otherwise(F.col("email"))
    record = F.struct(
        F.col("customer_id").alias("id"), email.alias("email"), F.col("full_name").alias("username"),
        F.concat(F.lit("secret-"), F.col("customer_id").cast("string")).alias("password"),
        F.struct(F.col("email_domain").alias("firstname"), F.col("full_name").alias("lastname")).alias("name"),
        F.struct(
            F.struct(
                (F.col("customer_id") % 100).cast("string").alias("lat"),
                F.concat(F.lit("-"), (F.col("customer_id") % 170).cast("string")).alias("long"),
            ).alias("geolocation"),
            F.col("city"), F.lit("main street").alias("street"),
            (F.col("customer_id") % 90).cast("int").alias("number"), F.lit("12345").alias("zipcode"),
        ).alias("address"),
        F.concat(F.lit("1-"), F.lpad(F.col("customer_id").cast("string"), 9, "0")).alias("phone"),
        F.lit(0).alias("__v"),
    )
    return customers(spark, sf).select(
        _object("customer_id").alias("object_no"), F.to_json(record).alias("record")
    )


def _write_zone(spark, records, domain: str, root: str) -> None:
    """One object per block of at most RECORDS_PER_OBJECT consecutive keys."""
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("object_no") % 7).cast("int")).cast("string")
    name = F.concat_ws(
        "_", F.lit(domain), day, (F.col("object_no") * 1000 + FIRST_MILLIS).cast("string"),
        F.md5(F.col("object_no").cast("string")),
    )
    objects = records.groupBy("object_no").agg(
        F.concat(F.lit("["), F.concat_ws(",", F.collect_list("record")), F.lit("]")).alias("value")
    )
    objects.select(
        "value", day.alias("ingest_date"), F.concat(name, F.lit(".json")).alias("object")
    ).write.partitionBy("ingest_date", "object").text(f"{root}/{domain}")


RECORDS = {"products": part_records, "users": customer_records}


def zone(spark, sf, domain: str) -> str:
    """Root of a raw zone holding the domain, written once per session and data set."""
    key = (spark.sparkContext.applicationId, sf, domain)
    if key not in _written:
        root = scratch_path(spark, "raw")
        _write_zone(spark, RECORDS[domain](spark, sf), domain, root)
        _written[key] = root
    return _written[key]


def landed(spark, sf, domain: str):
    return R.read_raw(spark, f"{zone(spark, sf, domain)}/{domain}", domain)


def object_path():
    """Spark names files itself, so each object is a folder carrying the object's name."""
    return F.regexp_replace("_source_file", "/object=([^/]+)/[^/]+$", "/$1")


def bronze_products(spark, sf):
    return B.bronze(landed(spark, sf, "products"), "products", "batch-1", object_path()).withColumn(
        "_source_file", object_path()
    )


def bronze_users(spark, sf):
    return B.bronze(landed(spark, sf, "users"), "users", "batch-1", object_path())


BROKEN = "p_size % 10 = 3"
PARTS = f"""
WITH parts AS (
    SELECT p_partkey AS id, CASE WHEN p_size % 10 = 2 THEN NULL ELSE p_name END AS title,
           CASE WHEN p_size % 10 IN (0, 3) THEN NULL WHEN p_size % 10 = 1 THEN -p_retailprice
                ELSE p_retailprice END AS price,
           p_brand AS description, p_type AS category, CAST(p_size AS DOUBLE) AS rating_rate,
           p_size AS rating_count, {BROKEN} AS is_corrupt, p_partkey // {RECORDS_PER_OBJECT} AS object_no
    FROM part)
, judged AS (
    SELECT *, CASE WHEN is_corrupt THEN '{K.REASON_UNREADABLE}' WHEN title IS NULL THEN '{K.REASON_NO_TITLE}'
                   WHEN price IS NULL THEN '{K.REASON_NO_PRICE}' WHEN price < 0 THEN '{K.REASON_NEGATIVE_PRICE}' END AS reason,
           CAST(DATE '{FIRST_DAY}' + CAST(object_no % 7 AS INT) AS DATE) AS day,
           CAST(object_no * 1000 + {FIRST_MILLIS} AS BIGINT) AS millis
    FROM parts)
, named AS (
    SELECT *, concat('products_', CAST(day AS VARCHAR), '_', CAST(millis AS VARCHAR), '_',
                     md5(CAST(object_no AS VARCHAR)), '.json') AS object_name FROM judged)
"""


@query(PARTS + """
SELECT id, title, price, description, category, rating_rate, CAST(rating_count AS INT) AS rating_count, is_corrupt
FROM parts""")
def raw_json_scan(spark, sf):
    return landed(spark, sf, "products").select(
        "id", "title", "price", "description", "category", F.col("rating.rate").alias("rating_rate"),
        F.col("rating.count").alias("rating_count"), F.col(CORRUPT).isNotNull().alias("is_corrupt"),
    )


@query(PARTS + """
SELECT 'products' AS domain, day AS ingest_date, CAST(count(DISTINCT object_no) AS BIGINT) AS n_objects
FROM named GROUP BY day""")
def raw_inventory(spark, sf):
    return R.raw_inventory(spark, zone(spark, sf, "products")).drop("n_bytes")


@query(PARTS + "SELECT id, object_name, day AS ingest_date, millis AS called_at_ms FROM named")
def bronze_provenance(spark, sf):
    traced = R.provenance(landed(spark, sf, "products"), object_path())
    return traced.select(
        "id", F.regexp_replace(object_path(), "^.*/", "").alias("object_name"),
        F.col("_ingest_date").alias("ingest_date"),
        F.unix_millis("_ingest_ts").alias("called_at_ms"),
    )


@query(PARTS + """
SELECT id, title, price, category, day AS _ingest_date, millis AS called_at_ms, 'batch-1' AS _batch_id,
       object_name, reason IS NULL AS _is_valid, reason AS _reject_reason
FROM named""")
def bronze_ingest(spark, sf):
    return B.dated_or_fail(bronze_products(spark, sf)).select(
        "id", "title", "price", "category", "_ingest_date",
        F.unix_millis("_ingest_ts").alias("called_at_ms"), "_batch_id",
        F.regexp_replace("_source_file", "^.*/", "").alias("object_name"), "_is_valid",
        "_reject_reason",
    )


@query(PARTS + """
SELECT id AS product_id, title, price, category, rating_rate, CAST(rating_count AS INT) AS rating_count,
       day AS snapshot_date, millis AS called_at_ms, reason IS NULL AS is_valid, object_name
FROM named WHERE day = (SELECT max(day) FROM named) ORDER BY product_id, object_name LIMIT 10""")
def q1_bronze_trace(spark, sf):
    return A.bronze_trace(bronze_products(spark, sf)).withColumn(
        "called_at", F.unix_millis("called_at")
    ).withColumnRenamed("called_at", "called_at_ms")


@query(PARTS + "SELECT id, reason IS NULL AS is_valid FROM judged")
def validity_flags(spark, sf):
    flagged = apply_rules(landed(spark, sf, "products"), domain_rules("products"))
    return flagged.select("id", F.col("_is_valid").alias("is_valid"))


USERS = f"""
WITH users AS (
    SELECT c_custkey AS id, n_name AS city, lower(c_mktsegment) AS segment, c_name,
           CASE n_name WHEN 'NATION_0' THEN NULL
                WHEN 'NATION_1' THEN concat(lower(replace(c_name, '#', '.')), ' at ', lower(c_mktsegment), '.example')
                ELSE concat(lower(replace(c_name, '#', '.')), '@', lower(c_mktsegment), '.example') END AS email,
           c_custkey // {RECORDS_PER_OBJECT} AS object_no
    FROM customer JOIN nation ON n_nationkey = c_nationkey)
"""


@query(USERS + f"""
SELECT id, CASE WHEN email IS NULL THEN '{K.REASON_NO_EMAIL}' WHEN email NOT LIKE '%@%' THEN '{K.REASON_BAD_EMAIL}' END AS reject_reason
FROM users""")
def reject_reason(spark, sf):
    flagged = apply_rules(landed(spark, sf, "users"), domain_rules("users"))
    return flagged.select("id", F.col("_reject_reason").alias("reject_reason"))


@query(PARTS + """
SELECT reason AS _reject_reason, CAST(count(*) AS BIGINT) AS n_rows FROM judged WHERE reason IS NOT NULL GROUP BY reason""")
def reject_breakdown(spark, sf):
    return breakdown(apply_rules(landed(spark, sf, "products"), domain_rules("products")))


@query(USERS + """
SELECT id, email, c_name AS username, 'secret-' || id AS password, segment AS name_firstname, c_name AS name_lastname,
       CAST(id % 100 AS VARCHAR) AS address_geolocation_lat, '-' || CAST(id % 170 AS VARCHAR) AS address_geolocation_long,
       city AS address_city, 'main street' AS address_street, CAST(id % 90 AS INT) AS address_number,
       '12345' AS address_zipcode, '1-' || lpad(CAST(id AS VARCHAR), 9, '0') AS phone, 0 AS __v
FROM users""")
def flatten_struct(spark, sf):
    return nested.flatten(landed(spark, sf, "users").drop(CORRUPT, "_source_file"))


@query(USERS + f"""
, dated AS (SELECT *, CAST(DATE '{FIRST_DAY}' + CAST(object_no % 7 AS INT) AS DATE) AS day FROM users WHERE email LIKE '%@%')
SELECT sha256(concat_ws('|', 'customer', CAST(id AS VARCHAR), CAST(day AS VARCHAR))) AS customer_sk, id AS customer_id,
       day AS snapshot_date, email, concat(substr(email, 1, 1), '***@', split_part(email, '@', 2)) AS email_masked,
       split_part(email, '@', 2) AS email_domain, lower(c_name) AS username,
       upper(segment[1]) || substr(segment, 2) AS first_name, c_name AS last_name,
       concat(upper(segment[1]), substr(segment, 2), ' ', c_name) AS full_name,
       upper(city[1]) || lower(substr(city, 2)) AS city, 'Main Street' AS street, CAST(id % 90 AS INT) AS street_number,
       '12345' AS zip_code,
       concat_ws(' ', CAST(id % 90 AS VARCHAR), 'Main Street', '12345', upper(city[1]) || lower(substr(city, 2))) AS full_address,
       CASE WHEN id % 100 <= 90 THEN CAST(id % 100 AS DOUBLE) END AS latitude,
       CAST('-' || CAST(id % 170 AS VARCHAR) AS DOUBLE) AS longitude,
       id % 100 <= 90 AS has_valid_geolocation,
       '1' || lpad(CAST(id AS VARCHAR), 9, '0') AS phone_digits, '1-' || lpad(CAST(id AS VARCHAR), 9, '0') AS phone_raw,
       TRUE AS has_valid_phone, TRUE AS has_complete_address
FROM dated""")
def dim_customers(spark, sf):
    return S.dim_customers(bronze_users(spark, sf)).drop(
        "silver_ts", "source_ingest_ts", "source_record_hash"
    )


@query(f"""
WITH parts AS (SELECT p_partkey, p_name, CAST(p_retailprice AS DECIMAL(10,2)) AS price,
                      CAST(DATE '{FIRST_DAY}' + CAST(p_size % 7 AS INT) AS DATE) AS day FROM part)
SELECT p_partkey, p_name, CAST(CASE WHEN day >= DATE '{FIRST_DAY}' + 5 THEN price + 1 ELSE price END AS DECIMAL(10,2)) AS price, day
FROM parts""")
def partition_overwrite(spark, sf):
    """All days are written, then the days from the sixth on are replaced; the others must stay."""
    path = scratch_path(spark, "overwrite")
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), F.col("p_size") % 7)
    rows = table(spark, sf, "part").select(
        "p_partkey", "p_name", F.col("p_retailprice").cast("decimal(10,2)").alias("price"), day.alias("day")
    )
    T.overwrite_partitions(rows, path, ["day"], ["p_partkey"])
    later = rows.where(F.col("day") >= F.date_add(F.lit(FIRST_DAY).cast("date"), 5))
    corrected = later.withColumn("price", (F.col("price") + 1).cast("decimal(10,2)"))
    T.overwrite_partitions(corrected, path, ["day"], ["p_partkey"])
    return spark.read.parquet(path).select("p_partkey", "p_name", "price", "day")


@query("""
SELECT '/event_type=' || event_type AS partition, CAST(6 AS BIGINT) AS n_files, CAST(1 AS BIGINT) AS n_files_after
FROM events GROUP BY event_type""")
def compaction_plan(spark, sf):
    """Events written by six tasks per type leave six small files each."""
    path = scratch_path(spark, "files")
    table(spark, sf, "events").repartition(6, "event_id").write.partitionBy("event_type").parquet(path)
    return T.compaction_plan(spark, path).drop("n_bytes")
