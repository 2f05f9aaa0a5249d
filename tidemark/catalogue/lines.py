"""Operators on single order lines: deduplication, keys, hashing, explosion and sampling."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import constants as K
from .. import functions as X
from ..operators import dedup, nested, replicate_and_thin
from ..operators import quality as Q
from ..plans import silver as S
from .catalog import md5_pick, md5_uniform
from .core import query, table
from .fixtures import customers, month, with_fx

LINE_COLUMNS = """l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"""


@query(f"""
SELECT {LINE_COLUMNS} FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
        l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn
    FROM lineitem) WHERE rn = 1""")
def dedup_latest(spark, sf):
    ties = ["l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
            "l_linestatus"]
    return dedup.dedup_latest(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
        [F.col("l_shipdate").desc(), F.col("l_partkey").desc(), *map(F.col, ties)],
    )


@query("""
SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n_rows
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    return Q.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


KEY_SQL = "concat_ws(':', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))"


def _line_key():
    return F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))


def _ship_day():
    return F.to_date("l_shipdate")


@query(f"""
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date,
       CAST({md5_uniform(KEY_SQL, 'CAST(l_shipdate AS DATE)', 'occur')} * 4294967296 AS BIGINT) AS uniform_steps
FROM lineitem""")
def hash_uniform(spark, sf):
    u = X.hash_uniform(_line_key(), _ship_day(), "occur", method="md5")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", _ship_day().alias("ship_date"),
        (u * F.lit(4294967296.0)).cast("bigint").alias("uniform_steps"),
    )


@query(f"""
WITH n AS (SELECT count(*) AS buyers FROM customer)
SELECT l_orderkey, l_linenumber,
       CAST(floor({md5_uniform(KEY_SQL, 'CAST(l_shipdate AS DATE)', 'cust')} * (SELECT buyers FROM n)) + 1 AS BIGINT) AS customer_id
FROM lineitem""")
def hash_bucket(spark, sf):
    buyers = table(spark, sf, "customer").agg(F.count("*").alias("n")).select("n").scalar()
    u = X.hash_uniform(_line_key(), _ship_day(), "cust", method="md5")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", X.hash_bucket(u, buyers).alias("customer_id")
    )


PICK = 1_000_000


@query(f"""
SELECT l_orderkey, l_linenumber, i AS copy,
       {md5_pick("concat_ws(':', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(i AS VARCHAR))", 'CAST(l_shipdate AS DATE)', 'cust', PICK)} AS picked
FROM lineitem, (VALUES (1), (2), (3), (4)) AS copies(i)""")
def hash_pick(spark, sf):
    key = F.concat_ws(":", "l_orderkey", "l_linenumber", "copy")
    copies = F.explode(F.array(*[F.lit(i) for i in range(1, 5)])).alias("copy")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", copies)
    picked = X.hash_pick(key, _ship_day(), "cust", PICK, method="md5")
    return rows.select("l_orderkey", "l_linenumber", "copy", picked.alias("picked"))


@query(f"""
SELECT CAST(count(*) AS BIGINT) AS n_keys, TRUE AS in_range, TRUE AS as_many_as_drawn,
       TRUE AS evenly_spread FROM lineitem, (VALUES (1), (2), (3), (4)) AS copies(i)""")
def hash_pick_shipped(spark, sf):
    """The shipped method has no SQL; what its choices must be like among a million is known:
    almost as many distinct ones as independent draws give, alike in all tenths of the range."""
    key = F.concat_ws(":", "l_orderkey", "l_linenumber", "copy")
    copies = F.explode(F.array(*[F.lit(i) for i in range(1, 5)])).alias("copy")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", copies)
    picked = rows.select(X.hash_pick(key, _ship_day(), "cust", PICK).alias("p"))
    one = picked.groupBy("p").agg(F.count("*").alias("n"))
    tenth = one.groupBy(F.floor((F.col("p") - 1) / (PICK / 10)).alias("t")).agg(
        F.sum("n").alias("n"), F.count("*").alias("distinct"), F.min("p").alias("low"), F.max("p").alias("high"))
    total, distinct = F.sum("n"), F.sum("distinct")
    drawn = PICK * (1 - F.exp(-total / PICK))
    spread = F.max("off")
    off = tenth.withColumn("off", F.abs(F.col("n") * 10 / F.sum("n").over(Window.partitionBy()) - 1))
    return off.agg(
        total.cast("bigint").alias("n_keys"), ((F.min("low") >= 1) & (F.max("high") <= PICK)).alias("in_range"),
        (F.abs(distinct / drawn - 1) < 0.01).alias("as_many_as_drawn"), (spread < 0.1).alias("evenly_spread"))


@query("""
SELECT o_orderkey,
       concat_ws('-', 'ORD', strftime(o_orderdate, '%Y%m%d'),
                 CASE WHEN length(CAST(o_custkey AS VARCHAR)) > 3 THEN CAST(o_custkey AS VARCHAR)
                      ELSE lpad(CAST(o_custkey AS VARCHAR), 3, '0') END,
                 CAST(o_orderkey AS VARCHAR)) AS order_id
FROM orders""")
def order_key_format(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        X.business_key(
            "ORD", F.to_date("o_orderdate"), (F.col("o_custkey"), 3), F.col("o_orderkey")
        ).alias("order_id"),
    )


def nested_lines(spark, sf):
    """Each line with an array of as many items as its line number."""
    numbers = F.sequence(F.lit(1).cast("bigint"), F.col("l_linenumber").cast("bigint"))
    items = F.transform(numbers, lambda i: F.struct(
        (F.col("l_partkey") + i - 1).alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
    ))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", items.alias("items"))


@query("""
SELECT l_orderkey, l_suppkey, CAST(l_partkey + i - 1 AS BIGINT) AS product_id, CAST(l_quantity AS INT) AS quantity
FROM (SELECT *, unnest(generate_series(1, l_linenumber)) AS i FROM lineitem)""")
def explode_lines(spark, sf):
    return nested.explode_lines(nested_lines(spark, sf), "items")


RATE_SQL = "CASE dayofweek({day}) " + " ".join(
    f"WHEN {n - 1} THEN CAST({rate} AS DOUBLE)" for n, rate in K.WEEKDAY_KEEP_RATE.items()
) + " END"


@query(f"""
WITH copies AS (
    SELECT *, unnest(generate_series(0, {K.ORDER_REPLICAS - 1})) AS replica FROM lineitem)
, drawn AS (
    SELECT *, {md5_uniform("concat_ws(':', CAST(l_orderkey AS VARCHAR), CAST(replica AS VARCHAR))",
                           'CAST(l_shipdate AS DATE)', 'occur')} AS u FROM copies)
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS ship_date, CAST(replica AS INT) AS replica
FROM drawn WHERE u < {RATE_SQL.format(day='l_shipdate')}""")
def stratified_hash_sample(spark, sf):
    key = F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("replica").cast("string"))
    kept = replicate_and_thin(
        table(spark, sf, "lineitem"), K.ORDER_REPLICAS,
        X.hash_uniform(key, _ship_day(), "occur", method="md5"), X.weekday_rate(_ship_day()),
    )
    return kept.select(
        "l_orderkey", "l_linenumber", "l_partkey", _ship_day().alias("ship_date"), "replica"
    )


def landed_carts(spark, sf):
    """Each line as a landed cart of the order, its items being consecutive parts."""
    numbers = F.sequence(F.lit(1).cast("bigint"), F.col("l_linenumber").cast("bigint"))
    items = F.transform(numbers, lambda i: F.struct(
        (F.col("l_partkey") + i - 1).alias("productId"),
        (F.col("l_quantity").cast("int") + i.cast("int")).alias("quantity"),
    ))
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("userId"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
        items.alias("products"),
        month("l_shipdate").alias("_ingest_date"),
        F.col("l_shipdate").alias("_ingest_ts"),
        F.concat_ws("/", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int"))
        .alias("_source_file"),
        F.concat_ws("/", "l_returnflag", "l_linestatus").alias("_record_hash"),
        (F.col("l_returnflag") != "R").alias("_is_valid"),
    )


def _u(key: str, salt: str) -> str:
    return md5_uniform(key, "order_date", salt)


ORDER = "concat_ws(':', CAST(cart AS VARCHAR), CAST(replica AS VARCHAR))"
LINE = "concat_ws(':', CAST(cart AS VARCHAR), CAST(replica AS VARCHAR), CAST(product_id AS VARCHAR))"
PAD = "CASE WHEN length(CAST({c} AS VARCHAR)) > 3 THEN CAST({c} AS VARCHAR) ELSE lpad(CAST({c} AS VARCHAR), 3, '0') END"


@query(f"""
WITH carts AS (
    SELECT *, CAST(date_trunc('month', l_shipdate) AS DATE) AS order_date,
           concat_ws('/', l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT)) AS src,
           concat_ws('/', l_returnflag, l_linestatus) AS hash FROM lineitem WHERE l_returnflag <> 'R')
, newest AS (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, order_date
                                 ORDER BY l_shipdate DESC, src DESC, hash) AS rn FROM carts)
, copies AS (
    SELECT l_orderkey AS cart, *, unnest(generate_series(0, {K.ORDER_REPLICAS - 1})) AS replica
    FROM newest WHERE rn = 1)
, kept AS (SELECT * FROM copies WHERE {_u(ORDER, 'occur')} < {RATE_SQL.format(day='order_date')})
, opened AS (SELECT *, unnest(generate_series(1, l_linenumber)) AS i FROM kept)
, lines AS (SELECT *, l_partkey + i - 1 AS product_id, CAST(l_quantity AS INT) + i AS quantity_source FROM opened)
SELECT concat_ws('-', 'ORD', strftime(order_date, '%Y%m%d'), {PAD.format(c='cart')}, CAST(replica AS VARCHAR)) AS order_id,
       concat_ws('-', 'ORD', strftime(order_date, '%Y%m%d'), {PAD.format(c='cart')}, CAST(replica AS VARCHAR),
                 {PAD.format(c='product_id')}) AS order_line_id,
       order_date AS snapshot_date, order_date,
       CAST(order_date AS TIMESTAMP) + to_hours(CAST({K.ORDER_FIRST_HOUR} + floor({_u(ORDER, 'hour')} * {K.ORDER_HOURS}) AS INT))
         + to_minutes(CAST(floor({_u(ORDER, 'minute')} * 60) AS INT)) AS order_ts,
       CASE WHEN replica = 0 THEN l_suppkey
            ELSE {md5_pick(ORDER, 'order_date', 'cust', '(SELECT count(*) FROM customer)')} END AS customer_id,
       CAST(product_id AS BIGINT) AS product_id,
       greatest(1, CAST(round(quantity_source * (CAST(0.7 AS DOUBLE) + CAST(0.6 AS DOUBLE) * {_u(LINE, 'qty')})) AS INT)) AS quantity,
       CAST(quantity_source AS INT) AS quantity_source, cart AS template_cart_id,
       CAST(replica AS INT) AS template_replica, l_suppkey AS source_customer_id,
       l_shipdate AS source_cart_ts, hash AS source_record_hash, TRUE AS is_reconstructed
FROM lines""")
def fct_order_items(spark, sf):
    buyers = table(spark, sf, "customer").agg(F.count("*").alias("n")).select("n").scalar()
    facts = S.fct_order_items(landed_carts(spark, sf), buyers, method="md5")
    return facts.withColumn("source_cart_ts", F.col("source_cart_ts").cast("timestamp_ntz")).drop(
        "silver_ts"
    )


@query(with_fx("fx_customers", """
SELECT customer_id, sha256(concat_ws('|', 'customer', CAST(customer_id AS VARCHAR), city)) AS customer_sk
FROM fx_customers"""))
def surrogate_key(spark, sf):
    return customers(spark, sf).select(
        "customer_id",
        X.surrogate_key("customer", F.col("customer_id"), F.col("city")).alias("customer_sk"),
    )


@query(with_fx("fx_customers", """
SELECT customer_id, sha256(concat('{"customer_id":', CAST(customer_id AS VARCHAR), ',"full_name":"', full_name,
       '","city":"', city, '","email_domain":"', email_domain, '"}')) AS record_hash
FROM fx_customers"""))
def record_hash(spark, sf):
    df = customers(spark, sf)
    return df.select("customer_id", X.record_hash(df, exclude=("email", "acctbal")).alias("record_hash"))


@query(with_fx("fx_customers", """
SELECT customer_id, concat(substr(email, 1, 1), '***@', split_part(email, '@', 2)) AS email_masked,
       split_part(email, '@', 2) AS email_domain, sha256(full_name) AS full_name_sha256
FROM fx_customers"""))
def pii_minimise(spark, sf):
    email = F.col("email")
    return customers(spark, sf).select(
        "customer_id", X.mask_email(email).alias("email_masked"),
        X.email_domain(email).alias("email_domain"),
        F.sha2(F.coalesce("full_name", F.lit("")), 256).alias("full_name_sha256"),
    )


@query(with_fx("fx_customers", """
SELECT customer_id, lower(trim('  ' || full_name || ' ')) AS slug,
       upper(substr(replace(trim(full_name), '#', ''''), 1, 1)) || lower(replace(substr(trim(full_name), 2), '#', ' ')) AS label,
       regexp_replace(full_name, '[^0-9]', '', 'g') AS phone_digits,
       length(regexp_replace(full_name, '[^0-9]', '', 'g')) >= 9 AS has_valid_phone,
       concat_ws(' ', full_name, city, email_domain) AS full_address
FROM fx_customers"""))
def text_normalise(spark, sf):
    name = F.col("full_name")
    phone = X.digits(name)
    return customers(spark, sf).select(
        "customer_id", X.slug(F.concat(F.lit("  "), name, F.lit(" "))).alias("slug"),
        X.title_label(F.replace(name, F.lit("#"), F.lit("'"))).alias("label"),
        phone.alias("phone_digits"), (F.length(phone) >= 9).alias("has_valid_phone"),
        X.join_words(name, F.col("city"), F.col("email_domain")).alias("full_address"),
    )
