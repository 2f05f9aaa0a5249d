"""Coverage of the scalar functions, one query per family."""

from __future__ import annotations

from pyspark.sql import functions as F

from .core import query, table


@query("""
SELECT c_custkey, trim('  ' || c_name) AS trimmed, lower(c_mktsegment) AS lowered,
       upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS initcapped,
       regexp_replace(c_name, '[^0-9]', '', 'g') AS digits, regexp_extract(c_name, '([A-Za-z]+)', 1) AS letters,
       split_part(c_name, '#', 2) AS part, c_name || '-' || c_mktsegment AS joined,
       concat_ws('|', c_name, c_mktsegment) AS ws, substr(c_name, 1, 4) AS head, CAST(length(c_name) AS INT) AS size,
       lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS padded, c_name LIKE '%7%' AS has_seven,
       contains(c_mktsegment, 'HOUSE') AS is_house, sha256(c_name) AS hashed
FROM customer""")
def fn_string(spark, sf):
    name, seg = F.col("c_name"), F.col("c_mktsegment")
    return table(spark, sf, "customer").select(
        "c_custkey", F.trim(F.concat(F.lit("  "), name)).alias("trimmed"), F.lower(seg).alias("lowered"),
        F.initcap(seg).alias("initcapped"), F.regexp_replace(name, "[^0-9]", "").alias("digits"),
        F.regexp_extract(name, "([A-Za-z]+)", 1).alias("letters"),
        F.get(F.split(name, "#"), F.lit(1)).alias("part"), F.concat(name, F.lit("-"), seg).alias("joined"),
        F.concat_ws("|", name, seg).alias("ws"), F.substring(name, 1, 4).alias("head"),
        F.length(name).alias("size"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("padded"),
        name.like("%7%").alias("has_seven"), seg.contains("HOUSE").alias("is_house"),
        F.sha2(name, 256).alias("hashed"),
    )


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m,
       CAST(day(o_orderdate) AS INT) AS d, CAST(weekofyear(o_orderdate) AS INT) AS w, CAST(dayofweek(o_orderdate) + 1 AS INT) AS dow,
       dayname(o_orderdate) AS name, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
       CAST(CAST(o_orderdate AS DATE) - 7 AS DATE) AS week_before,
       CAST(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INT) AS age,
       strftime(o_orderdate, '%Y%m%d') AS compact, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 90 MINUTE AS later,
       TRY_CAST('not a date' AS DATE) AS unreadable
FROM orders""")
def fn_date(spark, sf):
    ts, day = F.col("o_orderdate"), F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", day.alias("day"), F.year(ts).alias("y"), F.month(ts).alias("m"),
        F.dayofmonth(ts).alias("d"), F.weekofyear(ts).alias("w"), F.dayofweek(ts).alias("dow"),
        F.date_format(ts, "EEEE").alias("name"), F.trunc(ts, "month").alias("month_start"),
        F.date_sub(day, 7).alias("week_before"),
        F.datediff(day, F.lit("1995-01-01").cast("date")).alias("age"),
        F.date_format(ts, "yyyyMMdd").alias("compact"),
        (ts + F.make_interval(hours=F.lit(1), mins=F.lit(30))).alias("later"),
        F.lit("not a date").try_cast("date").alias("unreadable"),
    )


@query("""
SELECT event_id, i AS element, CAST(json_extract_string(props, '$.k') AS INT) AS k, CAST(3 AS INT) AS size,
       concat('{"user_id":', user_id, ',"event_type":"', event_type, '"}') AS as_json, event_type AS mapped
FROM (SELECT *, CAST(unnest([1, 2, 3]) AS INT) AS i FROM events)""")
def fn_array_json(spark, sf):
    numbers = F.sequence(F.lit(1), F.lit(3))
    return table(spark, sf, "events").select(
        "event_id", F.explode(numbers).alias("element"),
        F.get_json_object("props", "$.k").cast("int").alias("k"), F.size(numbers).alias("size"),
        F.to_json(F.struct("user_id", "event_type")).alias("as_json"),
        F.create_map(F.lit("type"), F.col("event_type"))["type"].alias("mapped"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)), 1) AS DECIMAL(12,1)) AS rounded,
       CAST(floor(l_extendedprice) AS BIGINT) AS floored, CAST(round(sin(l_quantity) * 1000000) AS BIGINT) AS sine,
       CAST(pow(l_quantity, 2) AS BIGINT) AS squared, CAST(((l_partkey - 500) % 7 + 7) % 7 AS BIGINT) AS modulo,
       greatest(l_linenumber, 3) AS at_least, least(l_linenumber, 3) AS at_most,
       coalesce(nullif(l_linenumber, 3), 0) AS without_three,
       CASE WHEN l_quantity < 10 THEN 'few' ELSE 'many' END AS amount, CAST(l_quantity AS INT) AS quantity,
       TRY_CAST(l_returnflag AS INT) AS not_a_number
FROM lineitem""")
def fn_math_cond(spark, sf):
    line = F.col("l_linenumber")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(F.col("l_extendedprice").cast("decimal(12,2)"), 1).cast("decimal(12,1)").alias("rounded"),
        F.floor("l_extendedprice").cast("bigint").alias("floored"),
        F.round(F.sin("l_quantity") * 1000000).cast("bigint").alias("sine"),
        F.pow(F.col("l_quantity"), F.lit(2)).cast("bigint").alias("squared"),
        F.pmod(F.col("l_partkey") - 500, F.lit(7)).cast("bigint").alias("modulo"),
        F.greatest(line, F.lit(3)).alias("at_least"), F.least(line, F.lit(3)).alias("at_most"),
        F.coalesce(F.nullif(line, F.lit(3)), F.lit(0)).alias("without_three"),
        F.when(F.col("l_quantity") < 10, "few").otherwise("many").alias("amount"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_returnflag").try_cast("int").alias("not_a_number"),
    )
