"""The raw zone: JSON objects below `<root>/<domain>/ingest_date=<day>/`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import OBJECT_NAME_PATTERN
from ..operators.rules import CORRUPT

# Fields of each domain. Identifiers are wide enough for very large tables.
DOMAIN_FIELDS = {
    "products": """id BIGINT, title STRING, price DOUBLE, description STRING, category STRING,
        image STRING, rating STRUCT<rate: DOUBLE, count: INT>""",
    "users": """id BIGINT, email STRING, username STRING, password STRING,
        name STRUCT<firstname: STRING, lastname: STRING>,
        address STRUCT<geolocation: STRUCT<lat: STRING, long: STRING>, city: STRING,
                       street: STRING, number: INT, zipcode: STRING>,
        phone STRING, __v INT""",
    "carts": """id BIGINT, userId BIGINT, date STRING,
        products ARRAY<STRUCT<productId: BIGINT, quantity: INT>>, __v INT""",
}
# What the landing flow writes for each object, below <raw>/landed/domain=<domain>/.
LANDED_FIELDS = "object_key STRING, body STRING"
#: Tasks of a listing.
LISTING_TASKS = 64
SECRETS = {"users": ("password",)}


def domain_schema(domain: str) -> T.StructType:
    """Business fields of a domain, without the corrupt-record column."""
    return T.StructType.fromDDL(DOMAIN_FIELDS[domain])


def input_paths(root: str, domain: str, dates: Sequence[str]) -> list[str]:
    """Folders of the wanted days: nothing else is listed."""
    return [f"{root}/{domain}/ingest_date={d}" for d in dates]


def landed_root(root: str, domain: str) -> str:
    """Where the landing flow puts a domain's objects."""
    return f"{root}/landed/domain={domain}"


def read_raw(
    spark: SparkSession, paths: str | Sequence[str], domain: str, per_element: bool = True
) -> DataFrame:
    """Permissive scan with a fixed schema; unreadable input lands in `_corrupt_record`.

    Each object is one JSON array. `per_element` rejects only the array elements that do not fit
    the schema; otherwise one bad element marks every row of its file, and as Spark then skips
    fields a query does not use, only fields in use are checked. The object's path comes along
    as `_source_file`.
    """
    schema = domain_schema(domain)
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    if not per_element:
        rows = (
            spark.read.schema(with_corrupt).option("multiLine", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).json(paths)
        )
        return rows.select("*", F.col("_metadata.file_path").alias("_source_file"))
    objects = spark.read.text(paths, wholetext=True, recursiveFileLookup=True).select(
        F.col("value").alias("_object"), F.col("_metadata.file_path").alias("_source_file")
    )
    return _elements(objects, with_corrupt)


def read_landed(spark: SparkSession, paths: str | Sequence[str], domain: str) -> DataFrame:
    """Objects as the landing flow writes them, many to a file: each line has an object's key and body."""
    schema = domain_schema(domain)
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    objects = spark.read.schema(LANDED_FIELDS).json(paths).select(
        F.col("body").alias("_object"), F.col("object_key").alias("_source_file")
    )
    return _elements(objects, with_corrupt)


def _elements(objects: DataFrame, with_corrupt: T.StructType) -> DataFrame:
    """One row per array element; those that do not fit the schema are kept as corrupt."""
    # An object that is no array is kept as its only element.
    listed = F.coalesce(F.from_json("_object", "array<string>"), F.array("_object"))
    elements = objects.select("_source_file", F.explode(listed).alias("_element"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = elements.select(
        "_source_file", F.from_json("_element", with_corrupt, options).alias("_row")
    )
    return parsed.select("_row.*", "_source_file")


def provenance(df: DataFrame, path: Column | None = None) -> DataFrame:
    """Logical day and real call instant, to the millisecond, from the object name."""
    source = F.col("_source_file") if path is None else path
    day = F.nullif(F.regexp_extract(source, OBJECT_NAME_PATTERN, 2), F.lit(""))
    millis = F.nullif(F.regexp_extract(source, OBJECT_NAME_PATTERN, 3), F.lit(""))
    return df.withColumn("_ingest_date", day.try_cast("date")).withColumn(
        "_ingest_ts", F.timestamp_millis(millis.try_cast("bigint"))
    )


def objects(spark: SparkSession, root: str | Sequence[str], tasks: int = LISTING_TASKS) -> DataFrame:
    """One row per file of a tree, or of several, with its size and partition values; no content is read.

    Spark cuts a file scan by bytes, which a listing does not read: a bounded number of tasks
    takes all cuts.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", "length", "modificationTime").coalesce(tasks)


def misnamed(df: DataFrame, path: str = "path") -> DataFrame:
    """Traced objects whose name has no day, or another one than their folder."""
    folder = F.regexp_extract(path, r"/ingest_date=([^/]+)/", 1).try_cast("date")
    return df.where(~F.coalesce(F.col("_ingest_date") == folder, F.lit(False)))


def present(spark: SparkSession, root: str) -> bool:
    """Whether a folder exists, in any file system Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def raw_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Objects and bytes per (domain, day); those outside a day folder count under a NULL day."""
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/") + "/"
    below = F.substring(F.col("path"), F.locate(base, F.col("path")) + len(base), F.length("path"))
    found = objects(spark, root).select(
        "length",
        F.nullif(F.regexp_extract(below, r"^([^/]+)/", 1), F.lit("")).alias("domain"),
        F.regexp_extract("path", r"/ingest_date=([^/]+)/", 1).try_cast("date").alias("ingest_date"),
    )
    return found.groupBy("domain", "ingest_date").agg(
        F.count("*").alias("n_objects"), F.sum("length").alias("n_bytes")
    )


def inventory_span(inventory: DataFrame) -> DataFrame:
    """Landed days of each domain: how many, first and last."""
    return inventory.groupBy("domain").agg(
        F.count_distinct("ingest_date").alias("n_days"),
        F.min("ingest_date").alias("first_day"),
        F.max("ingest_date").alias("last_day"),
    )
