"""Registration of queries and small helpers for their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its own name, optionally with its SQL."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


# The columns of the given tables. A stated schema spares a footer scan per read.
TABLE_FIELDS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": """c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,
        c_mktsegment STRING""",
    "part": """p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,
        p_retailprice DOUBLE""",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
        l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
        value DOUBLE, props STRING""",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_FIELDS[name]).parquet(f"{sf}/{name}.parquet")


# The SQL engine divides decimals as doubles. Quotients are therefore rounded half-up in whole
# numbers, which is exact and matches decimal arithmetic.

def half_up(num: str, den: str) -> str:
    """num/den rounded to a whole number, halves away from zero; NULL for a zero denominator."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    size = f"((2*abs({n})+abs({d}))//(2*NULLIF(abs({d}),0)))"
    return f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -{size} ELSE {size} END)"


def scaled(whole: str, precision: int, scale: int) -> str:
    """A whole number of 10**-scale units as DECIMAL(precision, scale)."""
    unit = f"CAST(0.{'0' * (scale - 1)}1 AS DECIMAL({scale + 1},{scale}))"
    return f"TRY_CAST(CAST({whole} AS DECIMAL(28,0)) * {unit} AS DECIMAL({precision},{scale}))"


def quotient(num: str, den: str, precision: int, scale: int) -> str:
    """num/den of whole numbers, rounded half-up to `scale` digits."""
    return scaled(half_up(f"({num})*{10 ** scale}", den), precision, scale)


def cents(value: str) -> str:
    return f"CAST(({value})*100 AS HUGEINT)"
