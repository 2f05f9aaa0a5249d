"""Strict comparison of a Spark result with its SQL counterpart: names, types, values, counts."""

from __future__ import annotations

import glob
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path) or glob.glob(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    return (value is not None, type(value).__name__, str(value))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql, limit=3):
    """Empty when equal, else a short description."""
    arrow_spark = spark_df.toArrow()
    arrow_sql = con.sql(sql).to_arrow_table()
    a, b = set(arrow_spark.column_names), set(arrow_sql.column_names)
    if a != b:
        return f"columns only in Spark {sorted(a - b)}, only in SQL {sorted(b - a)}"
    problems = []
    for name in sorted(a):
        left, right = arrow_spark.schema.field(name).type, arrow_sql.schema.field(name).type
        if str(left).replace("large_", "") != str(right).replace("large_", ""):
            problems.append(f"type of {name}: {left} / {right}")
    names = sorted(a)
    left = rows_of(names, zip(*[arrow_spark[n].to_pylist() for n in names]))
    right = rows_of(names, zip(*[arrow_sql[n].to_pylist() for n in names]))
    if len(left) != len(right):
        problems.append(f"rows {len(left)} / {len(right)}")
    if left != right:
        from collections import Counter
        ca, cb = Counter(left), Counter(right)
        only_a, only_b = sorted((ca - cb).elements()), sorted((cb - ca).elements())
        problems.append(f"{names}\n  only Spark ({len(only_a)}): " + "\n    ".join(
            str([c[2] for c in r]) for r in only_a[:limit]))
        problems.append(f"  only SQL ({len(only_b)}): " + "\n    ".join(
            str([c[2] for c in r]) for r in only_b[:limit]))
    return "\n".join(problems)


def rows(df, *order):
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))
