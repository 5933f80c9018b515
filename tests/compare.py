"""Row-for-row comparison of a Spark result with DuckDB."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duckdb_views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float, Decimal)):
        return float(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in data)


def family(name: str) -> str:
    """Coarse type names, the same for both engines."""
    name = name.upper()
    for prefix, kind in (
        ("BIGINT", "BIGINT"),
        ("INT", "INT"),
        ("DOUBLE", "DOUBLE"),
        ("STRING", "STRING"),
        ("VARCHAR", "STRING"),
        ("BOOL", "BOOL"),
    ):
        if name.startswith(prefix):
            return kind
    return name


def differences(spark_df, con, sql: str) -> list[str]:
    relation = con.sql(sql)
    expected_types = {c: family(str(t)) for c, t in zip(relation.columns, relation.types)}
    actual_types = {f.name: family(f.dataType.simpleString()) for f in spark_df.schema.fields}
    found = []
    if expected_types != actual_types:
        found.append(f"schema: spark {actual_types} duckdb {expected_types}")
    expected = rows(relation.columns, relation.fetchall())
    actual = rows(spark_df.columns, spark_df.collect())
    if expected != actual:
        only_spark = list((actual - expected).items())[:5]
        only_duck = list((expected - actual).items())[:5]
        found.append(
            f"rows: {actual.total()} vs {expected.total()}; only spark {only_spark}; "
            f"only duckdb {only_duck}"
        )
    return found
