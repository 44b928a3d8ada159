"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, [type_name(t) for _, t in sorted(df.dtypes)], Counter(
        tuple(_plain(r[n]) for n in names) for r in df.collect()
    )


def type_name(spark_type: str) -> str:
    return {
        "string": "VARCHAR",
        "bigint": "BIGINT",
        "int": "INTEGER",
        "double": "DOUBLE",
        "date": "DATE",
        "boolean": "BOOLEAN",
        "timestamp_ntz": "TIMESTAMP",
    }.get(spark_type, spark_type)


def duck_rows(con, sql):
    rel = con.sql(sql)
    order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    names = [rel.columns[i] for i in order]
    types = [str(rel.types[i]) for i in order]
    return names, types, Counter(tuple(_plain(r[i]) for i in order) for r in rel.fetchall())


def differences(df, con, sql) -> str | None:
    """None when names, types and rows agree, else a short description."""
    s_names, s_types, s_rows = spark_rows(df)
    d_names, d_types, d_rows = duck_rows(con, sql)
    if s_names != d_names:
        return f"columns {s_names} != {d_names}"
    if s_types != d_types:
        return f"types {[(n, a, b) for n, a, b in zip(s_names, s_types, d_types) if a != b]}"
    if s_rows != d_rows:
        extra, lacking = s_rows - d_rows, d_rows - s_rows
        return (
            f"{sum(s_rows.values())} vs {sum(d_rows.values())} rows, only Spark {sum(extra.values())}: "
            f"{list(extra)[:2]}, only SQL {sum(lacking.values())}: {list(lacking)[:2]}"
        )
    return None
