"""Compare a Spark result with a DuckDB result: columns, row count, values."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        raise AssertionError("decimal in a query result; cast it")
    if isinstance(value, float):
        return None if math.isnan(value) else float(repr(value))
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def _kind(name: str) -> str:
    name = name.lower()
    if name in ("bigint", "integer", "int", "smallint", "hugeint", "long"):
        return "int"
    return {"varchar": "string", "decimal(2,1)": "double"}.get(name, name)


def compare(spark_df, con, sql) -> str | None:
    """None when equal, else what differs."""
    result = con.execute(sql)
    duck_columns = [d[0] for d in result.description]
    duck_types = {d[0]: _kind(str(d[1])) for d in result.description}
    duck = result.fetchall()
    if sorted(spark_df.columns) != sorted(duck_columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(duck_columns)}"
    types = {c: _kind(t) for c, t in spark_df.dtypes}
    if types != duck_types:
        return f"types {[(c, types[c], duck_types[c]) for c in types if types[c] != duck_types[c]]}"
    left, right = _rows(spark_df.columns, spark_df.collect()), _rows(duck_columns, duck)
    if left == right:
        return None
    only_left, only_right = list((left - right).items())[:3], list((right - left).items())[:3]
    return f"rows {sum(left.values())} vs {sum(right.values())}: spark only {only_left}, duckdb only {only_right}"
