"""Run a registered query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return _ordered(columns, result.fetchall())


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return _ordered(df.columns, [tuple(r) for r in df.collect()])


def _ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: [(v is None, str(v)) for v in r])


def _plain(value):
    if isinstance(value, Decimal):
        raise TypeError("decimals must be cast to double before they are compared")
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value
