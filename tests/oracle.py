"""Compare a Spark result with the SQL result of DuckDB, order-insensitive and exact."""

from __future__ import annotations

import math
from datetime import date, datetime
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted((tuple(_plain(v) for v in row) for row in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def both(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list, list, list[str], list[str]]:
    """(Spark rows, SQL rows, Spark columns, SQL columns), columns sorted by name."""
    columns = sorted(df.columns)
    spark_rows = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    sql_rows = [tuple(row[i] for i in order) for row in result.fetchall()]
    return _sorted(spark_rows), _sorted(sql_rows), columns, [names[i] for i in order]
