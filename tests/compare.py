"""Order-insensitive comparison of a Spark result with DuckDB's."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def _value(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, float):
        return f"{value:.6g}"
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return str(value)


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def spark_rows(df: DataFrame) -> Counter:
    return rows_of(df.columns, (tuple(r) for r in df.collect()))


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    con.execute(sql)
    names = [d[0] for d in con.description]
    return names, rows_of(names, con.fetchall())
