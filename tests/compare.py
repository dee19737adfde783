"""Run a query on Spark and its SQL on DuckDB over the same tables, and compare rows, order aside."""

from __future__ import annotations

import glob
import math
import os
from datetime import date, datetime
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(row[i]) for i in order) for row in rows),
        key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r),
    )


def compare(spark, con, name, query, sql, sf_dir):
    """None when equal, else a description of the difference."""
    df = query(spark, sf_dir)
    ours = normal(df.columns, df.collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = normal(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"{name}: columns {sorted(df.columns)} vs {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"{name}: {len(ours)} rows vs {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{name}: first difference in {sorted(columns)}\n  spark  {a}\n  duckdb {b}"
    return None
