"""Run a registered query in Spark and its SQL in DuckDB and compare every value."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb
import numpy as np
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, (float, np.floating)):
        return "NaN" if math.isnan(v) else float(v)
    if isinstance(v, (pd.Timestamp, datetime.datetime)):
        return v.isoformat()
    if isinstance(v, np.generic):
        return v.item()
    return v


def _sorted(rows) -> list[tuple]:
    return sorted((tuple(_value(v) for v in r) for r in rows), key=lambda r: [str(v) for v in r])


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    return columns, _sorted(df.select(*columns).collect())


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [[r[i] for i in order] for r in result.fetchall()]
    return sorted(names), _sorted(rows)
