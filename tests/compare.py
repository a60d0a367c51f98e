"""Spark results against the oracle statements, as sorted rows."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in NAMES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v) if not isinstance(v, datetime.date) else v.isoformat()


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    rows = df.select(*names).collect()
    return names, sorted(tuple(_cell(v) for v in r) for r in rows)


def oracle_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    rel = con.sql(sql)
    names = sorted(rel.columns)
    rows = rel.project(", ".join(f'"{n}"' for n in names)).fetchall()
    return names, sorted(tuple(_cell(v) for v in r) for r in rows)
