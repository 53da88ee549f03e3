"""Runs a query on Spark and its SQL on DuckDB and compares the two as bags of rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def duck_tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}") + 0.0
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def bag(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql) -> str | None:
    """None when equal, else what differs."""
    cursor = con.execute(sql)
    names, expected = bag([c[0] for c in cursor.description], cursor.fetchall())
    columns, actual = bag(df.columns, [tuple(r) for r in df.collect()])
    if columns != names:
        return f"columns {columns} but expected {names}"
    if actual != expected:
        extra, missing = list((actual - expected).items()), list((expected - actual).items())
        return (
            f"{actual.total()} rows, expected {expected.total()};"
            f" extra {len(extra)}: {extra[:3]} missing {len(missing)}: {missing[:3]}"
        )
    return None
