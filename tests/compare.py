"""Order-insensitive comparison of a Spark result with the DuckDB result of the same question."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, Decimal):
        return str(v.normalize())
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def difference(frame, con, sql: str) -> str | None:
    """None when both give the same columns, types and rows, otherwise what differs first."""
    found = con.execute(sql)
    have_types = {c: TYPES.get(t, t.upper()) for c, t in frame.dtypes}
    want_types = {d[0]: str(d[1]).replace(" ", "") for d in found.description}
    if have_types != want_types:
        return f"types {sorted(set(have_types.items()) ^ set(want_types.items()))}"
    want_cols, want = _rows([d[0] for d in found.description], found.fetchall())
    have_cols, have = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    if want_cols != have_cols:
        return f"columns {have_cols} != {want_cols}"
    if len(want) != len(have):
        return f"{len(have)} rows != {len(want)}"
    for a, b in zip(have, want):
        if a != b:
            return f"{a} != {b}"
    return None
