"""Side-by-side comparison of a registered query with its SQL."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return None if value is None else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    # nulls sort like empty texts
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=lambda r: tuple(c or "" for c in r))


def compare(df, con, sql):
    """None when both sides agree, else a short description of the first difference."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected_types = {d[0]: str(d[1]) for d in result.description}
    expected = _rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} <> {sorted(names)}"
    kinds = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
        "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
    }
    for name, kind in df.dtypes:
        if kinds.get(kind) != expected_types[name]:
            return f"type of {name}: {kind} <> {expected_types[name]}"
    actual = _rows(df.columns, df.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows <> {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        return f"{len(wrong)} of {len(actual)} rows differ, first {wrong[0]}"[:1500]
    return None if actual else "no rows"
