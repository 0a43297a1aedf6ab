"""Row-set comparison of a Spark result with DuckDB on the same tables."""

from __future__ import annotations

import math

import duckdb

from oracle_queries import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{round(value, 5) + 0.0:.5f}"
    return str(value)


def rows_of(columns, rows):
    """Sorted rows as text, columns in the order of their names."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


# Spark type names and the DuckDB types that hold the same values.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def compare(con, sql, frame):
    """Empty text when both agree, else what differs."""
    types = dict(con.execute(f"SELECT column_name, column_type FROM (DESCRIBE {sql})").fetchall())
    columns = list(types)
    expected = rows_of(columns, con.execute(sql).fetchall())
    found_types = dict(frame.dtypes)
    if sorted(columns) != sorted(found_types):
        return f"columns {sorted(found_types)} and not {sorted(columns)}"
    off = {c: (t, types[c]) for c, t in found_types.items() if SAME_TYPE.get(t) != types[c]}
    if off:
        return f"types {off}"
    found = rows_of(frame.columns, frame.collect())
    if len(found) != len(expected):
        return f"{len(found)} rows and not {len(expected)}"
    differing = [(a, b) for a, b in zip(found, expected) if a != b]
    if differing:
        return f"{len(differing)} rows differ, first {differing[0]}"
    return ""
