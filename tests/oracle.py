"""Comparison of a Spark result with its SQL twin in DuckDB, cell by cell and regardless of row order."""

from __future__ import annotations

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return con


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    ordered = [tuple(row[i] for i in order) for row in rows]
    return sorted(ordered, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0, repr(v)) for v in row))


def spark_rows(df):
    return sorted(df.columns), _sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def duckdb_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), _sorted_rows(columns, cursor.fetchall())


def difference(df, con, sql) -> str | None:
    """What differs first, or None."""
    got_columns, got = spark_rows(df)
    want_columns, want = duckdb_rows(con, sql)
    if got_columns != want_columns:
        return f"columns {got_columns} instead of {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    for a, b in zip(got, want):
        if repr(a) != repr(b):
            return f"row {a} instead of {b}"
    return None
