"""Compare a registered query with its SQL: same columns, same rows, whatever the order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return repr(value + 0.0) if isinstance(value, float) else repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs, empty when the results agree to the last bit."""
    theirs = con.execute(sql)
    their_columns = [d[0] for d in theirs.description]
    their_rows = _rows(their_columns, theirs.fetchall())
    our_rows = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    found = []
    if sorted(spark_df.columns) != sorted(their_columns):
        found.append(f"columns {sorted(spark_df.columns)} against {sorted(their_columns)}")
    if len(our_rows) != len(their_rows):
        found.append(f"{len(our_rows)} rows against {len(their_rows)}")
    unequal = [(a, b) for a, b in zip(our_rows, their_rows) if a != b]
    if unequal:
        found.append(f"{len(unequal)} rows differ, first {unequal[0]}")
    return found
