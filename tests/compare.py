"""Strict comparison of a query with its SQL: names, types and values, in any row order."""

from __future__ import annotations

import os

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    return sorted(zip(*[table.column(n).to_pylist() for n in names]) if names else [], key=repr)


def type_of(dtype: pa.DataType) -> str:
    if pa.types.is_decimal(dtype):
        return f"decimal({dtype.precision},{dtype.scale})"
    if pa.types.is_timestamp(dtype):
        return "timestamp"
    return str(dtype).replace("large_", "")


def difference(spark_frame, con, sql: str) -> str | None:
    """What differs, or None."""
    ours, theirs = spark_frame.toArrow(), con.sql(sql).to_arrow_table()
    have, want = ({f.name: type_of(f.type) for f in t.schema} for t in (ours, theirs))
    if have != want:
        return f"schema: {sorted(set(have.items()) ^ set(want.items()))}"
    a, b = rows_of(ours), rows_of(theirs)
    if len(a) != len(b):
        return f"{len(a)} rows instead of {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}"
    return None
