"""Compare query results with the SQL run by DuckDB on the same files."""

from __future__ import annotations

import collections
import os

import duckdb
from pyspark.sql import DataFrame

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if names, types and the multiset of rows agree; otherwise what differs."""
    want = con.sql(sql).to_arrow_table()
    got = df.toArrow()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {got.column_names} != {want.column_names}"
    names = sorted(got.column_names)
    kinds = {n: (str(got.schema.field(n).type), str(want.schema.field(n).type)) for n in names}
    odd = {n: k for n, k in kinds.items() if k[0] != k[1]}
    if odd:
        return f"types {odd}"
    left = collections.Counter(zip(*[got.column(n).to_pylist() for n in names], strict=True))
    right = collections.Counter(zip(*[want.column(n).to_pylist() for n in names], strict=True))
    if left != right:
        return (
            f"rows {got.num_rows} vs {want.num_rows}; only here {list((left - right).items())[:3]}; "
            f"only there {list((right - left).items())[:3]}"
        )
    return None
