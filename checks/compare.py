"""Value-by-value comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

from collections import Counter

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame

VIEWS = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for view in VIEWS:
        con.execute(f"create view {view} as select * from read_parquet('{sf_dir}/{view}.parquet')")
    return con


def _plain(kind: pa.DataType) -> str:
    """Type name without what the two engines spell differently."""
    if pa.types.is_large_string(kind) or pa.types.is_string(kind):
        return "string"
    if pa.types.is_timestamp(kind):
        return "timestamp"
    return str(kind)


def _rows(table: pa.Table) -> Counter:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return Counter(zip(*columns, strict=True)) if columns else Counter()


def difference(spark_result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both have the same columns, types and rows; otherwise what differs."""
    ours = spark_result.toArrow()
    theirs = con.sql(sql).to_arrow_table()
    our_types = {f.name: _plain(f.type) for f in ours.schema}
    their_types = {f.name: _plain(f.type) for f in theirs.schema}
    if our_types != their_types:
        both = our_types.items() ^ their_types.items()
        return f"columns or types differ: {sorted(both)}"
    mine, other = _rows(ours), _rows(theirs)
    if mine != other:
        return (
            f"{ours.num_rows} rows against {theirs.num_rows};"
            f" only in Spark {list((mine - other).items())[:3]};"
            f" only in DuckDB {list((other - mine).items())[:3]}"
        )
    return None
