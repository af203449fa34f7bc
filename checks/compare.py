"""Run queries and their SQL side by side."""

from __future__ import annotations

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _sorted_rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    rows = zip(*[table.column(name).to_pylist() for name in names])
    return sorted(rows, key=repr)


def differences(spark_result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both give the same bag of rows, else what differs first."""
    ours = spark_result.toArrow()
    theirs = connection.sql(sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(ours.column_names)} and {sorted(theirs.column_names)}"
    for name in ours.column_names:
        types = ours.schema.field(name).type, theirs.schema.field(name).type
        if types[0] != types[1] and not all(pa.types.is_string(t) for t in types):
            return f"{name}: {types[0]} and {types[1]}"
    if ours.num_rows != theirs.num_rows:
        return f"{ours.num_rows} rows and {theirs.num_rows}"
    for mine, other in zip(_sorted_rows(ours), _sorted_rows(theirs)):
        if mine != other:
            return f"{mine} and {other}"
    return ""
