"""Writers: CSV files, tables, relational databases."""

from __future__ import annotations

from pyspark.sql import DataFrame

from palimpsest.sinks.csv_files import write_csv, write_parallel_csv
from palimpsest.sinks.database import write_database, write_database_in_batches
from palimpsest.sinks.jdbc import write_jdbc
from palimpsest.sinks.tables import load_dump, load_table

SINKS = {
    "csv": write_csv,
    "parallel_csv": write_parallel_csv,
    "table": load_table,
    "dump": load_dump,
    "jdbc": write_jdbc,
    "database": write_database,
    "database_batches": write_database_in_batches,
}


def write_revisions(rows: DataFrame, sink: str, *target, **options):
    """Write rows, from any source that has the 11 fields, to the named sink."""
    if sink not in SINKS:
        raise ValueError(f"sink is one of {', '.join(SINKS)}")
    return SINKS[sink](rows, *target, **options)
