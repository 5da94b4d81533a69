"""Readers for raw CSV and processed Parquet, and the table catalog."""

from terracelake.sources.catalog import (
    add_new_partitions, read_table, register_tables, table_folders, use_database,
)
from terracelake.sources.files import read_csv, read_parquet, read_tagged_csv

__all__ = [
    "add_new_partitions", "read_csv", "read_parquet", "read_table", "read_tagged_csv",
    "register_tables", "table_folders", "use_database",
]
