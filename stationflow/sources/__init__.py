"""Readers and writers."""

from .files import read_csv, read_dataset, read_source, write_csv, write_metrics, write_parquet
from .jdbc import connection_properties, read_jdbc, write_jdbc
from .storage import shared_dir, staged, wide_rows
from .tables import ML_TABLE, RAW_TABLE, check_schema, create_tables, replace_cities

__all__ = [
    "ML_TABLE", "RAW_TABLE", "check_schema", "connection_properties", "create_tables", "read_csv", "read_dataset",
    "read_jdbc", "read_source", "replace_cities", "shared_dir", "staged", "wide_rows", "write_csv", "write_jdbc", "write_metrics", "write_parquet",
]
