"""Scans of the raw inputs (Parquet globs of one or several schemas, CSV with a
declared schema, and what a CSV scan loses)."""

from arrivals_mart.sources.files import (
    csv_losses,
    files_of,
    preview,
    read_csv,
    read_csv_checked,
    read_parquet,
    read_parquet_conformed,
    register_view,
    schema_groups,
)

__all__ = [
    "csv_losses",
    "files_of",
    "preview",
    "read_csv",
    "read_csv_checked",
    "read_parquet",
    "read_parquet_conformed",
    "register_view",
    "schema_groups",
]
