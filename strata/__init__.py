"""Versioned-table ingestion and table operations on Spark DataFrames."""

from strata.operators.ingest import IngestResult, ingest_json
from strata.session import configure, get_session
from strata.table import (
    VersionedTable,
    delete_from_table,
    read_table,
    table_exists,
    update_table,
    write_table,
)

__all__ = [
    "IngestResult",
    "VersionedTable",
    "configure",
    "delete_from_table",
    "get_session",
    "ingest_json",
    "read_table",
    "table_exists",
    "update_table",
    "write_table",
]
