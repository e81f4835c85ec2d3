"""Path-addressed versioned tables on plain parquet."""

from strata.table.handle import VersionedTable
from strata.table.log import Commit, CorruptCommitError, TableConflictError
from strata.table.schema import SchemaMismatchError
from strata.table.versioned import (
    TableExistsError,
    check_write,
    delete_from_table,
    read_table,
    table_commit,
    table_exists,
    table_version,
    update_table,
    write_table,
)

__all__ = [
    "Commit",
    "CorruptCommitError",
    "SchemaMismatchError",
    "TableConflictError",
    "TableExistsError",
    "VersionedTable",
    "check_write",
    "delete_from_table",
    "read_table",
    "table_commit",
    "table_exists",
    "table_version",
    "update_table",
    "write_table",
]
