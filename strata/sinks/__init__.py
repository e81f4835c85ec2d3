"""File sinks (the versioned-table sink lives in ``strata.table``)."""

from strata.sinks.files import (
    EXPORT_PREFIX,
    export_split_json,
    write_json,
    write_parquet,
)

__all__ = [
    "EXPORT_PREFIX",
    "export_split_json",
    "write_json",
    "write_parquet",
]
