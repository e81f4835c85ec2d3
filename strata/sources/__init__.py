"""Scans: JSON directories, parquet, inline rows, ranges."""

from strata.sources.files import id_range, read_parquet, rows
from strata.sources.json import (
    CORRUPT_COLUMN,
    MultilineMismatchError,
    assert_not_json_lines,
    json_lines_files,
    read_json,
    split_corrupt,
    unread_files,
)

__all__ = [
    "CORRUPT_COLUMN",
    "MultilineMismatchError",
    "assert_not_json_lines",
    "id_range",
    "json_lines_files",
    "read_json",
    "read_parquet",
    "rows",
    "split_corrupt",
    "unread_files",
]
