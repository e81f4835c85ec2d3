"""Scalar column functions (built-in Spark expressions only)."""

from strata.functions.columns import (
    FEATURE_DESCRIPTION,
    MM_PER_INCH,
    col_of,
    mm_to_inch,
    month_of,
    predicate,
    rename_columns,
    with_ingest_timestamp,
    with_literal,
    with_year_month,
    year_of,
)

__all__ = [
    "FEATURE_DESCRIPTION",
    "MM_PER_INCH",
    "col_of",
    "mm_to_inch",
    "month_of",
    "predicate",
    "rename_columns",
    "with_ingest_timestamp",
    "with_literal",
    "with_year_month",
    "year_of",
]
