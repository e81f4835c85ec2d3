"""Operators: ingest, partition control, checks."""

from strata.operators.checks import (
    CardinalityError,
    count_rows,
    distinct_values,
    expect_distinct,
    first_rows,
)
from strata.operators.ingest import IngestResult, ingest_json
from strata.operators.partitioning import balance_by, coalesce_to, global_sort, ordered_ranges, round_robin

__all__ = [
    "CardinalityError",
    "IngestResult",
    "balance_by",
    "coalesce_to",
    "count_rows",
    "distinct_values",
    "expect_distinct",
    "first_rows",
    "global_sort",
    "ingest_json",
    "ordered_ranges",
    "round_robin",
]
