"""Named query plans (with DuckDB oracles) and plan inspection helpers."""

from strata.plans.catalog import ORACLE_SQL, QUERIES
from strata.plans.inspect import exchanges, partition_filters, plan_text, pushed_filters, read_schemas

__all__ = [
    "ORACLE_SQL",
    "QUERIES",
    "exchanges",
    "partition_filters",
    "plan_text",
    "pushed_filters",
    "read_schemas",
]
