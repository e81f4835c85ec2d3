"""Column derivations used by the ingest and export steps.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Millimetres per inch, and the description literal of the
# feature example.
MM_PER_INCH = 25.4
FEATURE_DESCRIPTION = "CAD Feature"


def col_of(value) -> Column:
    """Column as given; a string is a column name."""
    return value if isinstance(value, Column) else F.col(value)


def predicate(text: str) -> Column:
    """SQL-text predicate or expression, e.g. ``"id % 2 == 0"``."""
    return F.expr(text)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Bulk rename in one projection; unknown names are ignored and matching
    follows the session's case sensitivity."""
    return df.withColumnsRenamed(dict(mapping))


def year_of(ts) -> Column:
    """Calendar year in the session time zone, as bigint."""
    return F.year(col_of(ts)).cast("bigint")


def month_of(ts) -> Column:
    """Month 1-12 in the session time zone, as bigint."""
    return F.month(col_of(ts)).cast("bigint")


def with_year_month(
    df: DataFrame, ts, *, year_col: str = "year", month_col: str = "month"
) -> DataFrame:
    """Derive partition columns from a timestamp column."""
    return df.withColumns({year_col: year_of(ts), month_col: month_of(ts)})


def mm_to_inch(value) -> Column:
    """Millimetres to inches (double)."""
    return col_of(value).cast("double") / F.lit(MM_PER_INCH)


def with_literal(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def with_ingest_timestamp(df: DataFrame, name: str = "ingestion_ts") -> DataFrame:
    """Stamp rows with the query's start time (one value per query)."""
    return df.withColumn(name, F.current_timestamp())
