"""Counts, distinct values, a cardinality guard and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import col_of


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    """Row count as a one-row DataFrame (lazy)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_values(df: DataFrame, *cols) -> DataFrame:
    """Distinct combinations of ``cols`` (hash aggregate with map-side combine)."""
    return df.select(*[col_of(c) for c in cols]).distinct()


class CardinalityError(ValueError):
    """A column does not have the expected number of distinct values."""


def expect_distinct(df: DataFrame, column: str, expected: int) -> list:
    """Require exactly ``expected`` distinct values of ``column``.

    At most ``expected + 1`` values reach the driver, however large the
    table. Returns the values sorted (NULL first); raises CardinalityError
    naming what was found otherwise.
    """
    found = [r[0] for r in df.select(col_of(column)).distinct().limit(expected + 1).collect()]
    found.sort(key=lambda v: (v is not None, v))
    if len(found) != expected:
        shown = found if len(found) <= expected else f"more than {expected}, e.g. {found}"
        count = len(found) if len(found) <= expected else f"more than {expected}"
        raise CardinalityError(f"{column} should take {expected} values but takes {count} ({shown})")
    return found


def first_rows(df: DataFrame, order_by=(), n: int = 20) -> DataFrame:
    """The first ``n`` rows, by ``order_by`` when given (top-k, no global sort)."""
    keys = [c if not isinstance(c, str) else F.col(c).asc() for c in order_by]
    return (df.orderBy(*keys) if keys else df).limit(n)
