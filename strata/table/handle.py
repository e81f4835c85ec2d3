"""A handle on a table path, for callers that hold one across operations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from strata.table.versioned import delete_from_table, update_table
from strata.table.log import Commit
from strata.table.versioned import read_table, table_exists, table_version


class VersionedTable:
    """Handle on a table path, for callers that hold one across operations."""

    def __init__(self, spark: SparkSession, path: str, format: str = "parquet"):
        self.spark = spark
        self.path = path
        self.format = format

    @classmethod
    def for_path(cls, spark: SparkSession, path: str, format: str = "parquet") -> "VersionedTable":
        if not table_exists(spark, path, format=format):
            raise ValueError(f"no table at {path}")
        return cls(spark, path, format)

    def to_df(self, version_as_of: int | None = None) -> DataFrame:
        return read_table(self.spark, self.path, version_as_of=version_as_of, format=self.format)

    def update(self, condition, assignments: Mapping[str, object]) -> Commit | None:
        return update_table(self.spark, self.path, condition, assignments, format=self.format)

    def delete(self, condition=None) -> Commit | None:
        return delete_from_table(self.spark, self.path, condition, format=self.format)

    def version(self) -> int | None:
        return table_version(self.spark, self.path)
