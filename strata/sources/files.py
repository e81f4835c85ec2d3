"""Parquet scans, inline rows and integer ranges."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_parquet(
    spark: SparkSession,
    path: str,
    *paths: str,
    schema: StructType | str | None = None,
    ignore_corrupt_files: bool = False,
    recursive: bool = False,
) -> DataFrame:
    """Parquet scan; filters and projections reach the scan through Catalyst.

    A damaged file is an error; ``ignore_corrupt_files`` reads what it can of
    it instead, and nothing tells how much that was.
    """
    reader = spark.read.format("parquet")
    if ignore_corrupt_files:
        reader = reader.option("ignoreCorruptFiles", "true")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load([path, *paths]) if paths else reader.load(path)


def rows(
    spark: SparkSession,
    records: Iterable[dict] | Iterable[tuple],
    schema: StructType | str | None = None,
) -> DataFrame:
    """DataFrame from driver-side records (small, hand-written data only).

    Dict keys become columns; without a schema Spark sorts them by name and
    infers types (int -> bigint, float -> double).
    """
    return spark.createDataFrame(list(records), schema)


def id_range(spark: SparkSession, start: int, end: int | None = None, step: int = 1) -> DataFrame:
    """Column ``id`` (bigint) from ``start`` to ``end`` exclusive; generated on executors."""
    if end is None:
        return spark.range(start)
    return spark.range(start, end, step)
