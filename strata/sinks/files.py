"""File sinks: parquet, JSON, split export."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.functions.columns import col_of
from strata.operators.partitioning import balance_by, ordered_ranges

EXPORT_PREFIX = "part_"


def write_parquet(
    df: DataFrame, path: str, *, mode: str = "overwrite", partition_by: list[str] | None = None
) -> None:
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_json(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    compression: str | None = None,
) -> None:
    """JSON Lines files (``part-*.json``); NULL fields are left out and
    timestamps are written with millisecond precision."""
    writer = df.write.mode(mode).format("json")
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def export_split_json(
    df: DataFrame,
    path: str,
    by: list[str] | tuple[str, ...] = ("year", "month"),
    *,
    order_by: list[str] | tuple[str, ...] = (),
    mode: str = "overwrite",
) -> list[str]:
    """One output directory per combination of ``by`` values, in one job.

    With mode ``overwrite`` only the groups in ``df`` are replaced; groups that
    an earlier export wrote stay. With ``order_by`` a group is in that order over
    its files, in order of their names: rows are range-partitioned by group and
    order (NULLs first), so a group too large for one task is several files, each
    with the rows between two bounds. Rows that are equal in ``order_by`` are in
    no particular order, and spread by a hash of their other columns.

    The grouping columns stay inside the rows; copies named ``part_<col>``
    drive the directory layout (``part_year=2024/part_month=12/``). Without
    ``order_by`` rows are rebalanced on the copies, so every group's rows land in
    few files while a group holding most rows is still written by several tasks.
    Returns the names of the directory columns.
    """
    by = [by] if isinstance(by, str) else list(by)
    dir_cols = [f"{EXPORT_PREFIX}{c}" for c in by]
    laid_out = df.withColumns({d: col_of(c) for d, c in zip(dir_cols, by)})
    if order_by:  # the writer needs the group columns first, and then keeps the order
        dealt = ordered_ranges(laid_out, *dir_cols, *order_by)
    else:
        dealt = balance_by(laid_out, *dir_cols)
    writer = dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*dir_cols).json(path)
    return dir_cols
