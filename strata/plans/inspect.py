"""Read physical plans to check pruning, pushdown and exchanges."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The ``explain`` output as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def _scan_lists(text: str, key: str) -> list[str]:
    return re.findall(rf"{key}: \[([^\]]*)\]", text)


def partition_filters(df: DataFrame) -> list[str]:
    return [s for s in _scan_lists(plan_text(df), "PartitionFilters") if s]


def pushed_filters(df: DataFrame) -> list[str]:
    return [s for s in _scan_lists(plan_text(df, "simple"), "PushedFilters") if s]


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_text(df, "simple"))


def exchanges(df: DataFrame) -> list[str]:
    """Shuffle / broadcast exchange lines of the physical plan."""
    return [
        line.strip()
        for line in plan_text(df, "simple").splitlines()
        if "Exchange" in line and "ReusedExchange" not in line
    ]
