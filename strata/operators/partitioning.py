"""Partition-count and layout control ahead of writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round_robin(df: DataFrame, n: int | None) -> DataFrame:
    """Even round-robin spread over ``n`` partitions; 0/None leaves ``df``.

    Spark sorts rows locally before the round-robin so a retried task gets
    the same rows (safe under executor loss).
    """
    return df.repartition(n) if n else df


def coalesce_to(df: DataFrame, n: int) -> DataFrame:
    """Merge down to ``n`` partitions without a shuffle.

    ``n`` tasks then do all upstream work; pick it from data size
    (``n=1`` only for outputs known to be small).
    """
    return df.coalesce(n)


def balance_by(df: DataFrame, *cols: str) -> DataFrame:
    """Group rows by ``cols`` for a partitioned write, AQE-sized.

    A value holding a large share of rows is split over several tasks and
    small groups are merged, so each output directory gets few, full files
    and no task holds a whole hot group.
    """
    return df.hint("rebalance", *cols) if cols else df.hint("rebalance")


def ordered_ranges(df: DataFrame, *keys: str) -> DataFrame:
    """Consecutive ranges of ``keys`` in consecutive partitions, sorted within.

    A value of all keys that holds very many rows is split by a hash of the
    other columns, which orders nothing but equal rows.
    """
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType) and f.name not in keys]
    spread = [F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in plain])] if plain else []
    return df.repartitionByRange(*keys, *spread).sortWithinPartitions(*keys, *spread)


def global_sort(df: DataFrame, *keys) -> DataFrame:
    """All rows in ascending order of ``keys``, NULLs first: range partitioning
    on sampled bounds, then a sort in each partition, so file ``i`` of a write
    holds smaller rows than file ``i + 1``."""
    return df.orderBy(*[k if not isinstance(k, str) else F.col(k).asc() for k in keys])
