"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of shared files, not a
    recomputation of everything before.
    """
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with one output batch for each input batch; ``fn`` maps a
    ``pyarrow.RecordBatch`` to a dict of columns in the order of ``schema``."""
    arrow = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield to_batch(fn(batch), arrow)

    return df.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def to_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)
            for f in schema
        ],
        schema=schema,
    )


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (null: empty) as one array, and the
    offsets of its rows, without a copy."""
    column = column.fill_null("") if column.null_count else column
    if pa.types.is_large_string(column.type):
        offsets = np.frombuffer(column.buffers()[1], np.int64)
    else:
        offsets = np.frombuffer(column.buffers()[1], np.int32).astype(np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def group_rows(df: DataFrame, key: list[str], fn, schema: str) -> DataFrame:
    """``fn(key, rows)`` for the rows of each key, one key in memory at a time;
    ``df`` starts with the key and is sorted by it within partitions."""
    arrow, width = arrow_schema(df.sparkSession, schema), len(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, parts = None, []
        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(width)), strict=True))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for start, end in zip(cuts, cuts[1:], strict=False):
                if start == end:
                    continue
                if keys[start] != last and parts:
                    yield to_batch(fn(last, pa.Table.from_batches(parts)), arrow)
                    parts = []
                last = keys[start]
                parts.append(batch.slice(start, end - start))
        if parts:
            yield to_batch(fn(last, pa.Table.from_batches(parts)), arrow)

    return df.mapInArrow(run, schema)


def first_by_hash(rows: DataFrame, n: int, *key, total: int | None = None) -> DataFrame:
    """The ``n`` rows of smallest hash of ``key``: a sample that does not depend
    on how rows are laid out. Only about ``4 * n`` rows, whatever the input and
    the number of tasks, get past the hash to be ordered. ``total``: the number
    of rows, if known."""
    total = rows.count() if total is None else total
    h = F.xxhash64(*key)
    if total > 4 * n:
        rows = rows.where(h < min(2**63 - 1, -(2**63) + 2**64 * 4 * n // total))
    return rows.orderBy(h, *key).limit(n)


def numbered(spark: SparkSession, rows: DataFrame, keys: list, name: str) -> DataFrame:
    """``rows`` (deterministic: read from a table, or a function of one) with
    their ``place`` from 1 in the order of ``keys``; rows with equal keys in any order.

    A range-partitioned sort is written, so no task orders all rows; a place is
    the row's index in its file after the rows of earlier files. One count for
    each file reaches the driver, as many as the sort has partitions.
    """
    path = scratch_path(spark, name)
    # The last key only parts equal rows, so that very many of them are several partitions.
    even = rows.withColumn("_row", F.monotonically_increasing_id())
    even.orderBy(*keys, "_row").drop("_row").write.parquet(path)
    number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
    placed = spark.read.schema(rows.schema).parquet(path).select(
        *rows.columns, number.alias("_file"), F.col("_metadata.row_index").alias("_nth")
    )
    start, starts = 0, []
    for row in placed.groupBy("_file").agg(F.count(F.lit(1)).alias("n")).orderBy("_file").collect():
        starts.append((row["_file"], start))
        start += row.n
    files = F.broadcast(spark.createDataFrame(starts, "_file long, _start long"))
    return placed.join(files, "_file").select(*rows.columns, (F.col("_start") + F.col("_nth") + 1).alias("place"))


def fold(doc_id: str, parts: int):
    """crc32 of the id as text, modulo ``parts`` (null ids: null)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def crc_fold(doc_id: int, parts: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % parts


def components(spark: SparkSession, edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges`` (a long, b long): (v, component), the
    smallest vertex reachable, for every vertex that has an edge.

    Every round points each vertex at its smallest neighbour and contracts the
    graph along these pointers, so the number of rounds grows with the
    logarithm of the longest path. All state is in written tables; a vertex
    with very many neighbours meets its pointer in a join that Spark can split.
    """
    edges = materialize(
        spark,
        edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        f"{name}-edges",
    )
    maps = []
    while True:
        both = edges.union(edges.select("b", "a"))
        pointer = materialize(
            spark, both.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p")), f"{name}-p"
        )
        maps.append(pointer)
        edges = materialize(
            spark,
            edges.join(pointer.withColumnRenamed("p", "pa"), "a")
            .join(pointer.select(F.col("a").alias("b"), F.col("p").alias("pb")), "b")
            .where("pa != pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct(),
            f"{name}-edges",
        )
        if edges.isEmpty():
            break
    out = maps[0].select(F.col("a").alias("v"), F.col("p").alias("component"))
    for pointer in maps[1:]:
        out = out.join(pointer.withColumnRenamed("a", "component"), "component", "left").select(
            "v", F.coalesce("p", "component").alias("component")
        )
    return materialize(spark, out, f"{name}-out")
