"""JSON directory -> versioned table, in one read and one write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.columns import with_ingest_timestamp
from strata.operators.partitioning import round_robin
from strata.sources.json import CORRUPT_COLUMN, inferred, read_json, text_reader, unread_files
from strata.table.log import Commit
from strata.table.schema import holds
from strata.table.versioned import check_write, read_table, table_commit, table_version, write_table


@dataclass
class IngestResult:
    source: DataFrame | None
    """The frame that was written (lazy; re-running it scans the input again);
    None if nothing was."""
    commit: Commit | None
    """The new version, or None when mode ``ignore`` found a table."""
    path: str
    format: str = "parquet"
    spark: SparkSession | None = None
    skipped_files: DataFrame | None = None
    """(path, length) of files of which no row was read, where
    ``ignore_corrupt_files`` allows that (lazy; lists and scans the input again)."""

    @property
    def rows_written(self) -> int | None:
        """Rows counted while writing (no second scan); None if nothing was written."""
        if self.commit is None:
            return None
        return self.commit.metrics.get("rows_written")

    def table(self) -> DataFrame:
        """The table as stored now."""
        return read_table(self.spark, self.path, format=self.format)


def ingest_json(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    *,
    recursive: bool = True,
    multiline: bool = False,
    repartition: int | None = None,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    merge_schema: bool = False,
    overwrite_schema: bool = False,
    schema: StructType | str | None = None,
    glob: str | None = None,
    ignore_corrupt_files: bool = False,
    check_multiline: bool = True,
    ingest_timestamp: str | None = None,
    rebalance: bool = True,
    format: str = "parquet",
) -> IngestResult:
    """Read a JSON directory and write it as a new table version.

    ``repartition=n`` spreads rows round-robin over ``n`` writer tasks (falsy:
    skipped). Otherwise a partitioned write is rebalanced on the partition
    columns (``rebalance=False`` writes as read). ``schema`` skips the
    inference pass over the input; ``ingest_timestamp`` names an optional
    column stamped with the write time. What the mode and the flags decide by
    themselves is decided before the input is touched. A file that cannot be
    read fails the ingest and leaves no version; ``ignore_corrupt_files`` opts
    out of that, and ``IngestResult.skipped_files`` lists what it skipped.

    An append of JSON Lines without ``schema`` takes the table's columns and
    reads the input once: the pass that writes also observes the merged schema of
    what it read. Only if that has a column the table lacks, a wider type, or a
    bad line are the written rows removed and the schema inferred as for a new table.
    """
    if not check_write(spark, output_dir, mode=mode, overwrite_schema=overwrite_schema, format=format):
        return IngestResult(source=None, commit=None, path=output_dir, format=format, spark=spark)
    look = {"recursive": recursive, "glob": glob}
    options = {
        "mode": mode,
        "partition_by": partition_by or None,
        "merge_schema": merge_schema,
        "overwrite_schema": overwrite_schema,
        "rebalance": rebalance and not repartition,
        "format": format,
    }

    def prepared(df: DataFrame) -> DataFrame:
        return round_robin(with_ingest_timestamp(df, ingest_timestamp) if ingest_timestamp else df, repartition)

    if schema is None and not multiline and mode.lower() == "append" and format == "parquet":
        if table_version(spark, output_dir) is not None:
            known = [f for f in table_commit(spark, output_dir).schema.fields if f.name != ingest_timestamp]
            lines, observed = _as_known(spark, input_dir, StructType(known), ignore_corrupt_files, **look)
            df = prepared(lines)
            commit = write_table(df, output_dir, accept=lambda: _fits(observed, StructType(known)), **options)
            if commit is not None:
                return _result(spark, input_dir, output_dir, df, commit, format, ignore_corrupt_files, StructType(known), look)
    rows = read_json(
        spark,
        input_dir,
        multiline=multiline,
        schema=schema,
        ignore_corrupt_files=ignore_corrupt_files,
        check_multiline=check_multiline,
        **look,
    )
    df = prepared(rows)
    commit = write_table(df, output_dir, **options)
    return _result(spark, input_dir, output_dir, df, commit, format, ignore_corrupt_files, rows, look)


def _result(spark, input_dir, output_dir, df, commit, format, ignore_corrupt_files, rows, look) -> IngestResult:
    skipped = None
    if ignore_corrupt_files:
        if isinstance(rows, StructType):
            rows = read_json(spark, input_dir, schema=rows, ignore_corrupt_files=True, **look)
        skipped = unread_files(spark, input_dir, rows, **look)
    return IngestResult(df, commit, output_dir, format, spark, skipped)


def _as_known(
    spark: SparkSession, path: str, known: StructType, ignore_corrupt_files: bool, **look
) -> tuple[DataFrame, Observation]:
    """JSON Lines as rows of known columns, and what their own schema is once they are read."""
    lines = text_reader(spark, ignore_corrupt_files=ignore_corrupt_files, **look).load(path).where(F.trim("value") != "")
    observed = Observation()
    value = F.try_parse_json("value")
    lines = lines.observe(
        observed, F.schema_of_variant_agg(value).alias("seen"), F.count_if(value.isNull()).alias("bad")
    )
    corrupt = CORRUPT_COLUMN if CORRUPT_COLUMN not in known.names else "strata_corrupt"
    parsed = StructType([*known.fields, StructField(corrupt, StringType())])
    rows = lines.select(F.from_json("value", parsed, {"columnNameOfCorruptRecord": corrupt}).alias("row"))
    return rows.select(*[F.col("row").getField(name).alias(name) for name in known.names]), observed


def _fits(observed: Observation, known: StructType) -> bool:
    """Whether all lines were records of known columns. What was not observed does not fit."""
    try:
        found = observed.get
    except Exception:  # the plan was folded away
        return False
    seen = found.get("seen") or ""
    given = inferred(seen) if seen.startswith("OBJECT<") and not found.get("bad") else None
    return given is not None and holds(known, given)
