"""JSON / JSON Lines directory scans with inferred or given schemas."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

WHOLE_DOCUMENT = 32 << 20
"""Files up to this size are looked at as one string each; larger ones line by line."""

CORRUPT_COLUMN = "_corrupt_record"


class MultilineMismatchError(ValueError):
    """multiline=True on JSON Lines input, which would drop all but one record per file."""


def json_reader(
    spark: SparkSession,
    *,
    recursive: bool = True,
    multiline: bool = False,
    glob: str | None = None,
    schema: StructType | str | None = None,
    ignore_corrupt_files: bool = False,
    corrupt_column: str | None = None,
    infer_timestamp: bool = False,
):
    reader = spark.read.format("json").option("multiLine", str(bool(multiline)).lower())
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if ignore_corrupt_files:
        reader = reader.option("ignoreCorruptFiles", "true")
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if infer_timestamp:
        reader = reader.option("inferTimestamp", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader


def read_json(
    spark: SparkSession,
    path: str,
    *,
    recursive: bool = True,
    multiline: bool = False,
    glob: str | None = None,
    schema: StructType | str | None = None,
    ignore_corrupt_files: bool = False,
    corrupt_column: str | None = None,
    infer_timestamp: bool = False,
    check_multiline: bool = True,
) -> DataFrame:
    """Read a directory of JSON or JSON Lines files.

    Without ``schema`` Spark infers one (an extra distributed pass; columns
    come out sorted by name). With ``recursive`` sub-directories are read
    and ``k=v`` directories give no partition column. Malformed lines are
    kept with all fields NULL and the raw text in ``_corrupt_record`` (or
    ``corrupt_column``). A file that cannot be read is an error;
    ``ignore_corrupt_files`` reads what it can of it instead; ``unread_files``
    lists those of which that was nothing.

    With ``multiline`` each file is one JSON document (object or array);
    a JSON Lines file would silently yield only its first record, so by
    default a distributed check rejects such input first. The pass that infers
    the schema is that check too, unless a file is not one JSON value, is over
    ``WHOLE_DOCUMENT`` bytes, or types conflict: then it is a pass by itself.
    """
    if multiline and check_multiline:
        look = {"recursive": recursive, "glob": glob, "ignore_corrupt_files": ignore_corrupt_files}
        seen = None
        if schema is None and not infer_timestamp and not corrupt_column:
            seen = documents_schema(spark, path, **look)
        if seen is None:
            assert_not_json_lines(spark, path, **look)
        schema = schema if seen is None else seen
    reader = json_reader(
        spark,
        recursive=recursive,
        multiline=multiline,
        glob=glob,
        schema=schema,
        ignore_corrupt_files=ignore_corrupt_files,
        corrupt_column=corrupt_column,
        infer_timestamp=infer_timestamp,
    )
    return reader.load(path)


def inferred(seen: str | None) -> StructType | None:
    """Columns of records with a merged variant schema, as Spark's own inference
    has them; None where that would not follow from the schema alone (types that
    conflict, empty objects, numbers of more digits than a long's)."""

    def plain(kind: T.DataType) -> T.DataType | None:
        if isinstance(kind, T.NullType):
            return T.StringType()
        if isinstance(kind, T.DecimalType):
            return T.DoubleType() if kind.scale or kind.precision <= 18 else None  # 10.0 has no scale
        if isinstance(kind, T.ArrayType):
            inner = plain(kind.elementType)
            return inner and T.ArrayType(inner)
        if isinstance(kind, T.StructType):
            fields = [T.StructField(f.name, plain(f.dataType)) for f in kind.fields if plain(f.dataType) is not None]
            return T.StructType(fields) if fields and len(fields) == len(kind.fields) else None
        return kind if isinstance(kind, (T.LongType, T.DoubleType, T.StringType, T.BooleanType)) else None

    if not seen or not seen.startswith(("OBJECT<", "ARRAY<OBJECT<")):
        return None
    pieces = re.split(r"(`(?:[^`]|``)*`)", seen)  # names in quotes stay as they are
    ddl = "".join(p if i % 2 else p.replace("OBJECT<", "STRUCT<") for i, p in enumerate(pieces))
    kind = T.DataType.fromDDL(ddl)
    kind = plain(kind.elementType if isinstance(kind, T.ArrayType) else kind)
    return kind if isinstance(kind, T.StructType) else None


def text_reader(spark: SparkSession, *, recursive: bool, glob: str | None, ignore_corrupt_files: bool, kind: str = "text"):
    reader = spark.read.format(kind)
    if ignore_corrupt_files:
        reader = reader.option("ignoreCorruptFiles", "true")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader


def documents_schema(
    spark: SparkSession, path: str, *, recursive: bool = True, glob: str | None = None, ignore_corrupt_files: bool = False
) -> StructType | None:
    """Columns of files that are one JSON document each, from one pass over them;
    None if that does not decide it (see ``read_json``)."""
    look = {"recursive": recursive, "glob": glob, "ignore_corrupt_files": ignore_corrupt_files}
    listed = text_reader(spark, **look, kind="binaryFile").load(path).select("length")  # names and sizes only
    if (listed.agg(F.max("length")).first()[0] or 0) > WHOLE_DOCUMENT:
        return None
    docs = text_reader(spark, **look).option("wholetext", "true").load(path)
    # the rule of json_lines_files: a whole value on the first line, and more behind it
    lines = F.split(F.btrim("value", F.lit(" \t\r\n")), "[\r\n]+", 2)
    goes_on = (F.size(lines) > 1) & _whole_value(F.get(lines, F.lit(0)))
    parsed = docs.select(F.try_parse_json("value").alias("v"), goes_on.alias("goes_on"))
    bad = F.count_if(F.col("v").isNull() | F.col("goes_on"))
    found = parsed.agg(F.schema_of_variant_agg("v").alias("seen"), bad.alias("bad")).first()
    return None if found.bad else inferred(found.seen)


def unread_files(
    spark: SparkSession, path: str, rows: DataFrame, *, recursive: bool = True, glob: str | None = None
) -> DataFrame:
    """(path, length) of the files under ``path``, empty ones aside, that gave no
    row of ``rows``, the frame a reader returned: with ``ignore_corrupt_files``
    the ones that were skipped whole. A file of which some rows were read is not
    listed. Lazy; evaluating it lists the files and scans the input once more."""
    listed = text_reader(spark, recursive=recursive, glob=glob, ignore_corrupt_files=False, kind="binaryFile").load(path)
    listed = listed.where("length > 0").select("path", "length", F.col("_metadata.file_path").alias("_file"))
    read = rows.select(F.col("_metadata.file_path").alias("_file")).distinct()
    return listed.join(read, "_file", "left_anti").select("path", "length")


def json_lines_files(
    spark: SparkSession,
    path: str,
    *,
    recursive: bool = True,
    glob: str | None = None,
    ignore_corrupt_files: bool = False,
) -> DataFrame:
    """Files whose first line that is not blank is a whole JSON value, with
    another line that is not blank after it.

    A JSON document cannot go on after its first complete value, so this is
    exact. A line-split text scan (parallel over file splits) keeps each file's
    first two such lines by position; only the names of offending files come
    back.
    """
    reader = text_reader(spark, recursive=recursive, glob=glob, ignore_corrupt_files=ignore_corrupt_files)
    # Splits of a file come with their start; within one, ids follow the lines.
    at = F.struct(
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
    )
    lines = reader.load(path).select(F.col("_metadata.file_path").alias("file"), at.alias("at"), "value")
    lines = lines.where(F.trim("value") != "").withColumn("whole", _whole_value(F.col("value")))
    first = lines.groupBy("file").agg(
        F.min_by("whole", "at").alias("whole"), F.count(F.lit(1)).alias("lines")
    )
    return first.where("whole AND lines > 1").select("file", "lines")


def _whole_value(line: Column) -> Column:
    """Whether the line is a JSON object or array by itself (brackets first,
    so few lines are parsed)."""
    value = F.trim(line)
    objects, arrays = value.startswith("{") & value.endswith("}"), value.startswith("[") & value.endswith("]")
    return F.coalesce(F.when(objects | arrays, F.try_parse_json(value).isNotNull()), F.lit(False))


def assert_not_json_lines(
    spark: SparkSession,
    path: str,
    *,
    recursive: bool = True,
    glob: str | None = None,
    ignore_corrupt_files: bool = False,
) -> None:
    offenders = (
        json_lines_files(
            spark, path, recursive=recursive, glob=glob, ignore_corrupt_files=ignore_corrupt_files
        )
        .limit(3)
        .collect()
    )
    if offenders:
        names = ", ".join(f"{r['file']} ({r['lines']} lines)" for r in offenders)
        raise MultilineMismatchError(
            "multiline=True reads one JSON document per file, but these files hold "
            f"one record per line: {names}; read them with multiline=False"
        )


def split_corrupt(
    df: DataFrame, corrupt_column: str = CORRUPT_COLUMN
) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, bad rows' raw text)."""
    if corrupt_column not in df.columns:
        return df, df.sparkSession.createDataFrame([], f"`{corrupt_column}` string")
    flag = F.col(corrupt_column)
    good = df.where(flag.isNull()).drop(corrupt_column)
    bad = df.where(flag.isNotNull()).select(corrupt_column)
    return good, bad
