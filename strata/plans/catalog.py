"""Named queries over the driver's tables, each with a DuckDB oracle.

Every query reads the given parquet tables (or files Spark writes from
them), so its work grows with the scale factor. Queries that write use a
fresh folder under the session's shared checkpoint directory and leave it in
place: the returned DataFrames are lazy reads of what was written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.columns import (
    FEATURE_DESCRIPTION,
    mm_to_inch,
    predicate,
    rename_columns,
    with_literal,
    with_year_month,
)
from strata.operators.checks import count_rows, distinct_values, expect_distinct, first_rows
from strata.operators.ingest import ingest_json
from strata.operators.partitioning import coalesce_to, global_sort, round_robin
from strata.session import scratch_path
from strata.sinks.files import export_split_json, write_json, write_parquet
from strata.sources.files import read_parquet
from strata.sources.json import read_json, unread_files
from strata.table import (
    TableExistsError,
    VersionedTable,
    delete_from_table,
    read_table,
    update_table,
    write_table,
)
from strata.table.fs import HadoopFS

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the queries.
LINEITEM_RENAMES = {
    "l_orderkey": "order_id",
    "l_partkey": "part_id",
    "l_suppkey": "supplier_id",
    "l_linenumber": "line_no",
}
SPLIT_DATE = "1998-01-01"
EXPECTED_ORDER_YEARS = 7
URGENT = "1-URGENT"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders plus bigint ``year``/``month`` of the order date."""
    return with_year_month(table(spark, sf_dir, "orders"), "o_orderdate")


# --- scans and sources --------------------------------------------------


def q01_json_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = scratch_path(spark, "q01-json")
    dst = scratch_path(spark, "q01-table")
    write_json(orders_by_month(spark, sf_dir), src)
    ingest_json(spark, src, dst, partition_by=["year", "month"])
    return read_table(spark, dst).select("o_orderkey", "o_totalprice", "o_orderdate", "year", "month")


def q02_json_recursive_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "q02")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    final = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    write_json(orders.where(final), f"{root}/final")
    write_json(orders.where(~final), f"{root}/open/nested/deeper")
    # A decoy with the same records as text files: the glob must skip it.
    orders.select(F.to_json(F.struct(*orders.columns)).alias("value")).write.text(f"{root}/open/decoy")
    return read_json(spark, root, recursive=True, glob="*.json").select("o_orderkey", "o_custkey")


def write_documents(df: DataFrame, path: str, *, bytes_per_file: int = 1 << 20) -> None:
    """Rows as files of about ``bytes_per_file``, each one pretty-printed JSON
    array over many lines: input for ``multiline=True``."""
    doc = F.to_json(F.struct(*df.columns), {"pretty": "true"})
    docs = df.select(doc.alias("doc"))
    size = docs.agg(F.sum(F.length("doc").cast("long"))).first()[0] or 0
    bucket = F.pmod(F.monotonically_increasing_id(), F.lit(1 + size // bytes_per_file))
    arrays = docs.groupBy(bucket.alias("bucket")).agg(F.concat_ws(",\n", F.collect_list("doc")).alias("rows"))
    arrays = arrays.select(F.concat(F.lit("[\n"), "rows", F.lit("\n]")).alias("value"))
    arrays.write.option("maxRecordsPerFile", 1).text(path)


def q03_json_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "q03")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    write_documents(customers, root)
    return read_json(spark, root, multiline=True).select("c_custkey", "c_name", "c_acctbal")


def q04_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "q04")
    write_parquet(table(spark, sf_dir, "part"), path)
    return read_parquet(spark, path)


# --- projections and filters -------------------------------------------


def q05_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_by_month(spark, sf_dir)


def q06_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = rename_columns(table(spark, sf_dir, "lineitem"), LINEITEM_RENAMES)
    return renamed.select(*LINEITEM_RENAMES.values())


def q07_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = with_literal(table(spark, sf_dir, "part"), "description", FEATURE_DESCRIPTION)
    return parts.select("p_partkey", "description")


def q08_mm_to_inch(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return parts.select("p_partkey", mm_to_inch("p_size").alias("size_inch"))


def q09_filter_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_by_month(spark, sf_dir).where(F.col("year") == 1997).select("o_orderkey", "year")


def q10_filter_modulo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(predicate("o_orderkey % 2 == 0"))


# --- aggregation, distinct, top-k ----------------------------------------


def q11_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(orders_by_month(spark, sf_dir), "year", "month")


def q12_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rows(table(spark, sf_dir, "events"), "n")


def q13_first_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return first_rows(orders, ["o_orderdate", "o_orderkey"], 20)


# --- exports --------------------------------------------------------------


def q14_global_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written in global order; each row with its place in the files."""
    path = scratch_path(spark, "q14")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    write_parquet(global_sort(orders, "o_orderdate", "o_orderkey"), path)
    rows = read_parquet(spark, path).select(
        "o_orderkey", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("nth")
    )
    # Files are numbered in order; one row for each file here.
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n")).select(
        "file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")
    )
    place = (F.col("start") + F.col("nth") + 1).alias("place")
    return rows.join(starts, "file").select("o_orderkey", place)


def q15_split_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two exports to one path: the second replaces its own months only."""
    root = scratch_path(spark, "q15")
    orders = orders_by_month(spark, sf_dir)
    late = F.coalesce(F.col("year") >= 1996, F.lit(False))
    export_split_json(orders.where(~late), root, ["year", "month"], order_by=["o_orderdate"])
    export_split_json(orders.where(late), root, ["year", "month"], order_by=["o_orderdate"])
    return read_json(spark, root, recursive=True, glob="*.json").select("o_orderkey", "year", "month")


# --- versioned tables -----------------------------------------------------


def _orders_in_two_versions(spark: SparkSession, sf_dir: str) -> str:
    """Version 0: orders before SPLIT_DATE; version 1 appends all others."""
    path = scratch_path(spark, "orders-two-versions")
    orders = table(spark, sf_dir, "orders")
    early = F.coalesce(F.col("o_orderdate") < F.lit(SPLIT_DATE).cast("timestamp_ntz"), F.lit(False))
    write_table(orders.where(early), path, mode="overwrite")
    write_table(orders.where(~early), path, mode="append")
    return path


def q16_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _orders_in_two_versions(spark, sf_dir)
    return read_table(spark, path).select("o_orderkey", "o_totalprice")


def q17_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "q17")
    orders = table(spark, sf_dir, "orders")
    write_table(orders, path, mode="overwrite")
    write_table(orders.where(F.col("o_orderstatus") == "F"), path, mode="overwrite")
    return read_table(spark, path).select("o_orderkey")


def q18_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "q18")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    write_table(suppliers, path, mode="errorifexists")
    other = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("s_suppkey"), F.col("c_name").alias("s_name")
    )
    write_table(other, path, mode="ignore")
    try:
        write_table(other, path, mode="errorifexists")
    except TableExistsError:
        return read_table(spark, path).select("s_suppkey", "s_name")
    raise AssertionError("errorifexists wrote over a table that exists")


def q20_version_0(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _orders_in_two_versions(spark, sf_dir)
    return read_table(spark, path, version_as_of=0).select("o_orderkey")


def q21_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "q21")
    customers = table(spark, sf_dir, "customer")
    nation = F.col("c_nationkey").cast("long").alias("nation")
    first = customers.select("c_custkey", "c_name", F.struct(nation).alias("profile"))
    write_table(first, path)
    wider = F.struct(nation, F.col("c_acctbal").cast("double").alias("balance"))
    added = customers.select("c_custkey", "c_mktsegment", wider.alias("profile"))
    write_table(added, path, mode="append", merge_schema=True)
    return read_table(spark, path).select(
        "c_custkey", "c_name", "c_mktsegment", "profile.nation", "profile.balance"
    )


def q22_overwrite_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "q22")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    write_table(orders, path, partition_by=["o_orderstatus"])
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    write_table(customers, path, mode="overwrite", overwrite_schema=True)
    return read_table(spark, path).select("c_custkey", "c_name")


def q23_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "q23")
    orders = orders_by_month(spark, sf_dir).select("o_orderkey", "o_totalprice", "year", "month")
    write_table(orders, path, partition_by=["year", "month"])
    handle = VersionedTable.for_path(spark, path)
    handle.update(predicate("o_orderkey % 2 == 0"), {"o_orderkey": predicate("o_orderkey + 100")})
    return handle.to_df().select("o_orderkey", "o_totalprice", "year", "month")


def q24_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "q24")
    write_table(table(spark, sf_dir, "orders"), path)
    delete_from_table(spark, path, "o_orderkey % 2 == 0")
    return read_table(spark, path)


def q25_update_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "q25")
    orders = orders_by_month(spark, sf_dir).select("o_orderkey", "year", "month")
    write_table(orders, path, partition_by=["year", "month"])
    update_table(spark, path, "o_orderkey % 2 == 0", {"o_orderkey": "o_orderkey + 100"})
    delete_from_table(spark, path, "o_orderkey % 2 == 0")
    return read_table(spark, path).select("o_orderkey")


def q26_pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "q26")
    write_table(orders_by_month(spark, sf_dir), path, partition_by=["year", "month"])
    pruned = read_table(spark, path).where((F.col("year") == 1997) & (F.col("month") == 3))
    return pruned.select("o_orderkey", "year", "month")


# --- partitioning ---------------------------------------------------------


def q27_repartition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round-robin to twice the scan's split count, then merge back down to
    it: partition counts follow the input size (known from planning, no job)."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    splits = max(1, lines.rdd.getNumPartitions())
    return coalesce_to(round_robin(lines, 2 * splits), splits)


def q28_range_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all orders through write, overwrite, update and delete."""
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("long").alias("id"))
    path = scratch_path(spark, "q28")
    write_table(ids, path)
    write_table(ids.select((F.col("id") + 5).alias("id")), path, mode="overwrite")
    handle = VersionedTable.for_path(spark, path)
    handle.update("id % 2 == 0", {"id": "id + 100"})
    handle.delete("id % 2 == 0")
    return handle.to_df()


# --- checks ---------------------------------------------------------------


def q30_distinct_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_by_month(spark, sf_dir)
    expect_distinct(orders, "year", EXPECTED_ORDER_YEARS)
    return distinct_values(orders, "year")


def q31_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON Lines plus a truncated copy of every urgent order."""
    root = scratch_path(spark, "q31")
    orders = table(spark, sf_dir, "orders")
    write_json(orders, f"{root}/good")
    urgent = orders.where(F.col("o_orderpriority") == URGENT)
    docs = urgent.select(F.to_json(F.struct(*orders.columns)).alias("doc"))
    # Cut the closing brace: each such line is malformed JSON.
    docs.select(F.expr("substring(doc, 1, length(doc) - 1)").alias("value")).write.text(f"{root}/bad")
    lines = read_json(spark, root, recursive=True)
    corrupt = F.col("_corrupt_record")
    return lines.agg(
        F.count(F.when(corrupt.isNull(), F.col("o_orderkey"))).alias("good"),
        F.count(F.when(corrupt.isNotNull(), F.lit(1))).alias("bad"),
    )


def q32_skip_unreadable_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON next to a file that claims gzip but is not: every order is
    read, and the unreadable file is listed as skipped."""
    root = scratch_path(spark, "q32")
    write_json(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), f"{root}/good")
    HadoopFS(spark, root).write_text("bad/part-broken.json.gz", "this is not gzip data")
    lines = read_json(spark, root, recursive=True, ignore_corrupt_files=True)
    name = F.regexp_extract("path", "[^/]+$", 0).alias("skipped")
    skipped = unread_files(spark, root, lines).select(name, F.col("length").alias("n_bytes"))
    return lines.select("o_orderkey", "o_orderstatus").unionByName(skipped, allowMissingColumns=True)


def q33_widen_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole prices, then prices with cents, into one column; both versions of
    its type are read, the first through time travel."""
    path = scratch_path(spark, "q33")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("price"))
    write_table(orders.select("o_orderkey", F.floor("price").cast("long").alias("price")), path)
    write_table(orders, path, mode="append", merge_schema=True)
    update_table(spark, path, "o_orderkey % 7 = 0 AND price = floor(price)", {"price": "price + 0.5"})
    before = read_table(spark, path, version_as_of=0).select(F.lit(0).alias("version"), "o_orderkey", "price")
    now = read_table(spark, path).select(F.lit(2).alias("version"), "o_orderkey", "price")
    return before.unionByName(now)


def q35_append_known_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON landed in two batches; the second has the table's columns, so it is
    read once."""
    src, dst = scratch_path(spark, "q35-json"), scratch_path(spark, "q35-table")
    orders = orders_by_month(spark, sf_dir).select("o_orderkey", "o_totalprice", "year", "month")
    late = F.coalesce(F.col("year") >= 1996, F.lit(False))
    write_json(orders.where(~late), f"{src}/first")
    write_json(orders.where(late), f"{src}/second")
    ingest_json(spark, f"{src}/first", dst, partition_by=["year", "month"])
    ingest_json(spark, f"{src}/second", dst, partition_by=["year", "month"], mode="append")
    return read_table(spark, dst).select("o_orderkey", "o_totalprice", "year", "month")


def q34_export_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders exported by month in order of date; each row with its place in
    its month over all files of it."""
    root = scratch_path(spark, "q34")
    orders = orders_by_month(spark, sf_dir).select("o_orderkey", "o_orderdate", "year", "month")
    export_split_json(orders, root, ["year", "month"], order_by=["o_orderdate", "o_orderkey"])
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(root)
    lines = lines.select(
        F.from_json("value", "o_orderkey long, year long, month long").alias("row"),
        F.col("_metadata.file_name").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"),
    ).select("row.*", "file", "at")
    within = Window.partitionBy("year", "month", "file").orderBy("at")
    rows = lines.withColumn("nth", F.row_number().over(within))
    earlier = Window.partitionBy("year", "month").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = lines.groupBy("year", "month", "file").agg(F.count(F.lit(1)).alias("n"))
    starts = files.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    same = [rows[c].eqNullSafe(starts[c]) for c in ("year", "month", "file")]
    place = (starts["start"] + rows["nth"]).alias("place")
    return rows.join(starts, same).select(rows["o_orderkey"], rows["year"], rows["month"], place)


QUERIES: dict[str, Query] = {
    "q01_json_ingest": q01_json_ingest,
    "q02_json_recursive_glob": q02_json_recursive_glob,
    "q03_json_multiline": q03_json_multiline,
    "q04_parquet_roundtrip": q04_parquet_roundtrip,
    "q05_year_month": q05_year_month,
    "q06_rename": q06_rename,
    "q07_literal": q07_literal,
    "q08_mm_to_inch": q08_mm_to_inch,
    "q09_filter_year": q09_filter_year,
    "q10_filter_modulo": q10_filter_modulo,
    "q11_distinct": q11_distinct,
    "q12_count": q12_count,
    "q13_first_20": q13_first_20,
    "q14_global_sort": q14_global_sort,
    "q15_split_export": q15_split_export,
    "q16_append": q16_append,
    "q17_overwrite": q17_overwrite,
    "q18_ignore": q18_ignore,
    "q20_version_0": q20_version_0,
    "q21_merge_schema": q21_merge_schema,
    "q22_overwrite_schema": q22_overwrite_schema,
    "q23_update": q23_update,
    "q24_delete": q24_delete,
    "q25_update_delete": q25_update_delete,
    "q26_pruned_read": q26_pruned_read,
    "q27_repartition": q27_repartition,
    "q28_range_lifecycle": q28_range_lifecycle,
    "q30_distinct_guard": q30_distinct_guard,
    "q31_bad_lines": q31_bad_lines,
    "q32_skip_unreadable_files": q32_skip_unreadable_files,
    "q33_widen_type": q33_widen_type,
    "q34_export_order": q34_export_order,
    "q35_append_known_columns": q35_append_known_columns,
}

_B = (
    "(SELECT *, year(o_orderdate)::BIGINT AS year, month(o_orderdate)::BIGINT AS month "
    "FROM orders)"
)

ORACLE_SQL: dict[str, str] = {
    "q01_json_ingest": (
        "SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') "
        f"AS o_orderdate, year, month FROM {_B} b"
    ),
    "q02_json_recursive_glob": "SELECT o_orderkey, o_custkey FROM orders",
    "q03_json_multiline": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "q04_parquet_roundtrip": "SELECT * FROM part",
    "q05_year_month": f"SELECT * FROM {_B} b",
    "q06_rename": (
        "SELECT l_orderkey AS order_id, l_partkey AS part_id, l_suppkey AS supplier_id, "
        "l_linenumber AS line_no FROM lineitem"
    ),
    "q07_literal": "SELECT p_partkey, 'CAD Feature' AS description FROM part",
    "q08_mm_to_inch": "SELECT p_partkey, p_size::DOUBLE / 25.4::DOUBLE AS size_inch FROM part",
    "q09_filter_year": f"SELECT o_orderkey, year FROM {_B} b WHERE year = 1997",
    "q10_filter_modulo": "SELECT * FROM orders WHERE o_orderkey % 2 = 0",
    "q11_distinct": f"SELECT DISTINCT year, month FROM {_B} b",
    "q12_count": "SELECT count(*) AS n FROM events",
    "q13_first_20": (
        "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 20"
    ),
    "q14_global_sort": (
        "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate NULLS FIRST, o_orderkey) AS place FROM orders"
    ),
    "q15_split_export": f"SELECT o_orderkey, year, month FROM {_B} b",
    "q16_append": "SELECT o_orderkey, o_totalprice FROM orders",
    "q17_overwrite": "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'",
    "q18_ignore": "SELECT s_suppkey, s_name FROM supplier",
    "q20_version_0": (
        f"SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '{SPLIT_DATE}'"
    ),
    "q21_merge_schema": (
        "SELECT c_custkey, c_name, NULL::VARCHAR AS c_mktsegment, c_nationkey::BIGINT AS nation, "
        "NULL::DOUBLE AS balance FROM customer "
        "UNION ALL SELECT c_custkey, NULL::VARCHAR AS c_name, c_mktsegment, c_nationkey::BIGINT AS nation, "
        "c_acctbal::DOUBLE AS balance FROM customer"
    ),
    "q22_overwrite_schema": "SELECT c_custkey, c_name FROM customer",
    "q23_update": (
        "SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey + 100 ELSE o_orderkey END "
        f"AS o_orderkey, o_totalprice, year, month FROM {_B} b"
    ),
    "q24_delete": "SELECT * FROM orders WHERE NOT coalesce(o_orderkey % 2 = 0, false)",
    "q25_update_delete": "SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 1",
    "q26_pruned_read": (
        f"SELECT o_orderkey, year, month FROM {_B} b WHERE year = 1997 AND month = 3"
    ),
    "q27_repartition": "SELECT l_orderkey, l_linenumber FROM lineitem",
    "q28_range_lifecycle": (
        "SELECT id FROM (SELECT o_orderkey::BIGINT + 5 AS id FROM orders) r WHERE id % 2 = 1"
    ),
    "q30_distinct_guard": f"SELECT DISTINCT year FROM {_B} b",
    "q32_skip_unreadable_files": (
        "SELECT o_orderkey, o_orderstatus, NULL::VARCHAR AS skipped, NULL::BIGINT AS n_bytes FROM orders "
        "UNION ALL SELECT NULL, NULL, 'part-broken.json.gz', 21"
    ),
    "q33_widen_type": (
        "WITH whole AS (SELECT o_orderkey, floor(o_totalprice::DOUBLE) AS price FROM orders), "
        "prices AS (SELECT * FROM whole UNION ALL SELECT o_orderkey, o_totalprice::DOUBLE AS price FROM orders) "
        "SELECT 0 AS version, o_orderkey, price FROM whole UNION ALL SELECT 2 AS version, o_orderkey, "
        "CASE WHEN o_orderkey % 7 = 0 AND price = floor(price) THEN price + 0.5 ELSE price END AS price FROM prices"
    ),
    "q35_append_known_columns": f"SELECT o_orderkey, o_totalprice, year, month FROM {_B} b",
    "q34_export_order": (
        "SELECT o_orderkey, year, month, row_number() OVER (PARTITION BY year, month "
        f"ORDER BY o_orderdate NULLS FIRST, o_orderkey) AS place FROM {_B} b"
    ),
    "q31_bad_lines": (
        "SELECT (SELECT count(*) FROM orders) AS good, "
        f"(SELECT count(*) FROM orders WHERE o_orderpriority = '{URGENT}') AS bad"
    ),
}
