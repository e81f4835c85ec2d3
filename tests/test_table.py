import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.plans import partition_filters
from strata.sources import id_range, rows
from strata.table import (
    CorruptCommitError,
    SchemaMismatchError,
    TableConflictError,
    TableExistsError,
    VersionedTable,
    delete_from_table,
    read_table,
    table_commit,
    table_exists,
    table_version,
    update_table,
    write_table,
)
from strata.table.fs import HadoopFS
from strata.table.log import Commit, commit_name, write_commit


def ids(df):
    return sorted(r.id for r in df.collect())


def test_range_lifecycle_goldens(spark, tmp_uri):
    path = tmp_uri("t")
    write_table(id_range(spark, 0, 5), path, mode="errorifexists")
    assert ids(read_table(spark, path)) == [0, 1, 2, 3, 4]
    write_table(id_range(spark, 5, 10), path, mode="overwrite")
    assert ids(read_table(spark, path)) == [5, 6, 7, 8, 9]
    table = VersionedTable.for_path(spark, path)
    table.update(F.expr("id % 2 == 0"), {"id": F.expr("id + 100")})
    assert ids(table.to_df()) == [5, 7, 9, 106, 108]
    table.delete(F.expr("id % 2 == 0"))
    assert ids(table.to_df()) == [5, 7, 9]
    assert table.version() == 3
    assert ids(table.to_df(0)) == [0, 1, 2, 3, 4]
    assert ids(table.to_df(2)) == [5, 7, 9, 106, 108]


def test_feature_rows_append_by_name_and_time_travel(spark, tmp_uri):
    path = tmp_uri("features")
    v0 = rows(
        spark,
        [
            {"id": 1, "name": "Feature1", "type": "HOLE", "diameter": 10.5},
            {"id": 2, "name": "Feature2", "type": "POCKET", "diameter": 20.0},
            {"id": 3, "name": "Feature3", "type": "SLOT", "diameter": 15.2},
        ],
    ).withColumn("description", F.lit("CAD Feature")).withColumn("diameter_inch", F.col("diameter") / 25.4)
    write_table(v0, path)
    more = rows(
        spark,
        [
            {"id": 4, "name": "Feature4", "type": "COUNTERBORE", "diameter": 25.4, "description": "CAD Feature", "diameter_inch": 1.0},
            {"id": 5, "name": "Feature5", "type": "CHAMFER", "diameter": 12.7, "description": "CAD Feature", "diameter_inch": 0.5},
        ],
    )
    assert more.columns != v0.columns
    commit = write_table(more, path, mode="append")
    assert commit.version == 1 and commit.metrics["rows_written"] == 2
    latest = read_table(spark, path)
    assert latest.columns == v0.columns
    assert latest.count() == 5
    assert read_table(spark, path, version_as_of=0).count() == 3
    got = {r.id: (r.type, r.diameter_inch) for r in latest.collect()}
    assert got[4] == ("COUNTERBORE", 1.0) and got[1] == ("HOLE", 10.5 / 25.4)


def test_one_column_append(spark, tmp_uri):
    path = tmp_uri("data")
    write_table(spark.range(0, 5).withColumnRenamed("id", "data"), path)
    write_table(spark.range(6, 11).withColumnRenamed("id", "data"), path, mode="append")
    got = sorted(r.data for r in read_table(spark, path).collect())
    assert got == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10]


def test_save_modes_on_existing_table(spark, tmp_uri):
    path = tmp_uri("modes")
    assert not table_exists(spark, path)
    write_table(spark.range(3), path, mode="error")
    assert table_exists(spark, path)
    with pytest.raises(TableExistsError):
        write_table(spark.range(3), path, mode="errorifexists")
    assert write_table(spark.range(10, 20), path, mode="ignore") is None
    assert ids(read_table(spark, path)) == [0, 1, 2]
    assert table_version(spark, path) == 0
    with pytest.raises(ValueError, match="unknown save mode"):
        write_table(spark.range(3), path, mode="upsert")


def test_ignore_and_errorifexists_create_missing_table(spark, tmp_uri):
    a, b = tmp_uri("a"), tmp_uri("b")
    assert write_table(spark.range(2), a, mode="ignore").version == 0
    assert write_table(spark.range(2), b, mode="errorifexists").version == 0


def test_extra_column_needs_merge_schema(spark, tmp_uri):
    path = tmp_uri("merge")
    write_table(spark.createDataFrame([(1, "a")], "k long, name string"), path)
    wider = spark.createDataFrame([(2, "b", 7)], "k long, name string, extra int")
    with pytest.raises(SchemaMismatchError, match="merge_schema"):
        write_table(wider, path, mode="append")
    write_table(wider, path, mode="append", merge_schema=True)
    got = sorted(tuple(r) for r in read_table(spark, path).collect())
    assert got == [(1, "a", None), (2, "b", 7)]
    assert read_table(spark, path).columns == ["k", "name", "extra"]
    assert read_table(spark, path, version_as_of=0).columns == ["k", "name"]


def test_missing_column_becomes_null(spark, tmp_uri):
    path = tmp_uri("missing")
    write_table(spark.createDataFrame([(1, "a")], "k long, name string"), path)
    write_table(spark.createDataFrame([(2,)], "k long"), path, mode="append")
    assert sorted((tuple(r) for r in read_table(spark, path).collect()), key=str) == [(1, "a"), (2, None)]


def test_type_change_is_refused_but_widening_is_cast(spark, tmp_uri):
    path = tmp_uri("types")
    write_table(spark.createDataFrame([(1,)], "k long"), path)
    with pytest.raises(SchemaMismatchError, match="type"):
        write_table(spark.createDataFrame([("x",)], "k string"), path, mode="append")
    write_table(spark.createDataFrame([(2,)], "k int"), path, mode="append")
    df = read_table(spark, path)
    assert df.dtypes == [("k", "bigint")] and sorted(r.k for r in df.collect()) == [1, 2]


def test_partition_rules(spark, tmp_uri):
    path = tmp_uri("parts")
    df = spark.createDataFrame([(1, 2024, 12), (2, 2025, 6)], "id long, year long, month long")
    with pytest.raises(SchemaMismatchError, match="not in the data"):
        write_table(df, tmp_uri("nopart"), partition_by=["day"])
    with pytest.raises(SchemaMismatchError, match="all columns"):
        write_table(df.select("year", "month"), tmp_uri("allpart"), partition_by=["year", "month"])
    write_table(df, path, partition_by=["year", "month"])
    with pytest.raises(SchemaMismatchError, match="partition columns"):
        write_table(df, path, mode="append", partition_by=["year"])
    write_table(df, path, mode="append")  # keeps the table's partitioning
    assert table_commit(spark, path).partition_by == ["year", "month"]
    assert read_table(spark, path).count() == 4


def test_partition_types_survive_and_prune(spark, tmp_uri):
    path = tmp_uri("pruned")
    df = spark.createDataFrame(
        [(1, 2024, 12), (2, 2025, 6), (3, 2025, 6), (4, 2025, 8)], "id long, year long, month long"
    )
    write_table(df, path, partition_by=["year", "month"])
    table = read_table(spark, path)
    assert table.dtypes == [("id", "bigint"), ("year", "bigint"), ("month", "bigint")]
    pruned = table.where((F.col("year") == 2025) & (F.col("month") == 6))
    filters = " ".join(partition_filters(pruned))
    assert "year" in filters and "month" in filters
    assert ids(pruned) == [2, 3]


def test_null_partition_value_round_trip(spark, tmp_uri):
    path = tmp_uri("nullpart")
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, p string")
    write_table(df, path, partition_by=["p"])
    assert sorted((tuple(r) for r in read_table(spark, path).collect()), key=str) == [(1, "a"), (2, None)]


def test_overwrite_schema(spark, tmp_uri):
    path = tmp_uri("ows")
    write_table(spark.createDataFrame([(1, "x")], "k long, p string"), path, partition_by=["p"])
    other = spark.createDataFrame([("a", 1.5)], "name string, score double")
    with pytest.raises(SchemaMismatchError):
        write_table(other, path, mode="overwrite")
    with pytest.raises(ValueError, match="only allowed"):
        write_table(other, path, mode="append", overwrite_schema=True)
    write_table(other, path, mode="overwrite", overwrite_schema=True)
    commit = table_commit(spark, path)
    assert commit.partition_by == [] and commit.schema.names == ["name", "score"]
    assert [tuple(r) for r in read_table(spark, path).collect()] == [("a", 1.5)]
    assert read_table(spark, path, version_as_of=0).columns == ["k", "p"]


def test_overwrite_can_add_columns_with_merge_schema(spark, tmp_uri):
    path = tmp_uri("owm")
    write_table(spark.createDataFrame([(1,)], "k long"), path)
    write_table(spark.createDataFrame([(2, "x")], "k long, v string"), path, mode="overwrite", merge_schema=True)
    assert [tuple(r) for r in read_table(spark, path).collect()] == [(2, "x")]


def test_empty_write_and_delete_everything(spark, tmp_uri):
    path = tmp_uri("empty")
    write_table(spark.range(0), path)
    assert read_table(spark, path).count() == 0
    write_table(spark.range(4), path, mode="append")
    delete_from_table(spark, path)
    assert read_table(spark, path).count() == 0
    assert read_table(spark, path).columns == ["id"]

    part = tmp_uri("empty-part")
    write_table(spark.createDataFrame([(1, 1)], "id long, p long"), part, partition_by=["p"])
    delete_from_table(spark, part, "p = 1")
    assert read_table(spark, part).count() == 0


def test_update_and_delete_with_nulls(spark, tmp_uri):
    path = tmp_uri("nulls")
    data = [(1, 10), (2, None), (3, 30), (4, 40), (None, 50)]
    write_table(spark.createDataFrame(data, "k long, v long"), path)
    before = read_table(spark, path).count()
    update_table(spark, path, "v > 20", {"v": "v * 10"})
    after = {(r.k, r.v) for r in read_table(spark, path).collect()}
    assert read_table(spark, path).count() == before
    assert after == {(1, 10), (2, None), (3, 300), (4, 400), (None, 500)}
    cond = "k % 2 = 0"
    matching = read_table(spark, path).where(cond).count()
    delete_from_table(spark, path, cond)
    remaining = read_table(spark, path)
    assert remaining.count() + matching == before
    assert {r.k for r in remaining.collect()} == {1, 3, None}


def test_update_sees_old_values_and_casts(spark, tmp_uri):
    path = tmp_uri("swap")
    write_table(spark.createDataFrame([(1, 2, 1.0)], "a long, b long, x double"), path)
    update_table(spark, path, None, {"a": F.col("b"), "b": F.col("a"), "x": 3})
    row = read_table(spark, path).collect()[0]
    assert (row.a, row.b, row.x) == (2, 1, 3.0)
    with pytest.raises(SchemaMismatchError):
        update_table(spark, path, None, {"nope": 1})
    with pytest.raises(ValueError, match="at least one column"):
        update_table(spark, path, "a = 2", {})


def test_update_can_move_rows_between_partitions(spark, tmp_uri):
    path = tmp_uri("move")
    write_table(spark.createDataFrame([(1, "a"), (2, "b")], "id long, p string"), path, partition_by=["p"])
    update_table(spark, path, "id = 1", {"p": "'b'"})
    out = read_table(spark, path)
    assert sorted(tuple(r) for r in out.where("p = 'b'").collect()) == [(1, "b"), (2, "b")]


def test_missing_version_and_table(spark, tmp_uri):
    path = tmp_uri("tt")
    with pytest.raises(ValueError, match="no table"):
        read_table(spark, path)
    with pytest.raises(ValueError, match="no table"):
        VersionedTable.for_path(spark, path)
    write_table(spark.range(1), path)
    with pytest.raises(ValueError, match="no version 5"):
        read_table(spark, path, version_as_of=5)


def test_failed_write_leaves_no_version(spark, tmp_uri):
    path = tmp_uri("failed")
    write_table(spark.range(3), path)
    bad = spark.range(3).select((F.col("id") / F.lit(0)).cast("long").alias("id"))
    with pytest.raises(Exception):
        write_table(bad, path, mode="append")
    assert table_version(spark, path) == 0
    assert ids(read_table(spark, path)) == [0, 1, 2]


def test_timestamps_round_trip(spark, tmp_uri):
    path = tmp_uri("ts")
    df = spark.createDataFrame([(1, dt.datetime(2025, 6, 30, 23, 54, 44))], "id long, t timestamp_ntz")
    write_table(df, path)
    assert read_table(spark, path).collect()[0].t == dt.datetime(2025, 6, 30, 23, 54, 44)


def test_dml_with_special_characters_in_partition_values(spark, tmp_uri):
    path = tmp_uri("special dir")
    values = ["a b%c", "x+y", "q/r", "t:u", None]
    df = spark.range(0, 50).select(
        F.col("id"),
        F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("id") % 5 + 1).cast("int")).alias("p"),
    )
    write_table(df, path, partition_by=["p"])
    assert read_table(spark, path).where("p = 'a b%c'").count() == 10
    update_table(spark, path, "p = 'x+y' AND id < 20", {"id": "id + 1000"})
    delete_from_table(spark, path, "p = 'q/r' AND id > 30")
    delete_from_table(spark, path, "p IS NULL")
    out = read_table(spark, path)
    assert out.count() == 50 - 4 - 10
    assert out.where("id >= 1000").count() == 4
    assert sorted(r.p for r in out.select("p").distinct().collect()) == ["a b%c", "q/r", "t:u", "x+y"]


def test_delta_format_needs_delta(spark, tmp_uri):
    from strata.session import delta_available

    if delta_available(spark):
        pytest.skip("Delta Lake is installed here")
    path = tmp_uri("delta")
    for call in (
        lambda: write_table(spark.range(1), path, format="delta"),
        lambda: read_table(spark, path, format="delta"),
        lambda: update_table(spark, path, "id = 0", {"id": 1}, format="delta"),
        lambda: delete_from_table(spark, path, "id = 0", format="delta"),
    ):
        with pytest.raises(RuntimeError, match="Delta Lake"):
            call()
    with pytest.raises(ValueError, match="unsupported table format"):
        write_table(spark.range(1), path, format="orc")


def test_hot_partition_value_is_split_over_several_writers(spark, tmp_path):
    import os

    path = "file://" + str(tmp_path / "skew")
    n = 300_000
    df = spark.range(0, n, 1, 8).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("p"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(1 << 20))
    try:
        commit = write_table(df, path, partition_by=["p"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = commit.parts[0] + "/p=0"
    hot_dir = os.path.join(str(tmp_path / "skew"), hot)
    hot_files = [f for f in os.listdir(hot_dir) if f.endswith(".parquet")]
    assert len(hot_files) > 1  # the value holding a third of the rows is not one task's job
    assert read_table(spark, path).count() == n
    assert read_table(spark, path).where("p = 0").count() == n // 3


def test_single_partition_column_as_text(spark, tmp_uri):
    path = tmp_uri("single")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, p string")
    assert write_table(df, path, partition_by="p").partition_by == ["p"]
    assert read_table(spark, path).where("p = 'b'").count() == 1


def test_commit_conflict_and_corrupt_commit(spark, tmp_uri):
    path = tmp_uri("conflict")
    write_table(spark.range(1), path)
    fs = HadoopFS(spark, path)
    current = table_commit(spark, path)
    with pytest.raises(TableConflictError):
        write_commit(fs, Commit(0, "WRITE", current.schema, [], []))
    assert fs.list_names("commits") == [commit_name(0).split("/")[1]]
    assert fs.create_exclusive(commit_name(1), "{not json")
    with pytest.raises(CorruptCommitError):
        read_table(spark, path)


def test_a_second_writer_fails_and_leaves_the_first_version(spark, tmp_uri, monkeypatch):
    import strata.table.versioned as versioned

    path = tmp_uri("race")
    write_table(spark.range(0, 20), path)
    real, raced = versioned.write_commit, []

    def racing(fs, commit):
        if not raced:
            raced.append(True)
            write_table(spark.range(500, 505), path, mode="overwrite")
        return real(fs, commit)

    monkeypatch.setattr(versioned, "write_commit", racing)
    with pytest.raises(TableConflictError):
        delete_from_table(spark, path, "id < 5")
    assert ids(read_table(spark, path)) == [500, 501, 502, 503, 504]


def test_updates_rewrite_touched_leaves_only(spark, tmp_uri):
    path = tmp_uri("leaves")
    df = spark.range(0, 40).select(F.col("id"), (F.col("id") % 4).alias("p"))
    first = write_table(df, path, partition_by=["p"])
    assert len(first.parts) == 1  # one directory, no leaves
    second = write_table(df, path, mode="append")
    assert second.parts[0] == first.parts[0] and len(second.parts) == 2
    third = update_table(spark, path, "p = 1 AND id > 20", {"id": "id + 1000"})
    # either directory without one leaf, and the new directory
    assert third.parts[:2] == second.parts and len(third.parts) == 3 and third.metrics["leaves_rewritten"] == 2
    assert {k: len(v) for k, v in third.dropped.items()} == dict.fromkeys(second.parts, 1)
    got = ids(read_table(spark, path))
    assert len(got) == 80 and got.count(1021) == 2 and 21 not in got
    fourth = delete_from_table(spark, path, F.col("p") == 2)
    assert fourth.metrics["rows_written"] == 0 and fourth.metrics["leaves_dropped"] == 2
    assert read_table(spark, path).where("p = 2").count() == 0 and read_table(spark, path).count() == 60
    assert update_table(spark, path, "id < 0", {"id": 0}) is None and table_version(spark, path) == 3
    assert ids(read_table(spark, path, version_as_of=1)).count(21) == 2


def test_unpartitioned_rewrite_touches_only_writes_that_match(spark, tmp_uri):
    path = tmp_uri("writes")
    write_table(spark.range(0, 200), path)
    wider = spark.range(200, 210).select("id", F.lit("new").alias("tag"))
    write_table(wider, path, mode="append", merge_schema=True)
    commit = update_table(spark, path, "tag IS NULL AND id < 5", {"tag": "'old'"})
    assert commit.metrics["leaves_rewritten"] == 1 and len(commit.parts) == 2
    df = read_table(spark, path)
    assert df.count() == 210 and df.where("tag = 'old'").count() == 5
    assert df.where("tag IS NULL").count() == 195
    assert delete_from_table(spark, path).parts == []
    assert update_table(spark, path, "id = 1", {"id": 2}) is None
    assert read_table(spark, path).count() == 0


def test_moving_rows_to_many_partitions_writes_few_files(spark, tmp_uri):
    path = tmp_uri("spread")
    df = spark.range(0, 4000, 1, 8).select(F.col("id"), F.lit(0).cast("long").alias("p"))
    write_table(df, path, partition_by=["p"], rebalance=False)
    update_table(spark, path, None, {"p": "id % 50"})
    assert len(read_table(spark, path).inputFiles()) <= 60


def test_nested_schemas_merge_by_name(spark, tmp_uri):
    path = tmp_uri("nested")
    write_table(spark.createDataFrame([(1, (7,), [(1,)])], "k long, s struct<a:int>, xs array<struct<a:int>>"), path)
    wide = spark.createDataFrame(
        [(2, ("x", 8), [("y", 9)]), (3, None, None)], "k long, s struct<b:string,a:int>, xs array<struct<b:string,a:int>>"
    )
    with pytest.raises(SchemaMismatchError, match="merge_schema"):
        write_table(wide, path, mode="append")
    write_table(wide, path, mode="append", merge_schema=True)
    got = {r.k: r for r in read_table(spark, path).collect()}
    assert (got[1].s.a, got[1].s.b) == (7, None) and (got[2].s.a, got[2].s.b) == (8, "x")
    assert got[3].s is None and got[3].xs is None
    assert (got[1].xs[0].a, got[2].xs[0].a, got[2].xs[0].b) == (1, 9, "y")


def test_nested_nullability_and_whole_number_batches_fit(spark, tmp_uri):
    path = tmp_uri("fits")
    write_table(spark.createDataFrame([(1.5, ["a"])], "fare double, tags array<string>"), path)
    strict = spark.range(2).select(F.col("id").alias("fare"), F.array(F.lit("b")).alias("tags"))
    assert not strict.schema["tags"].dataType.containsNull
    write_table(strict, path, mode="append")
    assert sorted(r.fare for r in read_table(spark, path).collect()) == [0.0, 1.0, 1.5]


def _data_files(tmp_path, commit):
    from pathlib import Path

    return [f for p in commit.parts for f in Path(tmp_path / "t", p).rglob("*.parquet")]


def test_conditions_on_partitions_read_no_row(spark, tmp_path):
    path = "file://" + str(tmp_path / "t")
    df = spark.range(0, 60).select("id", (F.col("id") % 3).alias("y"), F.concat(F.lit("m="), F.col("id") % 2).alias("m"))
    write_table(df, path, partition_by=["y", "m"])
    commit = write_table(df, path, mode="append")
    files = _data_files(tmp_path, commit)
    kept = {f: f.read_bytes() for f in files}
    for f in files:
        f.write_bytes(b"not parquet")
    assert delete_from_table(spark, path, "y = 7") is None
    one = delete_from_table(spark, path, "y = 1 AND m = 'm=0'")
    assert one.parts == commit.parts and one.metrics == {"rows_written": 0, "leaves_rewritten": 0, "leaves_dropped": 2}
    two = delete_from_table(spark, path, F.col("y").isin(0, 1))
    assert {k: len(v) for k, v in two.dropped.items()} == dict.fromkeys(commit.parts, 4)
    three = delete_from_table(spark, path, "y > 0 OR m IS NULL")
    assert three.parts == [] and read_table(spark, path).count() == 0
    for f, content in kept.items():
        f.write_bytes(content)
    assert sorted(ids(read_table(spark, path, version_as_of=3))) == sorted(2 * [i for i in range(60) if i % 3 == 2])
    assert sorted(ids(read_table(spark, path, version_as_of=2))) == sorted(2 * [i for i in range(60) if not (i % 3 == 1 and i % 2 == 0)])


def test_an_update_by_partition_scans_its_leaves_once(spark, tmp_path):
    path = "file://" + str(tmp_path / "t")
    commit = write_table(spark.range(0, 40).select("id", (F.col("id") % 4).alias("p")), path, partition_by=["p"])
    for f in _data_files(tmp_path, commit):
        if "p=1" not in str(f):
            f.write_bytes(b"not parquet")
    new = update_table(spark, path, "p = 1", {"id": "id + 1000"})
    assert new.metrics["leaves_rewritten"] == 1 and new.metrics["rows_written"] in (10, None)
    assert ids(read_table(spark, path).where("p = 1")) == [1000 + i for i in range(1, 40, 4)]


def test_deletes_drop_leaves_that_match_wholly(spark, tmp_uri):
    path = tmp_uri("whole")
    write_table(spark.range(0, 40).select("id", (F.col("id") % 4).alias("p")), path, partition_by=["p"])
    commit = delete_from_table(spark, path, "p = 1 AND id >= 0 OR p = 2 AND id > 20")
    assert commit.metrics["leaves_dropped"] == 1 and commit.metrics["leaves_rewritten"] == 1
    assert commit.metrics["rows_written"] in (5, None)
    assert ids(read_table(spark, path)) == [i for i in range(40) if not (i % 4 == 1 or (i % 4 == 2 and i > 20))]
    commit = delete_from_table(spark, path, "id >= 0")
    assert commit.parts == [] and read_table(spark, path).count() == 0


def test_conditions_that_change_between_scans_are_refused(spark, tmp_uri):
    path = tmp_uri("frozen")
    write_table(spark.range(10).select("id", F.current_timestamp().alias("t")), path)
    for condition in ("rand() < 0.5", F.rand() > 0.1, "id > 3 AND uuid() > 'a'"):
        with pytest.raises(ValueError, match="deterministic"):
            delete_from_table(spark, path, condition)
    for condition in ("t < current_timestamp()", "t < current_date", "t < now()", F.col("t") < F.current_timestamp()):
        with pytest.raises(ValueError, match="clock"):
            update_table(spark, path, condition, {"id": 0})
    assert table_version(spark, path) == 0
    update_table(spark, path, "id < 5", {"id": "cast(rand() * 0 as long)"})  # a value may be anything
    assert ids(read_table(spark, path)) == [0] * 5 + [5, 6, 7, 8, 9]


def test_many_appends_are_one_scan(spark, tmp_uri):
    path = tmp_uri("appends")
    for i in range(40):
        write_table(spark.range(i, i + 1).select("id", (F.col("id") % 2).alias("p")), path, mode="append", partition_by=["p"])
    df = read_table(spark, path)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "InMemoryFileIndex(1 paths)" in plan
    assert ids(df) == list(range(40))
    pruned = df.where("p = 1")
    assert "p" in " ".join(partition_filters(pruned)) and len(pruned.inputFiles()) <= 40
    assert ids(pruned) == list(range(1, 40, 2))
    assert ids(read_table(spark, path, version_as_of=10)) == list(range(11))


def test_failed_and_replaced_writes_are_not_read(spark, tmp_uri):
    path = tmp_uri("stray")
    write_table(spark.range(5), path)
    commit = write_table(spark.range(5, 8), path, mode="append")
    spark.range(100).write.parquet(f"{path}/{commit.generation}/strata_commit=stray")  # a job that never committed
    assert ids(read_table(spark, path)) == list(range(8))
    new = write_table(spark.range(3), path, mode="overwrite")
    assert new.generation != commit.generation and ids(read_table(spark, path)) == [0, 1, 2]
    with pytest.raises(SchemaMismatchError, match="strata_commit"):
        write_table(spark.range(3).withColumn("strata_commit", F.lit("x")), tmp_uri("name"))


def test_stored_types_widen_and_time_travel_keeps_them(spark, tmp_uri):
    path = tmp_uri("widen")
    first = spark.createDataFrame([(1, 5, (1,), [7], "a")], "id int, fare long, s struct<n:int>, xs array<int>, p string")
    write_table(first, path, partition_by=["p"])
    wider = spark.createDataFrame(
        [(2**40, 5.25, (2**40, 0.5), [2**40], "b")], "id long, fare double, s struct<n:long,m:double>, xs array<long>, p string"
    )
    with pytest.raises(SchemaMismatchError, match="widen"):
        write_table(wider, path, mode="append")
    write_table(wider, path, mode="append", merge_schema=True)
    types = dict(read_table(spark, path).dtypes)
    assert types == {"id": "bigint", "fare": "double", "s": "struct<n:bigint,m:double>", "xs": "array<bigint>", "p": "string"}
    got = {r.p: r for r in read_table(spark, path).collect()}
    assert (got["a"].id, got["a"].fare, tuple(got["a"].s), got["a"].xs) == (1, 5.0, (1, None), [7])
    assert (got["b"].id, got["b"].fare, tuple(got["b"].s), got["b"].xs) == (2**40, 5.25, (2**40, 0.5), [2**40])
    old = read_table(spark, path, version_as_of=0)
    assert dict(old.dtypes)["fare"] == "bigint" and old.first().fare == 5
    write_table(first, path, mode="append")  # narrower batches are cast as before
    update_table(spark, path, "fare = 5", {"fare": "fare + 0.5"})
    assert sorted(r.fare for r in read_table(spark, path).collect()) == [5.25, 5.5, 5.5]
    assert sorted(r.fare for r in read_table(spark, path, version_as_of=2).collect()) == [5.0, 5.0, 5.25]
    delete_from_table(spark, path, "p = 'b'")
    assert sorted(r.fare for r in read_table(spark, path).collect()) == [5.5, 5.5]


def test_widening_twice_and_columns_added_between(spark, tmp_uri):
    path = tmp_uri("twice")
    write_table(spark.createDataFrame([(1,)], "v int"), path)
    write_table(spark.createDataFrame([(2, "x")], "v int, w string"), path, mode="append", merge_schema=True)
    write_table(spark.createDataFrame([(3,)], "v long"), path, mode="append", merge_schema=True)
    write_table(spark.createDataFrame([(4.5,)], "v double"), path, mode="append", merge_schema=True)
    assert sorted((r.v, r.w) for r in read_table(spark, path).collect() if r.w is None) == [(1.0, None), (3.0, None), (4.5, None)]
    assert [r.w for r in read_table(spark, path).where("v = 2").collect()] == ["x"]
    assert [dict(read_table(spark, path, version_as_of=i).dtypes)["v"] for i in range(4)] == ["int", "int", "bigint", "double"]
    part = tmp_uri("part")
    write_table(spark.createDataFrame([(1, 1)], "k int, p int"), part, partition_by=["p"])
    write_table(spark.createDataFrame([(2, 2)], "k int, p long"), part, mode="append", merge_schema=True)
    delete_from_table(spark, part, "p = 1")
    assert [tuple(r) for r in read_table(spark, part).collect()] == [(2, 2)]
    with pytest.raises(SchemaMismatchError, match="partition column"):
        write_table(spark.createDataFrame([(2, 2.5)], "k int, p double"), part, mode="append", merge_schema=True)


def test_tables_on_a_file_system_that_is_not_local(spark, tmp_path):
    """A mount table: its paths have another scheme, and no local path reaches them."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.lake.link./tables", f"file://{tmp_path}")
    path = "viewfs://lake/tables/trips"
    write_table(spark.range(40).select("id", (F.col("id") % 4).alias("p")), path, partition_by=["p"], mode="errorifexists")
    write_table(spark.range(40, 44).select("id", F.lit(9).cast("long").alias("p")), path, mode="append")
    with pytest.raises(TableExistsError):
        write_table(spark.range(1), path, mode="errorifexists")
    handle = VersionedTable.for_path(spark, path)
    handle.update("p = 1 AND id > 20", {"id": "id + 1000"})
    handle.delete("p = 2")
    handle.delete("id % 2 = 0 AND p = 0")
    want = [i + 1000 if i > 20 else i for i in range(1, 40, 4)] + [i for i in range(40) if i % 4 == 3] + list(range(40, 44))
    assert ids(handle.to_df()) == sorted(want) and handle.version() == 4
    assert handle.to_df(0).count() == 40
    fs = HadoopFS(spark, path)
    assert not fs.create_exclusive(commit_name(0), "{}") and fs.root == path
