import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from conftest import write_lines, write_records
from strata.sources import (
    MultilineMismatchError,
    id_range,
    unread_files,
    read_json,
    read_parquet,
    rows,
    split_corrupt,
)
from strata.sinks import write_parquet
from strata.sources.json import inferred


def test_two_row_json_and_alphabetical_columns(spark, tmp_path):
    write_records(tmp_path / "in" / "data.json", [{"name": "Alice", "id": 1}, {"name": "Bob", "id": 2}])
    df = read_json(spark, str(tmp_path / "in"))
    assert df.columns == ["id", "name"]
    assert dict(df.dtypes) == {"id": "bigint", "name": "string"}
    assert sorted(tuple(r) for r in df.collect()) == [(1, "Alice"), (2, "Bob")]


def test_recursive_lookup_with_glob_skips_decoys(spark, tmp_path):
    write_records(tmp_path / "in" / "a.jsonl", [{"k": 1}])
    write_records(tmp_path / "in" / "x" / "y" / "b.jsonl", [{"k": 2}, {"k": 3}])
    write_records(tmp_path / "in" / "x" / "decoy.txt", [{"k": 99}])
    df = read_json(spark, str(tmp_path / "in"), glob="*.jsonl")
    assert sorted(r.k for r in df.collect()) == [1, 2, 3]


def test_recursive_lookup_gives_no_directory_partition_column(spark, tmp_path):
    write_records(tmp_path / "in" / "k=7" / "a.json", [{"v": 1}])
    df = read_json(spark, str(tmp_path / "in"))
    assert df.columns == ["v"]


def test_non_recursive_on_nested_dirs_fails(spark, tmp_path):
    write_records(tmp_path / "in" / "sub" / "a.json", [{"v": 1}])
    with pytest.raises(AnalysisException):
        read_json(spark, str(tmp_path / "in"), recursive=False).collect()


def test_empty_directory_fails(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        read_json(spark, str(tmp_path / "empty")).collect()


def test_multiline_object_and_array(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "obj.json").write_text(json.dumps({"a": 1, "b": "x"}, indent=2))
    (tmp_path / "in" / "arr.json").write_text(json.dumps([{"a": 2, "b": "y"}, {"a": 3, "b": "z"}], indent=2))
    df = read_json(spark, str(tmp_path / "in"), multiline=True)
    assert sorted(tuple(r) for r in df.collect()) == [(1, "x"), (2, "y"), (3, "z")]


def test_multiline_on_json_lines_is_refused(spark, tmp_path):
    write_records(tmp_path / "in" / "a.jsonl", [{"a": 1}, {"a": 2}, {"a": 3}])
    with pytest.raises(MultilineMismatchError, match="a.jsonl"):
        read_json(spark, str(tmp_path / "in"), multiline=True)
    # Without the check Spark keeps only the first record of the file.
    unchecked = read_json(spark, str(tmp_path / "in"), multiline=True, check_multiline=False)
    assert unchecked.count() == 1


def test_one_line_array_expands_to_rows(spark, tmp_path):
    write_lines(tmp_path / "in" / "a.json", ['[{"a": 1}, {"a": 2}]'])
    assert read_json(spark, str(tmp_path / "in")).count() == 2


def test_bad_lines_are_kept_as_corrupt_records(spark, tmp_path):
    write_lines(tmp_path / "in" / "a.json", ['{"a": 1}', '{"a": 2', '{"a": 3}', "not json"])
    df = read_json(spark, str(tmp_path / "in")).cache()
    good, bad = split_corrupt(df)
    assert sorted(r.a for r in good.collect()) == [1, 3]
    assert sorted(r[0] for r in bad.collect()) == sorted(['{"a": 2', "not json"])
    df.unpersist()


def test_split_corrupt_without_bad_lines(spark, tmp_path):
    write_records(tmp_path / "in" / "a.json", [{"a": 1}])
    good, bad = split_corrupt(read_json(spark, str(tmp_path / "in")))
    assert good.count() == 1 and bad.count() == 0


def test_conflicting_types_widen(spark, tmp_path):
    write_records(tmp_path / "in" / "a.json", [{"n": 1, "s": 1}])
    write_records(tmp_path / "in" / "b.json", [{"n": 2.5, "s": "x"}])
    df = read_json(spark, str(tmp_path / "in"))
    assert dict(df.dtypes) == {"n": "double", "s": "string"}


def test_given_schema_skips_inference(spark, tmp_path):
    write_records(tmp_path / "in" / "a.json", [{"a": 1, "b": "x"}])
    df = read_json(spark, str(tmp_path / "in"), schema="b string, a int")
    assert df.dtypes == [("b", "string"), ("a", "int")]
    assert df.collect()[0].a == 1


def test_timestamp_text_stays_string_unless_asked(spark, tmp_path):
    write_records(tmp_path / "in" / "a.json", [{"t": "2024-12-25T23:13:15.000"}])
    assert read_json(spark, str(tmp_path / "in")).dtypes == [("t", "string")]
    inferred = read_json(spark, str(tmp_path / "in"), infer_timestamp=True)
    assert inferred.dtypes[0][1].startswith("timestamp")


def test_parquet_round_trip(spark, tmp_path):
    df = rows(spark, [{"id": 1, "x": 1.5}, {"id": 2, "x": None}], "id bigint, x double")
    write_parquet(df, str(tmp_path / "p"))
    back = read_parquet(spark, str(tmp_path / "p"))
    assert sorted(tuple(r) for r in back.collect()) == [(1, 1.5), (2, None)]


def test_inline_rows_sort_dict_keys(spark):
    df = rows(spark, [{"id": 1, "name": "Feature1", "type": "HOLE", "diameter": 10.5}])
    assert df.columns == ["diameter", "id", "name", "type"]
    assert dict(df.dtypes)["id"] == "bigint"


def test_id_range(spark):
    assert [r.id for r in id_range(spark, 5, 10).collect()] == [5, 6, 7, 8, 9]
    assert id_range(spark, 3).schema == T.StructType([T.StructField("id", T.LongType(), False)])


def test_custom_corrupt_column_name(spark, tmp_path):
    write_lines(tmp_path / "in" / "a.json", ['{"a": 1}', "{broken"])
    df = read_json(spark, str(tmp_path / "in"), corrupt_column="raw").cache()
    good, bad = split_corrupt(df, "raw")
    assert [r.a for r in good.collect()] == [1] and [r.raw for r in bad.collect()] == ["{broken"]
    df.unpersist()


def test_unreadable_json_fails_unless_skipped(spark, tmp_path):
    write_records(tmp_path / "in" / "a.json", [{"a": 1}])
    (tmp_path / "in" / "b.json.gz").write_bytes(b"this is not gzip data")
    with pytest.raises(Exception):
        read_json(spark, str(tmp_path / "in")).collect()
    assert read_json(spark, str(tmp_path / "in"), ignore_corrupt_files=True).count() == 1


def test_damaged_parquet_fails_unless_skipped(spark, tmp_path):
    write_parquet(rows(spark, [{"id": 1}], "id bigint"), str(tmp_path / "p"))
    (tmp_path / "p" / "broken.parquet").write_bytes(b"not parquet at all")
    with pytest.raises(Exception):
        read_parquet(spark, str(tmp_path / "p"), schema="id bigint").count()
    assert read_parquet(spark, str(tmp_path / "p"), schema="id bigint", ignore_corrupt_files=True).count() == 1


def test_multiline_reads_documents_with_whole_values_on_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "shape.json").write_text('{"points":\n[\n[[1, 2]],\n[[3, 4]]\n]\n}\n')
    assert read_json(spark, str(tmp_path / "in"), multiline=True).count() == 1
    (tmp_path / "list").mkdir()
    (tmp_path / "list" / "rows.json").write_text('[\n{"a": 1}\n,\n{"a": 2}\n]\n')
    assert read_json(spark, str(tmp_path / "list"), multiline=True).count() == 2
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "row.json").write_text('\n{"a": 1}\n\n')
    assert read_json(spark, str(tmp_path / "one"), multiline=True).count() == 1


def _jobs(spark, run):
    """(result, number of Spark jobs it ran)."""
    group = f"count-{id(run)}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_inferred_from_a_merged_schema():
    seen = "OBJECT<`OBJECT<`: DECIMAL(3,1), `10.0`: DECIMAL(2,0), a: BIGINT, l: ARRAY<VOID>, o: OBJECT<n: VOID, t: BOOLEAN>>"
    assert inferred(seen).simpleString() == "struct<OBJECT<:double,10.0:double,a:bigint,l:array<string>,o:struct<n:string,t:boolean>>"
    assert inferred("ARRAY<OBJECT<a: DOUBLE>>").simpleString() == "struct<a:double>"
    undecided = [None, "VOID", "VARIANT", "STRING", "ARRAY<BIGINT>", "OBJECT<>", "OBJECT<a: VARIANT>", "OBJECT<a: DECIMAL(30,0)>"]
    assert [inferred(s) for s in [*undecided, "OBJECT<a: OBJECT<>>"]] == [None] * 9


@pytest.mark.parametrize(
    "docs",
    [
        [{"b": 1, "a": {"x": [1, 2.5]}, "s": "t"}, {"b": 2.5, "c": None, "s": "u"}],
        [[{"k": 1}, {"k": 2, "flag": True}], [{"k": 3}]],
        [{"k": 1}, [{"k": 2}]],  # shapes that the merged schema does not decide
        [{"v": 1}, {"v": "text"}],
        [{"v": {}}, {"v": {}, "w": 10**25}],
    ],
)
def test_multiline_schema_is_sparks_own(spark, tmp_path, docs):
    (tmp_path / "in").mkdir()
    for i, doc in enumerate(docs):
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps(doc, indent=1))
    own = read_json(spark, str(tmp_path / "in"), multiline=True, check_multiline=False)
    got = read_json(spark, str(tmp_path / "in"), multiline=True)
    assert got.schema == own.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, own.collect()))


def test_multiline_documents_are_read_twice(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps([{"a": i} for i in range(5)], indent=1))
    df, jobs = _jobs(spark, lambda: read_json(spark, str(tmp_path / "in"), multiline=True))
    assert jobs <= 4  # sizes from the listing, and one pass; an aggregate is up to two jobs
    rows, more = _jobs(spark, df.collect)
    assert len(rows) == 5 and more == 1


def test_skipped_files_are_listed(spark, tmp_path):
    write_records(tmp_path / "in" / "a b.json", [{"a": 1}])
    write_records(tmp_path / "in" / "sub" / "c.json", [{"a": 2}])
    (tmp_path / "in" / "empty.json").write_text("")
    (tmp_path / "in" / "broken.json.gz").write_bytes(b"this is not gzip data")
    df = read_json(spark, str(tmp_path / "in"), ignore_corrupt_files=True)
    skipped = unread_files(spark, str(tmp_path / "in"), df).collect()
    assert [(r.path.rsplit("/", 1)[1], r.length) for r in skipped] == [("broken.json.gz", 21)]
    assert unread_files(spark, str(tmp_path / "in"), df, glob="*.json").count() == 0
