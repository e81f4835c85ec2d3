import json

import pytest

from pyspark.sql.types import StructType

from conftest import write_lines
from strata.functions import rename_columns
from strata.job import main, parse_args
from strata.operators import ingest_json
from strata.table import SchemaMismatchError, read_table, table_commit


def trip_record(i, year, month, day, hour=10):
    return {
        "VendorID": 2,
        "lpep_pickup_datetime": f"{year:04d}-{month:02d}-{day:02d}T{hour:02d}:00:00.000",
        "lpep_dropoff_datetime": f"{year:04d}-{month:02d}-{day:02d}T{hour:02d}:20:00.000",
        "store_and_fwd_flag": "N",
        "RatecodeID": 1,
        "PULocationID": 100 + i,
        "DOLocationID": 200 + i,
        "passenger_count": 1,
        "trip_distance": 1.5 + i,
        "fare_amount": 10.0,
        "total_amount": 12.5,
        "payment_type": 1,
        "trip_type": 1,
        "year": year,
        "month": month,
    }


@pytest.fixture
def trip_dir(tmp_path):
    root = tmp_path / "input" / "json"
    files = {"2024-12.jsonl": (2024, 12, 6), "2025-06.jsonl": (2025, 6, 11), "2025-08.jsonl": (2025, 8, 3)}
    i = 0
    for name, (year, month, n) in files.items():
        lines = []
        for d in range(n):
            lines.append(json.dumps(trip_record(i, year, month, d + 1)))
            i += 1
        write_lines(root / name, lines)
    return root


def test_ingest_json_partitioned(spark, trip_dir, tmp_uri):
    out = tmp_uri("table")
    result = ingest_json(spark, str(trip_dir), out, partition_by=["year", "month"])
    assert result.commit.version == 0 and result.rows_written == 20
    table = result.table()
    counts = {(r.year, r.month): r["count"] for r in table.groupBy("year", "month").count().collect()}
    assert counts == {(2024, 12): 6, (2025, 6): 11, (2025, 8): 3}
    assert dict(table.dtypes)["year"] == "bigint"
    renamed = rename_columns(
        table,
        {"DOLocationID": "do_location_id", "PULocationID": "pu_location_id", "RatecodeID": "rate_code_id", "VendorID": "vendor_id"},
    )
    assert {"vendor_id", "rate_code_id", "pu_location_id", "do_location_id"} <= set(renamed.columns)
    assert table_commit(spark, out).partition_by == ["year", "month"]


def test_ingest_two_row_round_trip(spark, tmp_path, tmp_uri):
    write_lines(tmp_path / "json" / "data.json", [json.dumps({"id": 1, "name": "Alice"}), json.dumps({"id": 2, "name": "Bob"})])
    result = ingest_json(spark, str(tmp_path / "json"), tmp_uri("parquet"))
    assert result.source.count() == 2
    assert result.table().count() == 2


def test_ingest_repartition_and_modes(spark, trip_dir, tmp_uri):
    out = tmp_uri("t")
    ingest_json(spark, str(trip_dir), out, repartition=4, partition_by=["year", "month"])
    again = ingest_json(spark, str(trip_dir), out, mode="append")
    assert again.commit.version == 1 and again.table().count() == 40
    assert ingest_json(spark, str(trip_dir), out, mode="ignore").commit is None
    assert ingest_json(spark, str(trip_dir), out, mode="ignore").rows_written is None


def test_ingest_with_timestamp_column_needs_merge(spark, trip_dir, tmp_uri):
    out = tmp_uri("ts")
    ingest_json(spark, str(trip_dir), out)
    with pytest.raises(SchemaMismatchError):
        ingest_json(spark, str(trip_dir), out, mode="append", ingest_timestamp="ingestion_ts")
    ingest_json(spark, str(trip_dir), out, mode="append", ingest_timestamp="ingestion_ts", merge_schema=True)
    table = read_table(spark, out)
    assert table.where("ingestion_ts IS NULL").count() == 20
    assert table.where("ingestion_ts IS NOT NULL").count() == 20


def test_parse_args_defaults():
    args = parse_args([])
    assert args.partition_by == ["year", "month"] and args.mode == "overwrite"
    assert parse_args(["--partition-by"]).partition_by == []
    with pytest.raises(SystemExit):
        parse_args(["--mode", "merge"])


def test_job_main(spark, trip_dir, tmp_uri):
    out = tmp_uri("job")
    assert main(["--input", str(trip_dir), "--output", out, "--repartition", "2"]) == 0
    assert read_table(spark, out).count() == 20
    assert main(["--input", str(trip_dir), "--output", out, "--mode", "append", "--partition-by"]) == 0
    assert read_table(spark, out).count() == 40


def test_job_without_rebalance(spark, trip_dir, tmp_uri):
    out = tmp_uri("norebalance")
    assert main(["--input", str(trip_dir), "--output", out, "--no-rebalance"]) == 0
    assert read_table(spark, out).count() == 20


def test_job_with_given_schema(spark, trip_dir, tmp_uri):
    out = tmp_uri("schema")
    ddl = "VendorID long, trip_distance double, year long, month long"
    assert main(["--input", str(trip_dir), "--output", out, "--schema", ddl]) == 0
    table = read_table(spark, out)
    assert table.columns == ["VendorID", "trip_distance", "year", "month"]
    assert table.count() == 20


def test_job_multiline_and_non_recursive(spark, tmp_path, tmp_uri):
    flat = tmp_path / "flat"
    flat.mkdir()
    docs = [trip_record(i, 2025, 6, i + 1) for i in range(4)]
    (flat / "a.json").write_text(json.dumps(docs[:3], indent=2))
    (flat / "b.json").write_text(json.dumps(docs[3], indent=2))
    out = tmp_uri("ml")
    assert main(["--input", str(flat), "--output", out, "--multiline", "--no-recursive"]) == 0
    assert read_table(spark, out).count() == 4
    (flat / "sub").mkdir()
    write_lines(flat / "sub" / "c.jsonl", [json.dumps(trip_record(9, 2025, 8, 1))])
    out2 = tmp_uri("glob")
    assert main(["--input", str(flat), "--output", out2, "--glob", "*.jsonl"]) == 0
    assert read_table(spark, out2).count() == 1


def test_job_missing_partition_column_fails(spark, tmp_path, tmp_uri):
    write_lines(tmp_path / "j" / "a.json", [json.dumps({"id": 1})])
    with pytest.raises(SchemaMismatchError):
        main(["--input", str(tmp_path / "j"), "--output", tmp_uri("x")])


def test_entry_contract(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["o_orderkey", "o_totalprice", "o_orderdate", "year", "month"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(name in entry.oracle_sql() for name in entry.queries() if name.startswith("q"))


def test_cut_off_input_leaves_no_version(spark, tmp_path, tmp_uri):
    import gzip

    import pytest

    from strata import ingest_json, table_exists

    (tmp_path / "in").mkdir()
    lines = "".join('{"a": %d, "pad": "%s"}\n' % (i, i * 7919) for i in range(20_000)).encode()
    whole = gzip.compress(lines)
    (tmp_path / "in" / "a.json.gz").write_bytes(whole)
    (tmp_path / "in" / "b.json.gz").write_bytes(whole[: len(whole) // 2])
    out = tmp_uri("cut")
    with pytest.raises(Exception):
        ingest_json(spark, str(tmp_path / "in"), out)
    assert not table_exists(spark, out)
    ingest_json(spark, str(tmp_path / "in"), out, ignore_corrupt_files=True)
    assert table_exists(spark, out)


def test_ignore_on_an_existing_table_runs_no_job(spark, tmp_path, tmp_uri):
    from strata import ingest_json, write_table

    out = tmp_uri("there")
    write_table(spark.range(3), out)
    group = "ignore-runs-nothing"
    spark.sparkContext.setJobGroup(group, group)
    result = ingest_json(spark, str(tmp_path / "missing"), out, mode="ignore")
    assert result.commit is None and result.table().count() == 3
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    ingest_json(spark, str(tmp_path / "missing"), out, mode="ignore")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == before
    spark.sparkContext.setJobGroup("", "")


def _jobs(spark, run):
    group = f"count-{id(run)}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def _append(spark, tmp_path, out, name, lines, **options):
    write_lines(tmp_path / name / "part.json", [x if isinstance(x, str) else json.dumps(x) for x in lines])
    return ingest_json(spark, str(tmp_path / name), out, mode="append", **options)


def test_an_append_of_known_columns_reads_its_input_once(spark, tmp_path, tmp_uri):
    out = tmp_uri("known")
    _append(spark, tmp_path, out, "one", [{"a": 1, "x": 1.5, "s": "t", "o": {"n": 1}}, {"a": 2}])
    result, jobs = _jobs(spark, lambda: _append(spark, tmp_path, out, "two", [{"o": {"n": 7}, "a": 3, "x": 2}, {"s": "u"}, " "]))
    assert jobs == 1 and result.commit.version == 1 and result.commit.metrics["rows_written"] in (2, None)
    got = sorted((r.a or 0, r.x, r.s, r.o and r.o.n) for r in result.table().collect())
    assert got == [(0, None, "u", None), (1, 1.5, "t", 1), (2, None, None, None), (3, 2.0, None, 7)]


@pytest.mark.parametrize(
    "lines",
    [
        [{"a": 1, "new": 5}],  # a column more
        [{"a": 1, "o": {"n": 1, "m": 2}}],  # within a struct
        [{"a": 1.5}],  # a wider type
        [{"A": 9}],  # other letter case: the same column
        [[{"a": 5}, {"a": 6}]],  # rows in an array
    ],
)
def test_an_append_that_does_not_fit_is_inferred(spark, tmp_path, tmp_uri, lines):
    out = tmp_uri("unknown")
    first = [{"a": 1, "x": 1.5, "s": "t", "o": {"n": 1}}]
    commit = _append(spark, tmp_path, out, "one", first).commit
    got = _append(spark, tmp_path, out, "two", lines, merge_schema=True)
    assert got.commit.version == 1 and len(got.commit.parts) == 2
    rows = [r.asDict(recursive=True) for r in got.table().collect()]
    flat = [x for line in lines for x in (line if isinstance(line, list) else [line])]
    assert len(rows) == 1 + len(flat)
    for record in flat:
        record = {k.lower(): v for k, v in record.items()}
        assert any(all(row[k] == v for k, v in record.items()) for row in rows)
    from strata.table.fs import HadoopFS

    listed = HadoopFS(spark, out).list_names(commit.generation)
    assert sorted(n for n in listed if "=" in n) == sorted(p.rsplit("/", 1)[1] for p in got.commit.parts)  # nothing is left over


def test_bad_lines_and_unknown_columns_are_still_refused(spark, tmp_path, tmp_uri):
    out = tmp_uri("refused")
    _append(spark, tmp_path, out, "one", [{"a": 1}])
    for i, lines in enumerate(([{"a": 2}, "{broken"], [{"a": 2, "new": 1}], [{"a": "text"}], [{"a": 2.5}])):
        with pytest.raises(SchemaMismatchError):
            _append(spark, tmp_path, out, f"bad{i}", lines)
    assert table_commit(spark, out).version == 0
    got = _append(spark, tmp_path, out, "merged", [{"a": 2}, "{broken"], merge_schema=True).table()
    assert sorted((r.a or 0, r._corrupt_record) for r in got.collect()) == [(0, "{broken"), (1, None), (2, None)]
    # the table has the column now
    got = _append(spark, tmp_path, out, "again", [{"a": 3}, "{worse"]).table()
    assert {r._corrupt_record for r in got.collect()} == {None, "{broken", "{worse"}


def test_an_append_can_be_partitioned_stamped_and_dealt(spark, trip_dir, tmp_path, tmp_uri):
    out = tmp_uri("stamped")
    ingest_json(spark, str(trip_dir), out, partition_by=["year", "month"], ingest_timestamp="seen_at")
    options = {"mode": "append", "ingest_timestamp": "seen_at", "repartition": 3}
    schema = table_commit(spark, out).schema
    given = StructType([f for f in schema.fields if f.name != "seen_at"])
    _, least = _jobs(spark, lambda: ingest_json(spark, str(trip_dir), out, schema=given, **options))
    result, jobs = _jobs(spark, lambda: ingest_json(spark, str(trip_dir), out, **options))
    assert jobs == least and result.commit.version == 2  # no job to infer a schema
    table = result.table()
    assert table.count() == 60 and table.where("seen_at IS NULL").count() == 0
    assert table.where("year = 2025 AND month = 6").count() == 33


def test_skipped_files_of_an_ingest(spark, trip_dir, tmp_uri):
    (trip_dir / "late.jsonl.gz").write_bytes(b"this is not gzip data")
    for mode in ("overwrite", "append"):
        result = ingest_json(spark, str(trip_dir), tmp_uri("skips"), mode=mode, ignore_corrupt_files=True)
        assert [r.path.rsplit("/", 1)[1] for r in result.skipped_files.collect()] == ["late.jsonl.gz"]
    assert result.table().count() == 40
    (trip_dir / "late.jsonl.gz").unlink()
    assert ingest_json(spark, str(trip_dir), tmp_uri("none")).skipped_files is None
