import datetime as dt

from pyspark.sql import functions as F

from strata.functions import (
    FEATURE_DESCRIPTION,
    mm_to_inch,
    predicate,
    rename_columns,
    with_ingest_timestamp,
    with_literal,
    with_year_month,
)
from strata.sources import rows

# Goldens of the sample data.
FEATURES = [
    {"id": 1, "name": "Feature1", "type": "HOLE", "diameter": 10.5},
    {"id": 2, "name": "Feature2", "type": "POCKET", "diameter": 20.0},
    {"id": 3, "name": "Feature3", "type": "SLOT", "diameter": 15.2},
]


def test_year_month_are_bigint_and_utc(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2025, 6, 30, 23, 54, 44),), (dt.datetime(2024, 12, 25, 23, 13, 15),)],
        "t timestamp_ntz",
    )
    out = with_year_month(df, "t")
    assert dict(out.dtypes)["year"] == "bigint" and dict(out.dtypes)["month"] == "bigint"
    assert sorted((r.year, r.month) for r in out.collect()) == [(2024, 12), (2025, 6)]


def test_year_month_from_timestamp_text(spark):
    df = spark.createDataFrame([("2025-06-30T23:54:44.000",)], "t string")
    out = with_year_month(df, F.to_timestamp("t")).collect()[0]
    assert (out.year, out.month) == (2025, 6)


def test_rename_is_case_insensitive_and_ignores_unknown(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "VendorID long, RatecodeID long, PULocationID long, DOLocationID long")
    out = rename_columns(
        df,
        {
            "DOLocationID": "do_location_id",
            "PULocationID": "pu_location_id",
            "ratecodeid": "rate_code_id",
            "VendorID": "vendor_id",
            "missing": "nothing",
        },
    )
    assert out.columns == ["vendor_id", "rate_code_id", "pu_location_id", "do_location_id"]


def test_feature_derivations(spark):
    df = rows(spark, FEATURES)
    out = with_literal(df, "description", FEATURE_DESCRIPTION).withColumn(
        "diameter_inch", mm_to_inch("diameter")
    )
    got = {r.id: (r.description, r.diameter_inch) for r in out.collect()}
    assert got == {
        1: ("CAD Feature", 10.5 / 25.4),
        2: ("CAD Feature", 20.0 / 25.4),
        3: ("CAD Feature", 15.2 / 25.4),
    }


def test_sql_text_predicate_and_expressions(spark):
    df = spark.range(0, 10)
    assert sorted(r.id for r in df.where(predicate("id % 2 == 0")).collect()) == [0, 2, 4, 6, 8]


def test_modulo_null_semantics(spark):
    df = spark.createDataFrame([(1,), (None,)], "id long")
    assert df.where(predicate("id % 2 == 1")).count() == 1
    assert df.where(~predicate("id % 2 == 1")).count() == 0


def test_ingest_timestamp_is_one_value(spark):
    out = with_ingest_timestamp(spark.range(100))
    assert dict(out.dtypes)["ingestion_ts"] == "timestamp"
    assert out.select("ingestion_ts").distinct().count() == 1


class _FakeConf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _FakeContext:
    def __init__(self, master, conf=None):
        self.master = master
        self._conf = _FakeConf(conf or {})
        self._dir = None

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, path):
        self._dir = "file:" + path


class _FakeSession:
    def __init__(self, context):
        self.sparkContext = context


def test_checkpoint_root_rules():
    import pytest

    from strata.session import checkpoint_root

    shared = _FakeSession(_FakeContext("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt/"}))
    assert checkpoint_root(shared) == "hdfs:///shared/ckpt"
    local = _FakeSession(_FakeContext("local[8]"))
    assert checkpoint_root(local).startswith("file:/")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_FakeSession(_FakeContext("spark://cluster:7077")))
