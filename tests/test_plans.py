"""Plan shape of the catalogue queries: pruning, pushdown, top-k, exchanges."""

from strata.plans import exchanges, partition_filters, plan_text, pushed_filters, read_schemas
from strata.plans.catalog import (
    q06_rename,
    q10_filter_modulo,
    q11_distinct,
    q13_first_20,
    q15_split_export,
    q26_pruned_read,
    q27_repartition,
)

SF = "/root/testdata/sf0.001"


def test_pruned_table_read_uses_partition_filters(spark):
    df = q26_pruned_read(spark, SF)
    filters = " ".join(partition_filters(df))
    assert "year" in filters and "1997" in filters and "month" in filters
    assert read_schemas(df) == ["struct<o_orderkey:bigint>"]
    assert df.count() > 0


def test_projection_reaches_the_scan(spark):
    schemas = read_schemas(q06_rename(spark, SF))
    assert schemas == ["struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int>"]


def test_filter_is_pushed_as_far_as_parquet_allows(spark):
    df = q10_filter_modulo(spark, SF)
    assert any("IsNotNull(o_orderkey)" in f for f in pushed_filters(df))
    assert "WholeStageCodegen" in plan_text(df, "formatted") or "*(" in plan_text(df, "simple")


def test_top_k_is_not_a_global_sort(spark):
    text = plan_text(q13_first_20(spark, SF), "simple")
    assert "TakeOrderedAndProject" in text
    assert "rangepartitioning" not in text


def test_distinct_combines_map_side(spark):
    text = plan_text(q11_distinct(spark, SF), "simple")
    assert text.count("HashAggregate") >= 2  # partial + final around one exchange
    assert len(exchanges(q11_distinct(spark, SF))) == 1


def test_repartition_then_coalesce_is_one_shuffle(spark):
    plan = exchanges(q27_repartition(spark, SF))
    assert len(plan) == 1 and "RoundRobinPartitioning" in plan[0]


def test_split_export_reads_back_every_row(spark):
    df = q15_split_export(spark, SF)
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    assert df.count() == orders.count()
