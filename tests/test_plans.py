"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES, Inputs
from docketflow.functions.case_types import with_case_type
from docketflow.operators import catalogue, reports
from docketflow.plans import discovery
from docketflow.sources.courts import court_dimension


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert banned not in plan, banned


@pytest.mark.parametrize("name", ["discover_hc", "discover_sc", "insert_or_ignore",
                                  "rejected_items", "kv_latest", "lifecycle_fold"])
def test_keyed_steps_use_no_window(spark, sf_dir, name):
    assert "Window" not in plan_of(QUERIES[name](spark, sf_dir))


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "items")
    Inputs(spark, "/root/testdata/sf0.001").items().write.partitionBy("source").parquet(path)
    plan = plan_of(reports.list_items(spark.read.parquet(path), "failed"))
    assert "EqualTo(status,failed)" in plan and "parties" not in plan.split("ReadSchema")[-1]
    assert "TakeOrderedAndProject" in plan
    stats = plan_of(reports.source_stats(spark.read.parquet(path)))
    assert "ReadSchema: struct<bytes:bigint,status:string>" in stats


def test_partition_values_prune_the_listing(spark, tmp_path):
    path = str(tmp_path / "objects")
    objects = Inputs(spark, "/root/testdata/sf0.001").objects()
    objects.write.partitionBy("source", "year").parquet(path)
    plan = plan_of(catalogue.expand_hc(spark.read.parquet(path), 2012, 2013))
    filters = plan.split("PartitionFilters: [")[1]
    assert "source" in filters and "2012" in filters


def test_court_dimension_is_broadcast_and_documents_are_not_hinted(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(discovery.discover_hc(
            i.objects(), i.fx("hc_meta"), court_dimension(spark)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    assert plan.count("BroadcastHashJoin [court_code") == 1


def test_folded_text_is_computed_once(spark):
    rows = spark.range(1).select(F.col("id").cast("string").alias("t"))
    plan = plan_of(with_case_type(rows, "c", "t"))
    assert plan.count("lower(") == 1


def test_the_metadata_index_is_shuffled_once_for_both_lookups(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["discover_sc"](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        plan = plan_of(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ReusedExchange" in plan or "ReusedQueryStage" in plan


@pytest.mark.parametrize("name", ["discover_hc", "discover_sc", "discovered_profile"])
def test_wide_metadata_rows_are_not_aggregated(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    wide = [x for x in plan.split("\n") if "Aggregate" in x and "description" in x]
    assert "SortAggregate" not in plan and not wide
    assert "HashAggregate" in plan and "LeftSemi" in plan


def test_the_status_feed_reads_no_ledger_rows(spark, tmp_path):
    from docketflow.plans import feed
    from docketflow.sources.store import TableStore
    store = TableStore(spark, str(tmp_path / "ledger"))
    store.create()
    nothing = spark.createDataFrame([], "path string, bytes bigint")
    plan = plan_of(feed.report(store, nothing, F.current_timestamp()))
    assert "size:bigint,n:bigint,bytes:bigint" in plan and "s3_key" not in plan
