"""Plan properties that matter at scale: pushdown, pruning, no Python in hot paths."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quarry.plans import inspect
from quarry.sources.tables import table

QUERIES = entry.queries()
# Jobs that exist to demonstrate Python UDFs.
PY_OK = {"udf01_python_udf", "udf02_registered_for_sql", "udf03_decorator_udf", "udf04_pandas_udf"}


def test_filter_pushdown_and_column_pruning(spark, sf_dir):
    q = table(spark, sf_dir, "lineitem").where(F.col("l_quantity") > 10).select("l_orderkey")
    pushed = inspect.pushed_filters(q)
    assert any("l_quantity" in p for p in pushed)
    schema = inspect.read_schemas(q)[0]
    assert "l_orderkey" in schema and "l_comment" not in schema and "l_extendedprice" not in schema


def test_fixture_reads_only_needed_columns(spark, sf_dir):
    df = QUERIES["job21_available_quantity_per_part"](spark, sf_dir)
    schema = inspect.read_schemas(df)[0]
    assert schema == "struct<l_partkey:bigint,l_quantity:double>"


@pytest.mark.parametrize("name", ["job02_top_traffic_sources", "job06_item_purchase_pivot", "job07_click_paths",
                                  "chg03_merge_update_delete_insert", "str05_apply_changes_batch_twin",
                                  "job09_abandoned_items", "dq04_several_rules_cdc_aware"])
def test_headline_jobs_stay_in_the_jvm(spark, sf_dir, name):
    s = inspect.summary(QUERIES[name](spark, sf_dir))
    assert s["python_udfs"] == 0, s


def test_aggregates_are_partial_before_the_shuffle(spark, sf_dir):
    df = QUERIES["agg04_agg_with_alias"](spark, sf_dir)
    phys = inspect.section(inspect.plan_text(df), "Physical Plan")
    assert phys.count("HashAggregate") >= 2 and "partial_" in phys


def test_repeated_filters_merge(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    q = e.filter("value > 1").filter("value > 1").filter("user_id >= 0")
    assert inspect.summary(q)["logical_filters"] == 1


def test_merge_does_not_shuffle_the_target(spark, sf_dir):
    """A small source is broadcast: the target scan feeds the join directly."""
    phys = inspect.section(inspect.plan_text(QUERIES["chg03_merge_update_delete_insert"](spark, sf_dir)),
                           "Physical Plan")
    assert "BroadcastHashJoin" in phys and "LeftOuter" in phys
    assert "FullOuter" not in phys and "SortMergeJoin" not in phys
