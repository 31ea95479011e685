"""CSV read modes, approximate distinct bounds and flow-registry rules."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quarry.session import scratch_dir
from quarry.sources import files
from quarry.streaming.flows import FlowError, FlowGraph


@pytest.fixture(scope="module")
def bad_csv(spark):
    p = scratch_dir(spark, "t-badcsv")
    spark.createDataFrame([("id,name",), ("1,a",), ("x,b",), ("3",), ("4,d",)], "value string") \
        .coalesce(1).write.text(p)
    return p


def test_csv_read_modes(spark, bad_csv):
    schema = "id INT, name STRING, _corrupt STRING"
    perm = files.read_csv(spark, bad_csv, schema=schema, corrupt_column="_corrupt").cache()
    assert perm.count() == 4
    assert sorted(r["_corrupt"] for r in perm.where("_corrupt IS NOT NULL").collect()) == ["3", "x,b"]
    drop = files.read_csv(spark, bad_csv, schema="id INT, name STRING", mode="DROPMALFORMED")
    assert sorted(r["id"] for r in drop.collect()) == [1, 4]
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        files.read_csv(spark, bad_csv, schema="id INT, name STRING", mode="FAILFAST").collect()


def test_approx_count_distinct_within_bound(spark, sf_dir):
    df = entry.queries()["agg05_approx_count_distinct"](spark, sf_dir)
    for r in df.collect():
        assert r["within_bound"] and r["exact_users"] > 0


def test_flow_registry_rules(spark, sf_dir):
    g = FlowGraph(spark, scratch_dir(spark, "t-flow"))

    @g.table(inputs=["b"])
    def a(g):
        return g.read("b")

    @g.table(inputs=["a"])
    def b(g):
        return g.read("a")

    with pytest.raises(FlowError, match="cycle"):
        g.order()

    g2 = FlowGraph(spark, scratch_dir(spark, "t-flow2"))

    @g2.table(inputs=["missing"])
    def c(g):
        return g.read("missing")

    with pytest.raises(FlowError, match="never declared"):
        g2.order()


def test_flow_orders_inputs_first_and_reads_once(spark):
    root = scratch_dir(spark, "t-flow3")
    src = f"{root}/src"
    spark.range(10).withColumn("v", F.col("id") * 2).coalesce(1).write.json(src)
    g = FlowGraph(spark, root)

    @g.table(name="gold", inputs=["silver"])
    def gold(g):
        return g.read("silver").agg(F.count(F.lit(1)).alias("n"))

    @g.table(name="silver", inputs=["bronze"], streaming=True)
    def silver(g):
        return g.read_stream("bronze").where("v % 4 = 0")

    @g.table(name="bronze", streaming=True)
    def bronze(g):
        from quarry.streaming import ingest
        return ingest.cloud_files(spark, src, "json")

    assert g.order() == ["bronze", "silver", "gold"]
    g.run()
    assert g.read("gold").first()["n"] == 5
    g.run()     # nothing new: streams read each file once, counts stay
    assert g.read("silver").count() == 5
    log = g.event_log()
    assert log.where("event_type = 'create_update'").count() == 2


def test_copy_into_loads_each_file_once(spark):
    from quarry.streaming import ingest
    root = scratch_dir(spark, "t-copy")
    src, target = f"{root}/src", f"{root}/target"
    spark.range(0, 10).selectExpr("id", "id * 2 AS v").coalesce(2).write.json(src)
    assert ingest.copy_into(spark, target, src, "id BIGINT, v BIGINT") == 10
    assert ingest.copy_into(spark, target, src, "id BIGINT, v BIGINT") == 0
    spark.range(10, 15).selectExpr("id", "id * 2 AS v").coalesce(1).write.mode("append").json(src)
    assert ingest.copy_into(spark, target, src, "id BIGINT, v BIGINT") == 5
    assert spark.read.parquet(target).count() == 15
