"""MERGE by touched bucket, generated columns, and file-wise compaction."""

import glob
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quarry.operators import buckets as B
from quarry.operators import change as C
from quarry.operators import layout
from quarry.session import scratch_dir

CLAUSES = [C.Clause("matched", "update", "s.type = 'update'"), C.Clause("matched", "delete", "s.type = 'delete'"),
           C.Clause("not_matched", "insert", "s.type = 'insert'")]


def local(path):
    return path.removeprefix("file:")


def files(path):
    return {f: (os.path.getmtime(f), os.path.getsize(f)) for f in glob.glob(f"{local(path)}/**/*.parquet", recursive=True)}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def table(spark):
    path = scratch_dir(spark, "t-buckets")
    df = spark.range(200).select(F.col("id").cast("int").alias("id"), F.concat(F.lit("n"), "id").alias("name"), F.col("id").cast("double").alias("value"))
    B.write_bucketed(df.unionByName(spark.createDataFrame([(None, "null key", 0.0)], "id int, name string, value double")), path, ["id"], 16)
    return path


def test_merge_into_equals_merge_and_touches_only_its_buckets(spark, table):
    source = spark.createDataFrame([(1, "A", 10.0, "update"), (2, None, None, "delete"), (1000, "D", 4.0, "insert"),
                                    (3, "x", 0.0, "skip"), (None, "N", 7.0, "insert")], "id long, name string, value double, type string")
    before, held = files(table), rows(B.read_bucketed(spark, table))
    want = rows(C.merge(spark.createDataFrame(held, "id int, name string, value double"), source, ["id"], CLAUSES))
    ids = B.merge_into(spark, table, source, ["id"], CLAUSES)
    assert rows(B.read_bucketed(spark, table)) == want
    after = files(table)
    rewritten = {f"__bucket={b}" for b in ids}
    assert 1 <= len(ids) <= 5
    for f, stat in before.items():  # an untouched bucket's files are the same files, with the same time
        assert (os.path.basename(os.path.dirname(f)) in rewritten) != (after.get(f) == stat)


def test_merge_reads_only_the_touched_buckets(spark, table):
    plan = B.merged_rows(B.read_bucketed(spark, table, [3]), spark.createDataFrame([(1, "u")], "id int, type string"), ["id"],
                         [C.Clause("matched", "delete")])._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") == 1 and "FullOuter" in plan
    assert "PartitionFilters: [" in plan and "__bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_bucket_that_loses_all_rows_is_removed_and_a_swap_can_run_again(spark, table):
    source = B.read_bucketed(spark, table).where("id IS NOT NULL").select("id", F.lit("delete").alias("type"))
    ids = B.merge_into(spark, table, source, ["id"], CLAUSES[:2])
    assert len(ids) == 16 and rows(B.read_bucketed(spark, table)) == [(None, "null key", 0.0)]
    staged = scratch_dir(spark, "t-staged")
    spark.createDataFrame([(7, "seven", 7.0, 5)], "id int, name string, value double, __bucket int").write.parquet(staged)
    for _ in range(2):
        B.swap(spark, table, staged, [5])
        assert (7, "seven", 7.0) in rows(B.read_bucketed(spark, table))


def test_double_match_fails_the_job_and_changes_nothing(spark, table):
    source = spark.createDataFrame([(1, "x", 1.0, "update"), (1, "y", 2.0, "update")], "id int, name string, value double, type string")
    before = files(table)
    with pytest.raises(PySparkException, match="more than one source row"):
        B.merge_into(spark, table, source, ["id"], CLAUSES)
    assert files(table) == before
    twice = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0), (900, "a", 1.0), (900, "b", 1.0)], "id int, name string, value double")
    B.merge_into(spark, table, twice, ["id"], [C.Clause("not_matched", "insert")])
    got = rows(B.read_bucketed(spark, table))
    assert len(got) == 203 and sum(r[0] == 900 for r in got) == 2 and (1, "n1", 1.0) in got


def test_generated_columns_follow_their_dependence(spark):
    gen = {"label": "concat(year, '-', band)", "band": "CASE WHEN value > 100 THEN 'high' ELSE 'low' END", "year": "cast(year(day) AS string)"}
    assert B.generated_order(gen)[-1] == "label"
    t = spark.createDataFrame([(1, "2020-05-01", 1.0, "2020", "low", "2020-low"), (2, "2021-05-01", 500.0, "old", "old", "old")],
                              "id int, day string, value double, year string, band string, label string").withColumn("day", F.to_date("day"))
    s = spark.createDataFrame([(1, "2022-01-01", 200.0), (3, "2023-01-01", None)], "id int, day string, value double").withColumn("day", F.to_date("day"))
    got = B.merged_rows(t, s, ["id"], [C.Clause("matched", "update", set={"value": "s.value"}), C.Clause("not_matched", "insert")], gen)
    assert {r["id"]: (r["year"], r["band"], r["label"]) for r in got.collect()} == {
        1: ("2020", "high", "2020-high"), 2: ("old", "old", "old"), 3: ("2023", "low", "2023-low")}
    bad = s.withColumn("band", F.lit("low"))
    with pytest.raises(PySparkException, match="does not match"):
        B.merged_rows(t, bad, ["id"], [C.Clause("matched", "update"), C.Clause("not_matched", "insert")], gen).collect()
    with pytest.raises(ValueError, match="depend on each other"):
        B.generated_order({"a": "b + 1", "b": "a + 1"})


def test_compaction_leaves_large_files_alone(spark):
    path = scratch_dir(spark, "t-compact")
    big = spark.range(0, 40_000, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"))
    small = spark.range(40_000, 40_900, 1, 9).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"))
    for k, part in (("a b", big), ("a b", small), ("c", small.withColumn("id", F.col("id") + 1000))):
        part.withColumn("k", F.lit(k)).write.mode("append").partitionBy("k").parquet(path)
    want, before = rows(spark.read.parquet(path)), files(path)
    large = max(before, key=lambda f: before[f][1])
    held = open(large, "rb").read()
    with open(large, "r+b") as f:  # a file that must not be opened
        f.write(b"no parquet")
    stat = (os.path.getmtime(large), os.path.getsize(large))
    got = layout.compact_files(spark, path, target_file_bytes=1_000_000)
    assert got == {"files_before": 18, "files_after": 2}
    after = files(path)
    assert after[large] == stat and len(after) == 3
    with open(large, "wb") as f:
        f.write(held)
    assert rows(spark.read.parquet(path)) == want
    assert layout.compact_files(spark, path, target_file_bytes=1_000_000) == {"files_before": 0, "files_after": 0}


def test_compaction_bins_stay_near_the_target(spark):
    path = scratch_dir(spark, "t-bins")
    spark.range(0, 20_000, 1, 20).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x")).write.parquet(path)
    size = sorted(s for _, s in files(path).values())
    target = 5 * size[-1]
    plan = layout.small_files(spark, path, target).groupBy("bin").agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).collect()
    assert 4 <= len(plan) <= 5 and all(r["b"] < target + size[-1] and r["n"] > 1 for r in plan)
    want = rows(spark.read.parquet(path))
    layout.compact_files(spark, path, target)
    assert len(files(path)) <= 5 and rows(spark.read.parquet(path)) == want
