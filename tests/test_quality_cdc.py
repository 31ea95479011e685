"""Expectations (warn / drop / fail, NULL handling) and CDC apply semantics."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from quarry.operators import quality
from quarry.operators.quality import Rule
from quarry.session import scratch_dir
from quarry.streaming import cdc, ingest


def test_expectations_warn_drop_and_null(spark):
    df = spark.createDataFrame([(1, "a@b.com"), (2, None), (3, "bad")], "id int, email string")
    rules = [Rule("has_email", "email IS NOT NULL"), Rule("valid", "email LIKE '%@%'", "drop")]
    obs = Observation("dq")
    kept = quality.apply(df, rules, obs)
    assert sorted(r["id"] for r in kept.collect()) == [1]      # NULL counts as a violation
    m = {x["name"]: (x["passed_records"], x["failed_records"]) for x in quality.observed_metrics(obs, rules)}
    assert m == {"has_email": (2, 1), "valid": (1, 2)}
    mdf = {r["name"]: (r["passed_records"], r["failed_records"]) for r in quality.metrics(df, rules).collect()}
    assert mdf == m


def test_expectation_fail_aborts(spark):
    df = spark.createDataFrame([(1,), (-1,)], "v int")
    with pytest.raises(Exception, match="expectation 'positive' violated"):
        quality.apply(df, [Rule("positive", "v > 0", "fail")]).select(F.lit(1)).collect()


def _feed(spark, rows):
    return spark.createDataFrame(rows, "id int, name string, operation string, seq int")


def test_cdc_late_update_cannot_revive_delete(spark):
    changes = _feed(spark, [(1, "a", "INSERT", 1), (1, None, "DELETE", 5), (1, "late", "UPDATE", 3),
                            (2, "b", "INSERT", 1), (2, "b2", "UPDATE", 2), (3, "c", "INSERT", None)])
    out = cdc.apply_changes_batch(changes, ["id"], "seq", "operation = 'DELETE'")
    assert sorted((r["id"], r["name"]) for r in out.collect()) == [(2, "b2")]


def test_cdc_stream_out_of_order_files_and_replay(spark):
    root = scratch_dir(spark, "t-cdc")
    feed = f"{root}/feed"
    batches = [[(1, "a", "INSERT", 1), (2, "x", "INSERT", 1)],
               [(1, None, "DELETE", 9), (2, "y", "UPDATE", 4)],
               [(1, "old", "UPDATE", 5), (2, "older", "UPDATE", 2), (3, "z", "INSERT", 1)]]
    schema = "id INT, name STRING, operation STRING, seq INT"
    target = f"{root}/target"
    for i, b in enumerate(batches):
        _feed(spark, b).coalesce(1).write.mode("append").json(feed)
        stream = spark.readStream.schema(schema).json(feed)
        cdc.apply_changes(spark, stream, target, ["id"], "seq", "operation = 'DELETE'", buckets=4)
    got = sorted((r["id"], r["name"]) for r in cdc.read_target(spark, target).collect())
    assert got == [(2, "y"), (3, "z")]
    # Replaying a batch on top of the state is a no-op (newest sequence wins).
    state = cdc.read_state(spark, target)
    again = cdc.merge_changes(state, _feed(spark, batches[2]), ["id"], "seq", "operation = 'DELETE'", 4)
    assert sorted((r["id"], r["name"], r["__deleted"]) for r in again.collect()) == \
        sorted((r["id"], r["name"], r["__deleted"]) for r in state.collect())


def test_rescued_data_and_hints(spark):
    root = scratch_dir(spark, "t-rescue")
    spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": "oops", "c": 3}',)], "value string") \
        .coalesce(1).write.text(root)
    s = ingest.cloud_files(spark, root, "json", schema="a INT, b STRING")
    sink = scratch_dir(spark, "t-rescue-out")
    ingest.run_available_now(s, f"{sink}/out", f"{sink}/ckpt")
    got = sorted(((r["a"] if r["a"] is not None else -1), r["_rescued_data"])
                 for r in spark.read.parquet(f"{sink}/out").collect())
    assert got == [(-1, '{"a":"oops","c":"3"}'), (1, None)]
    hinted = ingest.apply_hints(ingest.infer_schema(spark, root, "json", infer_types=False), "a DOUBLE")
    assert dict((f.name, f.dataType.simpleString()) for f in hinted.fields)["a"] == "double"


def test_expect_returns_metrics(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    kept, obs = quality.expect(df, [Rule("not_null", "v IS NOT NULL", "drop")])
    assert kept.count() == 2
    assert quality.observed_metrics(obs, [Rule("not_null", "v IS NOT NULL", "drop")])[0]["failed_records"] == 1


def test_cdc_reads_only_touched_buckets(spark):
    import re
    from quarry.plans import inspect
    root = scratch_dir(spark, "t-prune")
    ch = spark.createDataFrame([(i, f"n{i}", "UPDATE", i) for i in range(500)],
                               "id int, name string, operation string, seq int")
    cdc.merge_changes(None, ch, ["id"], "seq", "operation = 'DELETE'", 32).write.partitionBy("__bucket").parquet(root)
    batch = _feed(spark, [(5, "x", "UPDATE", 999)])
    merged = cdc.merge_changes(spark.read.parquet(root), batch, ["id"], "seq", "operation = 'DELETE'", 32)
    filters = re.findall(r"PartitionFilters: \[(.*?)\]", inspect.plan_text(merged, "formatted"))
    assert any(re.search(r"__bucket#\d+ = \d+", f) for f in filters), filters
    rows = merged.collect()
    assert len({r["__bucket"] for r in rows}) == 1 and len(rows) < 500      # one bucket's rows only
    assert {r["name"] for r in rows if r["id"] == 5} == {"x"}


def _marked(spark, rows):
    return _feed(spark, rows).withColumn(cdc.DELETED, F.expr("operation = 'DELETE'"))


def test_cdc_replay_after_a_crash_keeps_every_row(spark):
    """Batch 1 dies between its data and its manifest, with one of its buckets gone; the replay loses nothing."""
    from quarry.sources import fs
    root = scratch_dir(spark, "t-crash")
    write = lambda rows, name: cdc.write_batch(spark, root, _marked(spark, rows), name, ["id"], "seq", 8)
    write([(i, "old", "INSERT", 1) for i in range(200)], "q#0")
    second = [(i, "new", "UPDATE", 2) for i in range(0, 200, 3)]
    write(second, "q#1")
    want = sorted(map(tuple, cdc.read_target(spark, root).collect()))
    fs.delete(spark, f"{root}/manifest/1.json")
    fs.delete(spark, f"{root}/versions/1/part=3")
    assert cdc.read_target(spark, root).where("name = 'old'").count() == 200   # the manifest before it is whole
    write(second, "q#1")
    assert sorted(map(tuple, cdc.read_target(spark, root).collect())) == want and len(want) == 200
    write(second, "q#1")    # replayed once more, after its manifest
    assert sorted(map(tuple, cdc.read_target(spark, root).collect())) == want
    for k in range(2, 6):
        write([(i, f"v{k}", "UPDATE", k + 1) for i in range(200)], f"q#{k}")
    assert sorted(fs.list_names(spark, f"{root}/versions")) == ["4", "5"]     # no staging is left behind


def test_cdc_bucket_count_is_fixed_and_only_named_columns_go(spark):
    root = scratch_dir(spark, "t-buckets")
    rows = [(i, "a", "INSERT", 1) for i in range(50)]
    cdc.write_batch(spark, root, _marked(spark, rows), "q#0", ["id"], "seq", 8)
    with pytest.raises(ValueError, match="8 buckets"):
        cdc.write_batch(spark, root, _marked(spark, rows), "q#1", ["id"], "seq", 6)
    cdc.write_batch(spark, root, _marked(spark, rows), "q#1", ["id"], "seq")
    assert cdc.manifest(spark, root)["buckets"] == 8 and cdc.read_target(spark, root).count() == 50
    assert cdc.read_target(spark, root).columns == ["id", "seq", "name", "operation"]
    assert "operation" not in cdc.read_target(spark, root, ["operation"]).columns


def test_cdc_buckets_follow_the_state(spark, monkeypatch):
    """A state that outgrows its buckets is hashed anew; deletes, late rows and a replay come out as before."""
    from quarry.sources import fs
    assert [cdc.buckets_for(n) for n in (0, 1, 10 ** 6, 10 ** 6 + 1, 3 * 10 ** 6 + 1)] == [1, 1, 1, 2, 4]
    monkeypatch.setattr(cdc, "ROWS_PER_BUCKET", 20)
    root = scratch_dir(spark, "t-grow")
    write = lambda rows, name: cdc.write_batch(spark, root, _marked(spark, rows), name, ["id"], "seq")
    write([(i, "a", "INSERT", 1) for i in range(15)], "q#0")
    assert cdc.manifest(spark, root)["buckets"] == 1
    write([(i, "b", "INSERT", 1) for i in range(15, 100)] + [(3, None, "DELETE", 5)], "q#1")
    write([(3, "late", "UPDATE", 4), (4, "c", "UPDATE", 2)], "q#2")     # finds 100 rows in one bucket
    m = cdc.manifest(spark, root)
    assert m["buckets"] == 8 and sum(m["rows"].values()) == 100 and set(m["at"].values()) == {2}
    write([(5, "d", "UPDATE", 2)], "q#3")
    write([(5, "d", "UPDATE", 2)], "q#3")
    m = cdc.manifest(spark, root)
    assert m["buckets"] == 8 and sum(m["rows"].values()) == 100 and list(m["at"].values()).count(3) == 1
    got = {r["id"]: r["name"] for r in cdc.read_target(spark, root).collect()}
    assert got == {i: "a" if i < 15 else "b" for i in range(100) if i != 3} | {4: "c", 5: "d"}
    empty = scratch_dir(spark, "t-grow-empty")
    cdc.write_batch(spark, empty, _marked(spark, [(1, "a", "INSERT", 1)]).limit(0), "q#0", ["id"], "seq")
    assert cdc.read_target(spark, empty).count() == 0 and fs.list_names(spark, f"{empty}/manifest")


def test_schema_inference_sees_a_field_of_the_last_file_only(spark):
    root = scratch_dir(spark, "t-late-field")
    for k in range(40):
        line = '{"a": 1, "late": 2}' if k == 39 else '{"a": 1}'
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(root)
    assert ingest.infer_schema(spark, root).names == ["a", "late"]


def test_progress_of_more_batches_than_spark_keeps(spark):
    root = scratch_dir(spark, "t-many")
    spark.range(40).repartition(40).write.option("maxRecordsPerFile", 1).json(f"{root}/in")
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    try:
        s = spark.readStream.schema("id BIGINT").option("maxFilesPerTrigger", 2).json(f"{root}/in")
        batches = ingest.run_available_now(s.observe("n", F.count(F.lit(1)).alias("rows")), f"{root}/out", f"{root}/ckpt")
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert len(batches) > 10 and sum(p.numInputRows for p in batches) == 40
    assert sum(p.observedMetrics["n"]["rows"] for p in batches) == 40


def _streamed(spark, df):
    sink = scratch_dir(spark, "t-sink")
    ingest.run_available_now(df, f"{sink}/out", f"{sink}/ckpt")
    return spark.read.parquet(f"{sink}/out")


def test_rescue_keeps_corrupt_json_lines(spark):
    root = scratch_dir(spark, "t-corrupt")
    lines = ['{"a": 1}', '{"a": 2', "not json", "[1]", "", '{"a": null, "b": 5}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(root)
    got = _streamed(spark, ingest.cloud_files(spark, root, "json", schema="a INT")).collect()
    rescued = sorted(r["_rescued_data"] for r in got if r["_rescued_data"])
    assert rescued == sorted(['{"_corrupt_record":"{\\"a\\": 2"}', '{"_corrupt_record":"not json"}',
                              '{"_corrupt_record":"[1]"}', '{"b":"5"}'])
    assert [r["a"] for r in got if r["a"] is not None] == [1]


def test_rescue_keeps_csv_misfits(spark):
    root = scratch_dir(spark, "t-csv-misfits")
    lines = ["id,name", "1,a", "oops,b", "3", "4,d,extra"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(root)
    got = _streamed(spark, ingest.cloud_files(spark, root, "csv", schema="id INT, name STRING")).collect()
    assert sorted((r["id"] or 0, r["_rescued_data"] or "") for r in got) == [
        (0, '{"id":"oops"}'), (1, ""), (3, '{"_corrupt_record":"3"}'), (4, '{"_corrupt_record":"4,d,extra"}')]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from quarry.session import checkpoint_root
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: None)))


def test_cdc_keeps_one_row_a_key_of_a_batch(spark, monkeypatch):
    """What is held between the steps, and counted for the buckets, is the newest change per key, not the batch."""
    counted, real = [], cdc.buckets_for
    monkeypatch.setattr(cdc, "buckets_for", lambda n: counted.append(n) or real(n))
    root = scratch_dir(spark, "t-held")
    rows = [(i % 7, f"n{i}", "UPDATE", i) for i in range(300)] + [(None, "x", "UPDATE", 1), (1, "x", "UPDATE", None)]
    cdc.write_batch(spark, root, _marked(spark, rows), "q#0", ["id"], "seq")
    assert counted == [7]
    cdc.write_batch(spark, root, _marked(spark, [(3, None, "DELETE", 999), (4, "late", "UPDATE", 0)]), "q#1", ["id"], "seq")
    got = {r["id"]: r["name"] for r in cdc.read_target(spark, root).collect()}
    newest = {i % 7: f"n{i}" for i in range(300)}
    assert got == {k: v for k, v in newest.items() if k != 3}
