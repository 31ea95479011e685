"""Quality counts that outlive a crash, and recordings of which none is lost without a trace."""

import datetime as dt
import json

import pytest
from pyspark.sql.functions import expr as spark_expr

from quarry.jobs import streams
from quarry.operators.quality import Rule
from quarry.session import scratch_dir
from quarry.streaming import checked, ingest, pairing

RULES = [Rule("positive", "v > 0", "drop"), Rule("small", "v < 100")]


def put(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def counts(spark, root, since=0):
    return {r["expectation"]: (r["passing_records"], r["failing_records"]) for r in checked.metrics(spark, root, since).collect()}


def test_counts_survive_a_crash_between_rows_and_commit(spark, tmp_path):
    src, root = tmp_path / "in", scratch_dir(spark, "test-checked")
    put(src, "a.json", [{"k": 1, "v": 5}, {"k": 2, "v": -1}, {"k": 3}, {"k": 4, "v": 500}])
    stream = spark.readStream.schema("k BIGINT, v BIGINT").json(str(src))

    def crash(batch, i):
        checked.write_batch(batch, i, "t", RULES, root)
        raise RuntimeError("lost driver")

    with pytest.raises(Exception, match="lost driver"):
        ingest.run_foreach_batch(stream, crash, f"{root}/checkpoints/t")
    for _ in range(2):  # the replay, and a run without new input
        checked.load(stream, "t", RULES, root)
        assert counts(spark, root) == {"positive": (2, 2), "small": (2, 2)}
        assert sorted(r["k"] for r in checked.read(spark, "t", root).collect()) == [1, 4]
        assert {r["k"]: r["broken"] for r in checked.dropped(spark, "t", root).collect()} == {2: ["positive"], 3: ["positive", "small"]}
    put(src, "b.json", [{"k": 5, "v": 7}])
    checked.load(stream, "t", RULES, root)
    assert counts(spark, root) == {"positive": (3, 2), "small": (3, 2)}
    assert counts(spark, root, since=1) == {"positive": (1, 0), "small": (1, 0)}


def test_a_fail_rule_stops_the_batch_and_an_empty_batch_counts_zero(spark):
    root = scratch_dir(spark, "test-checked")
    df = spark.createDataFrame([(1, 5), (2, None)], "k long, v long")
    with pytest.raises(Exception, match="expectation 'known' violated"):
        checked.write_batch(df, 0, "t", [Rule("known", "v IS NOT NULL", "fail")], root)
    checked.write_batch(df.limit(0), 1, "t", RULES, root)
    assert counts(spark, root) == {"positive": (0, 0), "small": (0, 0)}
    assert checked.read(spark, "t", root).count() == 0


def test_every_recording_is_in_the_result_or_called_late_or_waiting(spark, tmp_path):
    left, right, root = tmp_path / "left", tmp_path / "right", scratch_dir(spark, "test-pairing")

    def at(day, hour=0):
        return dt.datetime(2024, 1, day, hour).isoformat()

    def run():
        a = spark.readStream.schema("id BIGINT, mrn BIGINT, heard TIMESTAMP, note STRING").json(str(left))
        b = spark.readStream.schema("mrn BIGINT, name STRING, known TIMESTAMP").json(str(right))
        done = pairing.pair(a, b, "mrn", "heard", "known", root)
        rows = pairing.account(spark, spark.read.schema(a.schema).json(str(left)), done, "id", "heard").collect()
        assert len(rows) == len({r["id"] for r in rows})
        return done, {r["id"]: r["status"] for r in rows}

    put(left, "1.json", [{"id": 1, "mrn": 7, "heard": at(1)}, {"id": 2, "mrn": 8, "heard": at(2)}, {"id": 3, "heard": at(2)},
                         {"id": 4, "mrn": 9, "heard": at(9)}, {"id": 5, "mrn": 7, "heard": at(10)}])
    put(right, "1.json", [{"mrn": 7, "name": "a", "known": at(1, 12)}, {"mrn": 8, "name": "b", "known": at(5)},
                          {"mrn": 10, "name": "c", "known": at(10)}])
    done, status = run()
    # patient 8 came three days after the recording; 4 may still be matched until day 10
    assert status == {1: "matched", 2: "unmatched", 3: "unmatched", 4: "waiting", 5: "matched"} and done.dropped == 0
    put(left, "2.json", [{"id": 6, "mrn": 7, "heard": at(3)}, {"id": 7, "mrn": 11, "heard": at(20)}])
    put(right, "2.json", [{"mrn": 9, "name": "d", "known": at(10)}, {"mrn": 12, "name": "e", "known": at(20)}])
    done, status = run()
    assert status == {1: "matched", 2: "unmatched", 3: "unmatched", 4: "matched", 5: "matched", 6: "late", 7: "waiting"}
    assert done.dropped == 1


def test_a_join_in_parts_has_all_pairs_and_holds_a_part_of_the_state(spark, sf_dir, monkeypatch):
    held, run = [], ingest.run_available_now

    def heard(df, sink, *args, **kw):
        batches = run(df, sink, *args, **kw)
        if "stream-join" in sink:
            held.append(max(op.numRowsTotal for p in batches for op in p.stateOperators))
        return batches

    g = streams.retail_graph(spark, sf_dir)
    orders, status = g.read("orders_silver"), g.read("status_silver")
    rows = orders.count() + status.count()
    monkeypatch.setattr(ingest, "run_available_now", heard)
    monkeypatch.setattr(pairing, "STATE_ROWS_PER_CORE", -(-rows // (4 * spark.sparkContext.defaultParallelism)), raising=False)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = sorted(streams.str08(spark, sf_dir).select("order_id", "order_status").collect())
    near = "o.order_id = s.order_id AND timestamp_seconds(s.status_timestamp) BETWEEN o.order_timestamp AND o.order_timestamp + INTERVAL 1 DAY"
    want = sorted(orders.alias("o").join(status.alias("s"), spark_expr(near)).select("o.order_id", "order_status").collect())
    assert got == want and got
    assert len(held) >= 3 and sum(held) == rows and max(held) < rows / 2
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_keys_without_a_value_or_met_twice_are_joined_once(spark, tmp_path):
    put(tmp_path / "a", "1.json", [{"k": k, "at": "2024-01-01T00:00:00"} for k in (1, 1, 2, None, 3)])
    put(tmp_path / "b", "1.json", [{"k": k, "seen": "2024-01-01T01:00:00"} for k in (1, 1, None, 3, 4)])
    a = spark.readStream.schema("k BIGINT, at TIMESTAMP").json(str(tmp_path / "a")).withWatermark("at", "1 day")
    b = spark.readStream.schema("k BIGINT, seen TIMESTAMP").json(str(tmp_path / "b")).withColumnRenamed("k", "j").withWatermark("seen", "1 day")
    batches, rows = pairing.join_in_parts(a, b, "k", "j", 3, scratch_dir(spark, "test-parts"),
                                          lambda x, y: x.join(y, spark_expr("k = j AND seen BETWEEN at AND at + INTERVAL 1 DAY")).select("k"))
    assert sorted(r["k"] for r in rows.collect()) == [1, 1, 1, 1, 3]
    assert sum(op.numRowsDroppedByWatermark for p in batches for op in p.stateOperators) == 0
