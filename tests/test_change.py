"""MERGE / UPDATE / DELETE semantics and versioned tables on small in-test frames."""

import datetime as dt

import pytest

from quarry.operators import change as C
from quarry.operators import layout, versions
from quarry.session import scratch_dir


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", None), (None, "n", 9.0)],
                                 "id int, name string, value double")


def test_update_leaves_null_predicate_rows(target):
    out = C.update(target, {"value": "value * 10"}, "value > 1")
    got = dict((r["name"], r["value"]) for r in out.collect())
    assert got == {"a": 1.0, "b": 20.0, "c": None, "n": 90.0}


def test_delete_keeps_rows_where_predicate_is_null(target):
    out = C.delete(target, "value > 1.5")
    assert sorted(r["name"] for r in out.collect()) == ["a", "c"]


def test_merge_clause_order_null_keys_and_insert(spark, target):
    src = spark.createDataFrame([(1, "A", 10.0, "update"), (2, None, None, "delete"), (4, "D", 4.0, "insert"),
                                 (5, "E", 5.0, "skip"), (None, "X", 0.0, "insert")],
                                "id int, name string, value double, type string")
    out = C.merge(target, src, ["id"], [
        C.Clause("matched", "update", "s.type = 'update'"),
        C.Clause("matched", "delete", "s.type = 'delete'"),
        C.Clause("not_matched", "insert", "s.type = 'insert'"),
    ])
    got = sorted((r["id"] if r["id"] is not None else -1, r["name"]) for r in out.collect())
    # 1 updated, 2 deleted, 3 and NULL-key target rows kept, 4 and the NULL-key source row inserted.
    assert got == [(-1, "X"), (-1, "n"), (1, "A"), (3, "c"), (4, "D")]


def test_merge_rejects_multiple_source_matches(spark, target):
    src = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0)], "id int, name string, value double")
    with pytest.raises(C.MergeError):
        C.merge(target, src, ["id"], [C.Clause("matched", "update")])


def test_merge_unknown_condition_is_not_satisfied(spark, target):
    src = spark.createDataFrame([(3, "C", 30.0)], "id int, name string, value double")
    out = C.merge(target, src, ["id"], [C.Clause("matched", "update", "t.value > 0")])
    assert {r["name"] for r in out.collect()} == {"a", "b", "c", "n"}


def test_insert_only_merge(spark, target):
    src = spark.createDataFrame([(1, "z", 0.0), (7, "g", 7.0)], "id int, name string, value double")
    new = C.insert_only_merge(target, src, ["id"])
    assert rows(new, "id", "name") == [(7, "g")]


def test_generated_column_mismatch_fails(spark):
    df = spark.createDataFrame([(1, 5)], "a int, b int")
    ok = C.with_generated(df, "b", "a * 5")
    assert ok.count() == 1
    bad = spark.createDataFrame([(1, 6)], "a int, b int")
    with pytest.raises(Exception, match="generated column"):
        C.with_generated(bad, "b", "a * 5").collect()


def test_enforce_constraints(spark):
    df = spark.createDataFrame([(1,), (-1,)], "v int")
    assert C.constraint_violations(df, {"pos": "v > 0"}).count() == 1
    with pytest.raises(Exception, match="CHECK constraint"):
        C.enforce_constraints(df, {"pos": "v > 0"}).collect()


def test_versions_time_travel_restore_vacuum(spark):
    root = scratch_dir(spark, "t-versions")
    a = spark.createDataFrame([(1, "a")], "id int, name string")
    versions.commit(spark, root, a, "CREATE")
    versions.commit(spark, root, versions.snapshot_read(spark, root).unionByName(
        spark.createDataFrame([(2, "b")], "id int, name string")), "WRITE")
    versions.commit(spark, root, C.delete(versions.snapshot_read(spark, root), "id = 1"), "DELETE")
    assert versions.snapshot_read(spark, root, 1).count() == 2
    assert versions.snapshot_read(spark, root).count() == 1
    h = versions.history(spark, root).orderBy("version").collect()
    assert [r["operation"] for r in h] == ["CREATE", "WRITE", "DELETE"]
    assert versions.snapshot_read(spark, root, as_of=h[1]["timestamp"]).count() == 2
    versions.restore(spark, root, 1)
    assert versions.snapshot_read(spark, root).count() == 2
    d = versions.diff(spark, root, 1, 2)
    assert rows(d, "id", "change") == [(1, "removed")]
    future = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(hours=1)
    dry = versions.vacuum(spark, root, retain_hours=0, dry_run=True, now=future)
    assert sorted(r["version"] for r in dry.collect()) == [0, 1, 2]
    versions.vacuum(spark, root, retain_hours=0, dry_run=False, now=future)
    with pytest.raises(versions.VersionNotFound):
        versions.snapshot_read(spark, root, 0).count()
    assert versions.snapshot_read(spark, root).count() == 2


def test_zorder_keeps_rows(spark):
    root = scratch_dir(spark, "t-z")
    df = spark.range(1000).selectExpr("id", "id % 37 AS a", "(id * 7) % 101 AS b")
    versions.commit(spark, root, df, "CREATE")
    v = layout.zorder(spark, root, ["a", "b"], num_files=4)
    out = versions.snapshot_read(spark, root, v)
    assert out.exceptAll(df).count() == 0 and df.exceptAll(out).count() == 0
    assert versions.detail(spark, root, v).first()["num_files"] == 4


def test_clones(spark):
    src = scratch_dir(spark, "t-src")
    versions.commit(spark, src, spark.createDataFrame([(1,)], "id int"), "CREATE")
    deep = scratch_dir(spark, "t-deep")
    assert versions.deep_clone(spark, src, deep) == [0]
    assert versions.deep_clone(spark, src, deep) == []
    versions.commit(spark, src, spark.createDataFrame([(1,), (2,)], "id int"), "WRITE")
    assert versions.deep_clone(spark, src, deep) == [1]
    shallow = scratch_dir(spark, "t-shallow")
    versions.shallow_clone(spark, src, shallow, 0)
    assert versions.snapshot_read(spark, shallow).count() == 1
    versions.commit(spark, shallow, spark.createDataFrame([(5,)], "id int"), "WRITE")
    assert versions.snapshot_read(spark, src, 0).count() == 1
