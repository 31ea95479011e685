"""Nested rescue, stored schemas, type walks and replayed CDC batches."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.operators import shape
from quarry.session import scratch_dir
from quarry.sources import fs
from quarry.streaming import cdc, ingest


def land(spark, lines, path=None):
    path = path or scratch_dir(spark, "t-land")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)
    return path


def rescued(spark, lines, schema):
    sink = scratch_dir(spark, "t-out")
    ingest.run_available_now(ingest.cloud_files(spark, land(spark, lines), "json", schema=schema), f"{sink}/out", f"{sink}/ckpt")
    return spark.read.parquet(f"{sink}/out").collect()


@pytest.mark.parametrize("line, want", [
    ('{"items":[{"qty":"oops"}]}', {"items[0].qty": "oops"}),
    ('{"items":[{"qty":1},{"qty":2.5,"x":true}]}', {"items[1].qty": "2.5", "items[1].x": "true"}),
    ('{"items":[{"qty":1},null,{"qty":null}]}', None),
    ('{"items":[7]}', {"items": "[7]"}),  # no struct at all: the parser gives up the array, which is kept whole
    ('{"items":"none"}', {"items": "none"}),
    ('{"who":{"name":"a","age":{"years":3}}}', {"who.age": '{"years":3}'}),
    ('{"who":{"name":"a","age":3,"odd key":[1]}}', {'who[["odd key"]]': "[1]"}),
    ('{"who":{"deep":{"at":"not a time"}},"z":1}', {"who.deep.at": "not a time", "z": "1"}),
    ('{"tags":{"a":1,"b":"two"}}', {"tags": '{"a":1,"b":"two"}'}),  # so with a map
    ('{"who.age":1,"who":{"age":"x"}}', {"who.age": "1"}),  # a top-level key spelled like a path keeps its place
    ('{"items":[],"who":null,"tags":{}}', None),
])
def test_nested_misfits_are_rescued_by_path(spark, line, want):
    schema = "items ARRAY<STRUCT<qty: INT>>, who STRUCT<name: STRING, age: INT, deep: STRUCT<at: TIMESTAMP>>, tags MAP<STRING, INT>"
    got = rescued(spark, [line], schema)[0]["_rescued_data"]
    assert (json.loads(got) if got else None) == want


def held(spark, lines, ddl):
    schema = StructType.fromDDL(ddl)
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
    typed = rows.withColumn("j", F.from_json("value", schema))
    out = typed.select("i", ingest.rescued_column(F.col("value"), F.col("j"), schema).alias("r")).collect()
    return [json.loads(r["r"]) if r["r"] else None for r in sorted(out)]


def test_flat_lines_are_rescued_whether_or_not_their_keys_are_counted(spark):
    want = {
        '{"a":1,"b":"x"}': None,
        '{"a":1}': None,
        '{"a":1,"b":null}': None,
        "{}": None,
        "   ": None,
        '{"a":1,"c":"x"}': {"c": "x"},  # as many keys as fields, one of them unknown
        '{"a":"no","b":"x"}': {"a": "no"},
        '{"A":1,"b":"x"}': {"A": "1"},
        '{"a":1,"b":"x"': {"_corrupt_record": '{"a":1,"b":"x"'},
        "[1]": {"_corrupt_record": "[1]"},
    }
    assert dict(zip(want, held(spark, want, "a INT, b STRING"), strict=True)) == want


def test_a_field_that_the_parser_fills_hides_no_misfit(spark):
    assert held(spark, ['{"a":"no"}'], "a INT, _corrupt_record STRING")[0]["a"] == "no"


def test_a_restart_reads_no_old_file_for_its_schema(spark):
    root = scratch_dir(spark, "t-evolve")
    src = land(spark, ['{"a": 1}', '{"a": 2}'], f"{root}/in")
    assert ingest.run_evolving(spark, src, f"{root}/out", f"{root}/schema", f"{root}/ckpt") == []
    for name, _ in fs.list_files(spark, src, ".txt"):  # what was read is read no more
        os.chmod(f"{src.removeprefix('file:')}/{name}", 0o644)
        with open(f"{src.removeprefix('file:')}/{name}", "w") as f:
            f.write("no json " * 3)
    land(spark, ['{"a": 3, "b": {"c": 1}, "note": "x"}', '{"a": "oops"}'], src)
    assert ingest.run_evolving(spark, src, f"{root}/out", f"{root}/schema", f"{root}/ckpt") == ["b", "note"]
    land(spark, ['{"a": 4, "b": {"c": 2}, "note": 5}'], src)
    assert ingest.run_evolving(spark, src, f"{root}/out", f"{root}/schema", f"{root}/ckpt") == []
    out = ingest.read_evolved(spark, f"{root}/out")
    got = sorted(((r["a"], r["b"], r["note"], r["_rescued_data"]) for r in out.collect()), key=repr)
    assert got == sorted([(1, None, None, None), (2, None, None, None), (3, None, None, '{"b":"{\\"c\\":1}","note":"x"}'),
                          (None, None, None, '{"a":"oops"}'), (4, '{"c":2}', "5", None)], key=repr)
    assert [f.name for f in ingest.stored_schema(spark, f"{root}/schema").fields] == ["a", "b", "note"]


def test_inferred_types_keep_field_names(spark):
    df = spark.createDataFrame([('{"VOIDED": true, "n": null, "OBJECT": {"VOID": null, "a b": [{"x": 1}]}}',)], "value string")
    ddl = shape.infer_json_schema(df)
    row = shape.parse_json_value(df, ddl).first()
    assert row["VOIDED"] is True and row["n"] is None and row["OBJECT"]["a b"][0]["x"] == 1 and row["OBJECT"]["VOID"] is None


def test_a_committed_cdc_batch_that_is_replayed_writes_nothing(spark):
    root = scratch_dir(spark, "t-cdc")
    feed = lambda rows: spark.createDataFrame(rows, "id int, name string, seq int, __deleted boolean")
    cdc.write_batch(spark, root, feed([(1, "a", 1, False), (2, "b", 1, False)]), "q#0", ["id"], "seq", 4)
    cdc.write_batch(spark, root, feed([(1, "c", 2, False)]), "q#1", ["id"], "seq")
    path = root.removeprefix("file:")
    stat = {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names}
    cdc.write_batch(spark, root, feed([(1, "c", 2, False)]), "q#1", ["id"], "seq")
    assert stat == {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names}
    assert sorted((r["id"], r["name"]) for r in cdc.read_target(spark, root).collect()) == [(1, "c"), (2, "b")]


def test_a_line_is_parsed_once_for_its_rescue(spark):
    """Nested fields name the parsed line many times; each way of parsing must stand in the plan once."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import StructType
    ddl = "id INT, who STRUCT<name: STRING, age: INT, deep: STRUCT<at: TIMESTAMP>>, items ARRAY<STRUCT<qty: INT, price: INT>>"
    schema = StructType.fromDDL(ddl)
    lines = ['{"id":1,"who":{"name":"a","age":3},"items":[{"qty":1,"price":2}]}',
             '{"id":2,"who":{"name":"a","gone":null},"items":[{"qty":"x","price":2},{"qty":1,"more":[1]}]}']
    raw = spark.createDataFrame([(x,) for x in lines], "value string").select("value", F.from_json("value", schema).alias("j"))
    out = raw.select("j.id", ingest.rescued_column(F.col("value"), F.col("j"), schema).alias("r"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1 and plan.count("from_json(MapType") == 1
    got = {r["id"]: r["r"] and json.loads(r["r"]) for r in out.collect()}
    assert got == {1: None, 2: {"who.gone": "null", "items[0].qty": "x", "items[1].more": "[1]"}}
