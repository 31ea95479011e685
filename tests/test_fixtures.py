"""Every derived dataset equals its DuckDB twin (the base of all oracle checks)."""

import pytest

from harness import compare
from quarry.jobs.oracle import with_fixtures
from quarry.sources import fixtures as fx


@pytest.mark.parametrize("name", sorted(n for n in fx.FIXTURES if n != "events_raw"))
def test_fixture_matches_oracle(spark, con, sf_dir, name):
    df = fx.FIXTURES[name](spark, sf_dir)
    ok, msg = compare(df, con, with_fixtures(f"SELECT * FROM {name}"), sort_lists=True)
    assert ok, msg


def test_events_raw_roundtrip(spark, sf_dir):
    from pyspark.sql import functions as F
    raw = fx.events_raw(spark, sf_dir)
    nested = fx.events_nested(spark, sf_dir)
    schema = nested.drop("event_id").schema
    back = raw.select(F.from_json(F.col("value").cast("string"), schema).alias("j")).select("j.*")
    assert back.exceptAll(nested.drop("event_id")).count() == 0
    assert raw.count() == nested.count()


def test_files_of_derived_rows_are_bounded_by_rows(spark, monkeypatch):
    """Rows that encode to next to nothing take their room as text."""
    from quarry.session import scratch_dir
    from quarry.sources import tables
    d = scratch_dir(spark, "t-files-for")
    (spark.range(1000).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "0L AS user_id", "'view' AS event_type",
                                  "0D AS value", "'{}' AS props").write.parquet(f"{d}/events.parquet"))
    assert tables.files_for(spark, d, "events", minimum=4) == 4
    monkeypatch.setattr(tables, "ROWS_PER_FILE", 90)
    assert tables.files_for(spark, d, "events", minimum=4) == 12


def test_rows_are_dealt_without_a_sort(spark):
    from quarry.streaming import ingest
    rows = spark.createDataFrame([(1, ["a"], {"k": 1}), (1, ["a"], {"k": 2}), (None, None, None)] * 5,
                                 "id int, `a.b` array<string>, m map<string,int>")
    dealt = ingest.deal(rows, 3)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id" in plan and "RoundRobin" not in plan and dealt.rdd.getNumPartitions() == 3
    assert sorted(map(repr, dealt.collect())) == sorted(map(repr, rows.collect()))
    only_maps = ingest.deal(rows.select("m"), 3)
    assert only_maps.count() == 15
