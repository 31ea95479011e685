"""Every registered job against its DuckDB oracle (sf0.001 by default).

Jobs without an oracle (random, time-dependent or physical results) must
still run and return a stable schema.
"""

import pytest

import __spark_entry__ as entry
from check_types import SPARK_TO_DUCK
from harness import compare
from quarry.jobs import QUERIES as JOBS

# The optional subpackage's queries have tests of their own, in tests/llm.
QUERIES = {k: v for k, v in entry.queries().items() if k in JOBS}
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in JOBS}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLE:
        ok, msg = compare(df, con, ORACLE[name])
        assert ok, msg
        rel = con.sql(ORACLE[name])
        duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        spark_types = {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes}
        assert spark_types == duck_types
    else:
        assert df.columns and not df.isEmpty()


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["traffic_source", "total_rev", "avg_rev"]
    assert 0 < df.count() <= 3


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
