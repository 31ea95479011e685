"""Plan and cache operators: facts of a plan as rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.jobs.registry import register
from quarry.plans import inspect
from quarry.sources.tables import table


@register("opt01_combined_duplicate_filters", """
SELECT 'logical_filters' AS fact, CAST(1 AS BIGINT) AS value
UNION ALL SELECT 'rows', count(*) FROM events WHERE event_type <> 'error' AND value > 1 AND user_id >= 0""")
def opt01(spark, d):
    """Four chained filters (one repeated) leave one Filter in the optimized plan."""
    e = table(spark, d, "events")
    chained = (e.filter(F.col("event_type") != "error").filter(F.col("value") > 1)
                .filter(F.col("value") > 1).filter(F.col("user_id") >= 0))
    s = inspect.summary(chained)
    assert s["logical_filters"] == 1, s
    return spark.createDataFrame([("logical_filters", s["logical_filters"]), ("rows", chained.count())],
                                 "fact string, value bigint")


@register("opt02_pushdown_and_cache", """
SELECT 'pushed_filters' AS fact, 'IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)' AS value
UNION ALL SELECT 'read_schema', 'struct<o_orderkey:bigint,o_totalprice:double,o_orderpriority:string>'
UNION ALL SELECT 'in_memory_scans_after_cache', '1'
UNION ALL SELECT 'rows', CAST(count(*) AS VARCHAR) FROM orders WHERE o_orderpriority = '1-URGENT'""")
def opt02(spark, d):
    """Filters reach the parquet scan; after cache() they sit above InMemoryTableScan."""
    o = table(spark, d, "orders")
    q = o.where(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_totalprice")
    pushed = inspect.pushed_filters(q)
    schema = inspect.read_schemas(q)
    assert any("o_orderpriority" in p for p in pushed), pushed
    assert schema and "o_custkey" not in schema[0], schema
    cached = o.cache()
    after = cached.where(F.col("o_orderpriority") == "1-URGENT")
    s = inspect.summary(after)
    n = after.count()
    cached.unpersist()
    return spark.createDataFrame([("pushed_filters", ";".join(pushed)), ("read_schema", schema[0]),
                                  ("in_memory_scans_after_cache", str(s["in_memory_scans"])), ("rows", str(n))],
                                 "fact string, value string")


@register("opt03_cache_unpersist", """
SELECT unnest(['before', 'cached', 'after']) AS state, unnest(['Serialized 1x Replicated',
  'Disk Memory Deserialized 1x Replicated', 'Serialized 1x Replicated']) AS storage_level""")
def opt03(spark, d):
    """Storage level before and after cache() / unpersist()."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_quantity")
    before = str(li.storageLevel)
    li.cache()
    li.count()
    during = str(li.storageLevel)
    li.unpersist()
    return spark.createDataFrame([("before", before), ("cached", during), ("after", str(li.storageLevel))],
                                 "state string, storage_level string")
