"""Sort, limit, top-k, unions and event-time windows.

A full ``orderBy`` is a range-partitioned shuffle (sampled bounds, no single
task holds everything); ``orderBy().limit(k)`` plans as TakeOrderedAndProject,
a per-partition top-k merged on the driver in k-sized pieces.  Global sorts
end with a unique tie-breaker column: rows sharing a hot sort value then
still spread over several range partitions instead of one task.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.jobs.oracle import sround
from quarry.jobs.registry import register
from quarry.sources import fixtures as fx
from quarry.sources.tables import table


@register("srt01_sort_asc_desc", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey""")
def srt01(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return o.sort(F.col("o_totalprice").desc(), F.col("o_orderkey"))


@register("srt02_multi_key_mixed", """
SELECT user_id, count(*) AS total_records, max(time) AS last_seen
FROM user_ping GROUP BY user_id ORDER BY total_records DESC, user_id""")
def srt02(spark, d):
    return (fx.user_ping(spark, d).groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("total_records"), F.max("time").alias("last_seen"))
            .orderBy(F.col("total_records").desc(), F.col("user_id")))


@register("srt03_desc_nulls_last", """
SELECT user_id, email FROM users_dirty ORDER BY email DESC NULLS LAST, user_id""")
def srt03(spark, d):
    return (fx.users_dirty(spark, d).select("user_id", "email")
            .orderBy(F.col("email").desc_nulls_last(), F.col("user_id").asc_nulls_last()))


@register("srt04_limit", """
SELECT least(count(*), 25) AS rows, true AS all_from_table FROM events_nested""")
def srt04(spark, d):
    """limit without order: which rows is open, but there are 25 and all are rows of the table."""
    rows = fx.events_nested(spark, d).select("event_id", "user_id")
    some = rows.limit(25)
    known = some.join(rows.withColumn("known", F.lit(True)).distinct(), ["event_id", "user_id"], "left")
    return known.agg(F.count("*").alias("rows"), F.every(F.coalesce("known", F.lit(False))).alias("all_from_table"))


@register("srt05_top_k", f"""
SELECT event_id, user_id, {sround('ecommerce.purchase_revenue_in_usd', 2)} AS revenue
FROM events_nested WHERE ecommerce.purchase_revenue_in_usd IS NOT NULL
ORDER BY ecommerce.purchase_revenue_in_usd DESC, event_id LIMIT 10""")
def srt05(spark, d):
    r = F.col("ecommerce.purchase_revenue_in_usd")
    return (fx.events_nested(spark, d).filter(r.isNotNull())
            .orderBy(r.desc(), "event_id").limit(10)
            .select("event_id", "user_id", F.round(r, 2).alias("revenue")))


@register("set01_union_by_position", """
SELECT user_id, email FROM users
UNION ALL
SELECT user_id, email FROM users_dirty""")
def set01(spark, d):
    a = fx.users(spark, d).select("user_id", "email")
    b = fx.users_dirty(spark, d).select("user_id", "email")
    return a.union(b)


@register("set02_union_by_name_missing", """
SELECT user_id, email, NULL::TIMESTAMP AS updated, NULL::BIGINT AS order_id FROM users
UNION ALL
SELECT NULL::VARCHAR AS user_id, email, NULL::TIMESTAMP AS updated, order_id FROM sales""")
def set02(spark, d):
    a = fx.users(spark, d).select("user_id", "email", F.lit(None).cast("timestamp_ntz").alias("updated"))
    b = fx.sales(spark, d).select("order_id", "email")
    return a.unionByName(b, allowMissingColumns=True)


@register("win01_tumbling_window_batch", f"""
SELECT user_id, time_bucket(INTERVAL 3 MINUTE, time) + INTERVAL 3 MINUTE AS window_end,
       {sround('avg(ping)', 6)} AS avg_ping, count(*) AS pings
FROM user_ping GROUP BY user_id, time_bucket(INTERVAL 3 MINUTE, time)""")
def win01(spark, d):
    """Average ping per user per 3-minute tumbling window (window end kept)."""
    return (fx.user_ping(spark, d)
            .groupBy("user_id", F.window("time", "3 minutes"))
            .agg(F.round(F.avg("ping"), 6).alias("avg_ping"), F.count(F.lit(1)).alias("pings"))
            .select("user_id", F.col("window.end").alias("window_end"), "avg_ping", "pings"))
