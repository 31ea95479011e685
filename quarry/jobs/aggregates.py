"""Aggregation, pivot and statistics.

All groupings run as partial (map-side) + final hash aggregates; a key
holding a third of the rows is pre-combined in every task before the shuffle,
so no single task sees its raw rows.  Pivots name their values (one pass);
the discovered-values form costs one extra distinct job, as in Spark.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.jobs.oracle import sround
from quarry.jobs.registry import register
from quarry.operators import shape
from quarry.sources import fixtures as fx
from quarry.sources.tables import table

EVENT_NAMES = ["click", "error", "purchase", "signup", "view"]
# The six part categories of the test tables' part table.
ITEM_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@register("agg01_grouped_count", "SELECT event_name, count(*) AS count FROM events_nested GROUP BY event_name")
def agg01(spark, d):
    return fx.events_nested(spark, d).groupBy("event_name").count()


@register("agg02_grouped_avg_nested", f"""
SELECT geo.state AS state, {sround('avg(ecommerce.purchase_revenue_in_usd)', 6)} AS avg_revenue
FROM events_nested GROUP BY geo.state""")
def agg02(spark, d):
    out = (fx.events_nested(spark, d).groupBy("geo.state")
           .avg("ecommerce.purchase_revenue_in_usd")
           .toDF("state", "avg_revenue"))
    return out.withColumn("avg_revenue", F.round("avg_revenue", 6))


@register("agg03_multi_key_sum", f"""
SELECT geo.state AS state, geo.city AS city,
  CAST(sum(ecommerce.total_item_quantity) AS BIGINT) AS total_quantity,
  {sround('sum(ecommerce.purchase_revenue_in_usd)', 2)} AS total_revenue
FROM events_nested GROUP BY geo.state, geo.city""")
def agg03(spark, d):
    ev = fx.events_nested(spark, d).select(
        F.col("geo.state").alias("state"), F.col("geo.city").alias("city"),
        F.col("ecommerce.total_item_quantity").alias("total_quantity"),
        F.col("ecommerce.purchase_revenue_in_usd").alias("total_revenue"))
    out = ev.groupBy("state", "city").sum("total_quantity", "total_revenue")
    return out.select("state", "city",
                      F.col("sum(total_quantity)").alias("total_quantity"),
                      F.round("sum(total_revenue)", 2).alias("total_revenue"))


@register("agg04_agg_with_alias", f"""
SELECT traffic_source, {sround('sum(ecommerce.purchase_revenue_in_usd)', 2)} AS total_rev,
       {sround('avg(ecommerce.purchase_revenue_in_usd)', 6)} AS avg_rev, count(*) AS events
FROM events_nested GROUP BY traffic_source""")
def agg04(spark, d):
    r = F.col("ecommerce.purchase_revenue_in_usd")
    return (fx.events_nested(spark, d).groupBy("traffic_source")
            .agg(F.round(F.sum(r), 2).alias("total_rev"), F.round(F.avg(r), 6).alias("avg_rev"),
                 F.count(F.lit(1)).alias("events")))


@register("agg05_approx_count_distinct", """
SELECT device, count(DISTINCT user_id) AS exact_users, true AS within_bound FROM events_nested GROUP BY device""")
def agg05(spark, d):
    """HyperLogLog++ distinct estimate: within three standard errors (5 % each) of the exact count."""
    ev = fx.events_nested(spark, d)
    both = (ev.groupBy("device")
              .agg(F.approx_count_distinct("user_id", rsd=0.05).alias("approx_users"),
                   F.count_distinct("user_id").alias("exact_users")))
    return both.select("device", "exact_users", _within("approx_users", "exact_users", 3 * 0.05).alias("within_bound"))


def _within(estimate: str, exact: str, share: float):
    return F.abs(F.col(estimate) - F.col(exact)) <= F.col(exact) * share


@register("agg05_merged_sketches", """
SELECT device, count(DISTINCT user_id) AS exact_users, true AS within_bound FROM events_nested GROUP BY device""")
def agg05_merged(spark, d):
    """Distinct users per device from sketches kept per device and day, merged without the rows.

    A sketch of 2^12 registers has a standard error of 1.04 / sqrt(2^12), 1.6 %.
    """
    ev = fx.events_nested(spark, d)
    daily = ev.groupBy("device", F.to_date(F.timestamp_micros("event_timestamp")).alias("day")).agg(
        F.hll_sketch_agg("user_id", 12).alias("sketch"))
    merged = daily.groupBy("device").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_users"))
    exact = ev.groupBy("device").agg(F.count_distinct("user_id").alias("exact_users"))
    return merged.join(exact, "device").select("device", "exact_users",
                                               _within("approx_users", "exact_users", 3 * 1.04 / 64).alias("within_bound"))


@register("agg12_percentile_sketch", """
SELECT unnest([25, 50, 75]) AS percent, (SELECT count(value) FROM events) AS n, true AS within_bound""")
def agg12_percentiles(spark, d):
    """Percentiles of a mergeable rank sketch: each has a rank within n / 10000 rows of the one asked for."""
    e = table(spark, d, "events").select("value").where("value IS NOT NULL")
    asked = [25, 50, 75]
    found = e.agg(F.percentile_approx("value", [p / 100 for p in asked], 10_000).alias("q")).first()["q"]
    ranks = e.agg(F.count("*").alias("n"), *[F.count(F.when(F.col("value") < q, 1)).alias(f"below{p}") for p, q in zip(asked, found)],
                  *[F.count(F.when(F.col("value") <= q, 1)).alias(f"upto{p}") for p, q in zip(asked, found)])
    one = [F.struct(F.lit(p).alias("percent"), F.col("n"), (
        (F.col(f"below{p}") <= F.col("n") * (p / 100) + F.col("n") / 10_000 + 1)
        & (F.col(f"upto{p}") >= F.col("n") * (p / 100) - F.col("n") / 10_000 - 1)).alias("within_bound")) for p in asked]
    return ranks.select(F.explode(F.array(*one)).alias("x")).select("x.*")


@register("agg06_min_max_mean", f"""
SELECT user_id, min(time) AS first_seen, max(time) AS last_seen,
       {sround('avg(ping)', 6)} AS mean_ping, min(ping) AS min_ping, max(ping) AS max_ping
FROM user_ping GROUP BY user_id""")
def agg06(spark, d):
    return (fx.user_ping(spark, d).groupBy("user_id")
            .agg(F.min("time").alias("first_seen"), F.max("time").alias("last_seen"),
                 F.round(F.mean("ping"), 6).alias("mean_ping"),
                 F.min("ping").alias("min_ping"), F.max("ping").alias("max_ping")))


@register("agg07_collect_set", """
SELECT user_id, array_to_string(list_sort(list(DISTINCT event_name)), ',') AS event_names
FROM events_nested GROUP BY user_id""")
def agg07(spark, d):
    return (fx.events_nested(spark, d).groupBy("user_id")
            .agg(F.array_join(F.sort_array(F.collect_set("event_name")), ",").alias("event_names")))


@register("agg08_collect_list", """
SELECT order_id, array_to_string(list_sort(list(item_id)), ',') AS item_ids, count(*) AS n
FROM (SELECT order_id, unnest(items).item_id AS item_id FROM sales) GROUP BY order_id""")
def agg08(spark, d):
    s = fx.sales(spark, d).select("order_id", F.explode("items.item_id").alias("item_id"))
    return (s.groupBy("order_id")
             .agg(F.array_join(F.sort_array(F.collect_list("item_id")), ",").alias("item_ids"),
                  F.count(F.lit(1)).alias("n")))


@register("agg09_statistics", f"""
SELECT event_type,
  {sround('corr(value, CAST(user_id AS DOUBLE))', 6)} AS corr_value_user,
  {sround('stddev_samp(value)', 6)} AS stddev_value,
  {sround('var_pop(value)', 6)} AS var_pop_value,
  {sround('sum(DISTINCT value)', 2)} AS sum_distinct_value
FROM events GROUP BY event_type""")
def agg09(spark, d):
    e = table(spark, d, "events")
    return (e.groupBy("event_type")
             .agg(F.round(F.corr("value", F.col("user_id").cast("double")), 6).alias("corr_value_user"),
                  F.round(F.stddev_samp("value"), 6).alias("stddev_value"),
                  F.round(F.var_pop("value"), 6).alias("var_pop_value"),
                  F.round(F.sum_distinct("value"), 2).alias("sum_distinct_value")))


@register("agg10_first", """
SELECT user_id, true AS own_device, true AS own_source FROM events_nested GROUP BY user_id""")
def agg10(spark, d):
    """first() and any_value() per group: which one is open, but it is one of the group's."""
    picked = (fx.events_nested(spark, d).groupBy("user_id")
              .agg(F.first("device").alias("device"), F.any_value("traffic_source").alias("source"),
                   F.collect_set("device").alias("devices"), F.collect_set("traffic_source").alias("sources")))
    return picked.select("user_id", F.array_contains("devices", F.col("device")).alias("own_device"),
                         F.array_contains("sources", F.col("source")).alias("own_source"))


@register("agg11_sum_boolean_as_int", """
SELECT traffic_source, CAST(sum(CAST(event_name = 'purchase' AS INTEGER)) AS BIGINT) AS purchases,
       CAST(sum(CAST(device = 'iOS' AS INTEGER)) AS BIGINT) AS ios_events
FROM events_nested GROUP BY traffic_source""")
def agg11(spark, d):
    return (fx.events_nested(spark, d).groupBy("traffic_source")
            .agg(F.sum((F.col("event_name") == "purchase").cast("int")).alias("purchases"),
                 F.sum((F.col("device") == "iOS").cast("int")).alias("ios_events")))


@register("agg12_describe_summary")
def agg12(spark, d):
    """describe(): count/mean/stddev/min/max per column as text (rows-only)."""
    e = table(spark, d, "events").select("value", "user_id")
    return e.summary("count", "mean", "stddev", "min", "25%", "max")


@register("agg12_summary_values", """
SELECT unnest(['count', 'mean', 'stddev', 'min', 'max']) AS summary,
  unnest([round(count(value), 6), round(avg(value), 6), round(stddev_samp(value), 6), round(min(value), 6), round(max(value), 6)]) AS value,
  unnest([round(count(user_id), 6), round(avg(user_id), 6), round(stddev_samp(user_id), 6), round(min(user_id), 6),
          round(max(user_id), 6)]) AS user_id
FROM events""")
def agg12_values(spark, d):
    """The exact figures of summary() as numbers, to six decimals."""
    e = table(spark, d, "events").select("value", "user_id")
    number = [F.round(F.col(c).cast("double"), 6).alias(c) for c in e.columns]
    return e.summary("count", "mean", "stddev", "min", "max").select("summary", *number)


@register("agg13_group_by_date_expr", """
SELECT CAST(ts AS DATE) AS event_date, date_trunc('day', ts) AS day_start, count(*) AS events
FROM events GROUP BY CAST(ts AS DATE), date_trunc('day', ts)""")
def agg13(spark, d):
    e = table(spark, d, "events")
    return (e.groupBy(F.col("ts").cast("date").alias("event_date"),
                      F.date_trunc("DD", "ts").cast("timestamp_ntz").alias("day_start"))
             .agg(F.count(F.lit(1)).alias("events")))


@register("agg14_pivot_explicit_sum", """
SELECT order_id, email,
""" + ",\n".join(f"  CAST(sum(quantity) FILTER (WHERE item_type = '{t}') AS BIGINT) AS {t}" for t in ITEM_TYPES) + """
FROM (""" + """
SELECT s.order_id, s.email, s.item.quantity AS quantity, b.item_type
FROM (SELECT order_id, email, unnest(items) AS item FROM sales) s
JOIN item_lookup b ON s.item.item_id = b.item_id""" + """)
GROUP BY order_id, email""")
def agg14(spark, d):
    from quarry.jobs.joins import item_purchases
    ip = item_purchases(spark, d)
    return shape.pivot_sum(ip, ["order_id", "email"], "item_type", ITEM_TYPES, "quantity")


@register("agg15_pivot_count", """
SELECT user_id,
""" + ",\n".join(f"  nullif(count(*) FILTER (WHERE event_name = '{n}'), 0) AS {n}" for n in EVENT_NAMES) + """
FROM events_nested GROUP BY user_id""")
def agg15(spark, d):
    return shape.pivot_count(fx.events_nested(spark, d), ["user_id"], "event_name", EVENT_NAMES)


@register("agg16_pivot_discovered_values", """
SELECT device,
""" + ",\n".join(f"  {sround(f'sum(value) FILTER (WHERE event_type = {chr(39)}{n}{chr(39)})', 2)} AS {n}" for n in EVENT_NAMES) + """
FROM (SELECT e.*, ['macOS', 'Windows', 'iOS', 'Android'][CAST(user_id % 4 + 1 AS INTEGER)] AS device FROM events e)
GROUP BY device""")
def agg16(spark, d):
    e = table(spark, d, "events").withColumn(
        "device", F.element_at(F.array(*[F.lit(x) for x in fx.DEVICES]), (F.col("user_id") % 4 + 1).cast("int")))
    p = e.groupBy("device").pivot("event_type").agg(F.sum("value"))
    return p.select("device", *[F.round(c, 2).alias(c) for c in p.columns if c != "device"])


@register("agg17_global_aggregate_cast", """
SELECT CAST(sum(total_item_quantity) AS BIGINT) AS total_quantity, count(*) AS orders
FROM sales""")
def agg17(spark, d):
    return fx.sales(spark, d).agg(F.sum("total_item_quantity").cast("bigint").alias("total_quantity"),
                                  F.count(F.lit(1)).alias("orders"))
