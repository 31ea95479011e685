"""Arrays, structs, JSON and higher-order functions.

Lambdas (filter / transform / exists / aggregate) run as JVM expressions in
whole-stage codegen; nothing here calls Python per row.  Array results are
presented as joined text (sorted where the engine order is unspecified) so
the value check is order-independent.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.jobs.oracle import sround
from quarry.jobs.registry import register
from quarry.operators import shape
from quarry.sources import fixtures as fx
from quarry.sources.tables import table


@register("cpx01_explode_array_of_struct", """
SELECT order_id, item.item_id AS item_id, item.quantity AS quantity
FROM (SELECT order_id, unnest(items) AS item FROM sales)""")
def cpx01(spark, d):
    s = fx.sales(spark, d).withColumn("items", F.explode("items"))
    return s.select("order_id", F.col("items.item_id").alias("item_id"), F.col("items.quantity").alias("quantity"))


@register("cpx02_size", "SELECT event_id, CAST(len(items) AS INTEGER) AS n_items FROM events_nested")
def cpx02(spark, d):
    return fx.events_nested(spark, d).select("event_id", F.size("items").alias("n_items"))


@register("cpx03_field_through_array", """
SELECT event_id, array_to_string(list_transform(items, lambda i: i.item_id), ',') AS item_ids
FROM events_nested""")
def cpx03(spark, d):
    return fx.events_nested(spark, d).select(
        "event_id", F.array_join(F.col("items.item_id"), ",").alias("item_ids"))


@register("cpx04_flatten_distinct_history", """
SELECT user_id,
  array_to_string(list_sort(list(DISTINCT event_name)), ',') AS event_history,
  array_to_string(list_sort(list_distinct(flatten(list(list_transform(items, lambda i: i.item_id))))), ',') AS cart_history
FROM events_nested GROUP BY user_id""")
def cpx04(spark, d):
    return shape.event_and_cart_history(fx.events_nested(spark, d))


@register("cpx05_array_contains", """
SELECT order_id,
  CASE WHEN list_contains(list_transform(items, lambda i: i.coupon), 'NEWBED10') THEN true
       WHEN len(list_filter(items, lambda i: i.coupon IS NULL)) > 0 THEN NULL
       ELSE false END AS used_coupon
FROM sales""")
def cpx05(spark, d):
    return fx.sales(spark, d).select(
        "order_id", F.array_contains(F.col("items.coupon"), fx.COUPON).alias("used_coupon"))


@register("cpx06_element_at", """
SELECT item_id, string_split(name, ' ')[1] AS first_word, string_split(name, ' ')[2] AS second_word
FROM item_lookup""")
def cpx06(spark, d):
    words = F.split("name", " ")
    return fx.item_lookup(spark, d).select("item_id", F.element_at(words, 1).alias("first_word"),
                                           F.element_at(words, 2).alias("second_word"))


@register("cpx07_filter_lambda", """
SELECT order_id, array_to_string(list_sort(list_transform(list_filter(items, lambda i: i.item_id LIKE '%5'), lambda i: i.item_id)), ',') AS items_ending_5
FROM sales WHERE len(list_filter(items, lambda i: i.item_id LIKE '%5')) > 0""")
def cpx07(spark, d):
    k = fx.sales(spark, d).select("order_id", F.filter("items", lambda i: i.item_id.like("%5")).alias("k"))
    return (k.where(F.size("k") > 0)
             .select("order_id", F.array_join(F.sort_array(F.col("k.item_id")), ",").alias("items_ending_5")))


@register("cpx08_transform_lambda", """
SELECT order_id,
  array_to_string(list_sort(list_transform(items, lambda i: CAST(trunc(i.item_revenue_in_usd * 100) AS INTEGER))), ',') AS item_revenues
FROM sales""")
def cpx08(spark, d):
    t = F.transform("items", lambda i: (i.item_revenue_in_usd * 100).cast("int"))
    return fx.sales(spark, d).select("order_id", F.array_join(F.sort_array(t), ",").alias("item_revenues"))


@register("cpx09_exists_lambda", """
SELECT order_id,
  len(list_filter(items, lambda i: i.item_name LIKE '%gear')) > 0 AS gear,
  len(list_filter(items, lambda i: i.item_name LIKE 'blue%')) > 0 AS blue
FROM sales""")
def cpx09(spark, d):
    return fx.sales(spark, d).select(
        "order_id",
        F.exists("items", lambda i: i.item_name.like("%gear")).alias("gear"),
        F.exists("items", lambda i: i.item_name.like("blue%")).alias("blue"))


@register("cpx10_reduce_lambda", f"""
SELECT order_id, {sround('list_sum(list_transform(items, lambda i: i.item_revenue_in_usd))', 2)} AS revenue
FROM sales""")
def cpx10(spark, d):
    total = F.aggregate("items", F.lit(0.0), lambda acc, i: acc + i.item_revenue_in_usd)
    return fx.sales(spark, d).select("order_id", F.round(total, 2).alias("revenue"))


@register("cpx11_binary_to_string", """
SELECT event_id AS "offset", user_id AS key, event_name FROM events_nested""")
def cpx11(spark, d):
    raw = fx.events_raw(spark, d)
    return raw.select("offset", F.col("key").cast("string").alias("key"),
                      F.get_json_object(F.col("value").cast("string"), "$.event_name").alias("event_name"))


@register("cpx12_json_path", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def cpx12(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@register("cpx13_schema_of_json", """
SELECT count(*) AS rows, count(json_extract_string(props, '$.k')) AS values_found FROM events""")
def cpx13(spark, d):
    """Infer one schema that fits every JSON value of the column, then parse every row with it."""
    e = table(spark, d, "events")
    ddl = shape.infer_json_schema(e, "props")
    return e.select(F.from_json("props", ddl).alias("j")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("j.k").alias("values_found"))


@register("cpx14_from_json_struct", """
SELECT event_id, device, event_name, event_timestamp, geo.city AS city, geo.state AS state,
  ecommerce.purchase_revenue_in_usd AS purchase_revenue_in_usd, CAST(len(items) AS INTEGER) AS n_items,
  traffic_source, user_id
FROM events_nested""")
def cpx14(spark, d):
    raw = fx.events_raw(spark, d)
    parsed = shape.parse_json_value(raw, fx.events_nested(spark, d).drop("event_id").schema)
    return parsed.select(F.col("offset").alias("event_id"), "device", "event_name", "event_timestamp",
                         F.col("geo.city").alias("city"), F.col("geo.state").alias("state"),
                         F.col("ecommerce.purchase_revenue_in_usd").alias("purchase_revenue_in_usd"),
                         F.size("items").alias("n_items"), "traffic_source", "user_id")


@register("cpx15_from_json_array_explode", """
SELECT event_id, item.item_id AS item_id, item.quantity AS quantity
FROM (SELECT event_id, unnest(items) AS item FROM events_nested)""")
def cpx15(spark, d):
    ev = fx.events_nested(spark, d).select("event_id", F.to_json("items").alias("items_json"))
    arr = F.from_json("items_json", "array<struct<item_id:string, quantity:bigint>>")
    return (ev.select("event_id", F.explode(arr).alias("item"))
              .select("event_id", "item.item_id", "item.quantity"))


@register("cpx16_map_literal", """
SELECT event_id, device AS by_key_device, traffic_source AS by_key_source FROM events_nested""")
def cpx16(spark, d):
    m = F.create_map(F.lit("device"), F.col("device"), F.lit("source"), F.col("traffic_source"))
    ev = fx.events_nested(spark, d).select("event_id", m.alias("m"))
    return ev.select("event_id", F.element_at("m", F.lit("device")).alias("by_key_device"),
                     F.col("m")["source"].alias("by_key_source"))
