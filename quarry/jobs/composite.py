"""End-to-end lesson jobs built from the operator modules."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quarry.functions import scalar as S
from quarry.jobs.aggregates import EVENT_NAMES, ITEM_TYPES
from quarry.jobs.oracle import sround
from quarry.jobs.projection import DEDUPED_SQL
from quarry.jobs.registry import register
from quarry.operators import clean, shape
from quarry.sources import fixtures as fx
from quarry.sources.tables import table


REVENUE = "ecommerce.purchase_revenue_in_usd"


@register("job01_purchase_revenue", """
SELECT event_id, device, event_timestamp, traffic_source, user_id,
       ecommerce.purchase_revenue_in_usd AS revenue
FROM events_nested WHERE ecommerce.purchase_revenue_in_usd IS NOT NULL""")
def job01(spark, d):
    """Purchases: the events that carry a revenue."""
    return fx.events_nested(spark, d).where(F.col(REVENUE).isNotNull()).select(
        "event_id", "device", "event_timestamp", "traffic_source", "user_id", F.col(REVENUE).alias("revenue"))


@register("job02_top_traffic_sources", f"""
SELECT traffic_source, {sround('total_rev', 2)} AS total_rev, {sround('avg_rev', 2)} AS avg_rev
FROM (SELECT traffic_source, sum(ecommerce.purchase_revenue_in_usd) AS total_rev,
             avg(ecommerce.purchase_revenue_in_usd) AS avg_rev
      FROM events_nested WHERE ecommerce.purchase_revenue_in_usd IS NOT NULL
      GROUP BY traffic_source
      ORDER BY total_rev DESC, traffic_source LIMIT 3)""")
def job02(spark, d):
    """Top three traffic sources by revenue, rounded to cents.

    Only two columns leave the scan; partial sums shuffle one row per source
    and task, and the top three are taken per partition, without a global sort.
    """
    per_source = (fx.events_nested(spark, d).where(F.col(REVENUE).isNotNull()).groupBy("traffic_source")
                  .agg(F.sum(REVENUE).alias("total"), F.avg(REVENUE).alias("mean")))
    best = per_source.orderBy(F.desc("total"), "traffic_source").limit(3)
    return best.select("traffic_source", F.round("total", 2).alias("total_rev"), F.round("mean", 2).alias("avg_rev"))


# ---- JOB03: user cleaning -------------------------------------------------

@register("job03_user_cleaning", """
SELECT user_id, user_first_touch_timestamp, email, updated, first_touch,
  strftime(first_touch, '%b %-d, %Y') AS first_touch_date,
  strftime(first_touch, '%H:%M:%S') AS first_touch_time,
  regexp_extract(email, '@(.+)', 1) AS email_domain
FROM (SELECT *, make_timestamp(user_first_touch_timestamp) AS first_touch FROM (""" + DEDUPED_SQL + """))""")
def job03(spark, d):
    """De-duplicate users, split the first-touch time, extract the email domain."""
    people = clean.dedupe_keep_max(fx.users_dirty(spark, d), ["user_id", "user_first_touch_timestamp"])
    touched = F.timestamp_micros("user_first_touch_timestamp").cast("timestamp_ntz")
    shown = {name: F.date_format(touched, form) for name, form in (("first_touch_date", "MMM d, yyyy"), ("first_touch_time", "HH:mm:ss"))}
    return people.select("user_id", "user_first_touch_timestamp", "email", "updated", touched.alias("first_touch"),
                         *[c.alias(name) for name, c in shown.items()], S.email_domain("email").alias("email_domain"))


# ---- JOB04: event parsing -------------------------------------------------

@register("job04_event_parsing", """
SELECT e.user_id AS key, e.event_id AS "offset", e.device, e.event_name, e.event_timestamp,
  e.geo.city AS city, item.item_id AS item_id, item.quantity AS quantity, CAST(len(e.items) AS INTEGER) AS n_items
FROM (SELECT *, unnest(items) AS item FROM events_nested) e""")
def job04(spark, d):
    """Binary envelope -> text -> JSON struct -> columns -> one row per item."""
    raw = shape.decode_envelope(fx.events_raw(spark, d))
    schema = fx.events_nested(spark, d).drop("event_id").schema
    parsed = (raw.select("key", "offset", F.from_json("value", schema).alias("json"))
                 .select("key", "offset", "json.*"))
    return (parsed.withColumn("item", F.explode("items"))
                  .select("key", "offset", "device", "event_name", "event_timestamp",
                          F.col("geo.city").alias("city"), F.col("item.item_id").alias("item_id"),
                          F.col("item.quantity").alias("quantity"), F.size("items").alias("n_items")))


# ---- JOB05: cart and event history ------------------------------------------

@register("job05_cart_event_history", """
SELECT user_id,
  array_to_string(list_sort(list(DISTINCT event_name)), ',') AS event_history,
  array_to_string(list_sort(list_distinct(flatten(list(list_transform(items, lambda i: i.item_id))))), ',') AS cart_history
FROM (SELECT *, unnest(items) AS item FROM events_nested) GROUP BY user_id""")
def job05(spark, d):
    """Histories of the users that ever had an item."""
    return shape.event_and_cart_history(fx.events_nested(spark, d).where(F.size("items") > 0))


# ---- JOB06: item purchases pivot ------------------------------------------

@register("job06_item_purchase_pivot", """
SELECT order_id, email, transaction_timestamp, total_item_quantity,
""" + ",\n".join(f"  CAST(sum(quantity) FILTER (WHERE item_type = '{t}') AS BIGINT) AS {t}" for t in ITEM_TYPES) + """
FROM (SELECT s.order_id, s.email, s.transaction_timestamp, s.total_item_quantity,
             s.item.quantity AS quantity, b.item_type
      FROM (SELECT *, unnest(items) AS item FROM sales) s
      JOIN item_lookup b ON s.item.item_id = b.item_id)
GROUP BY order_id, email, transaction_timestamp, total_item_quantity""")
def job06(spark, d):
    """Explode sales, join the catalog on the nested item id, pivot by category."""
    s = fx.sales(spark, d).withColumn("item", F.explode("items"))
    b = fx.item_lookup(spark, d)
    purchases = s.join(b, s.item.item_id == b.item_id).withColumn("quantity", F.col("item.quantity"))
    return shape.pivot_sum(purchases, ["order_id", "email", "transaction_timestamp", "total_item_quantity"],
                           "item_type", ITEM_TYPES, "quantity")


# ---- JOB07: click paths -----------------------------------------------------

TRANSACTIONS_SQL = """
SELECT u.user_id, t.order_id,
""" + ",\n".join(f"  CAST(sum(t.quantity) FILTER (WHERE t.item_type = '{x}') AS BIGINT) AS {x}" for x in ITEM_TYPES) + """
FROM (SELECT s.order_id, s.email, s.item.quantity AS quantity, b.item_type
      FROM (SELECT *, unnest(items) AS item FROM sales) s
      JOIN item_lookup b ON s.item.item_id = b.item_id) t
JOIN users u ON t.email = u.email
GROUP BY u.user_id, t.order_id"""


def transactions(spark, d):
    """Per order: the buyer's user_id and purchased quantity per category."""
    from quarry.jobs.joins import item_purchases
    ip = item_purchases(spark, d)
    u = fx.users(spark, d).select("user_id", "email")
    return shape.pivot_sum(ip.join(u, "email"), ["user_id", "order_id"], "item_type", ITEM_TYPES, "quantity")


@register("job07_click_paths", """
SELECT a.*, b.* EXCLUDE (user_id) FROM (
  SELECT user_id AS user,
""" + ",\n".join(f"    nullif(count(*) FILTER (WHERE event_name = '{n}'), 0) AS {n}" for n in EVENT_NAMES) + """
  FROM events_nested GROUP BY user_id) a
JOIN (""" + TRANSACTIONS_SQL + """) b ON a.user = b.user_id""")
def job07(spark, d):
    """Event counts per user (pivot) joined with that user's transactions."""
    ev = fx.events_nested(spark, d).select(F.col("user_id").alias("user"), "event_name")
    pivot = shape.pivot_count(ev, ["user"], "event_name", EVENT_NAMES)
    t = transactions(spark, d)
    return pivot.join(t, pivot.user == t.user_id).drop("user_id")


# ---- JOB08: sizes per email -------------------------------------------------

@register("job08_kinds_per_email", """
SELECT email, array_to_string(list_sort(list(DISTINCT string_split(item_name, ' ')[1])), ',') AS kinds
FROM (SELECT email, unnest(items).item_name AS item_name FROM sales)
WHERE list_contains(string_split(item_name, ' '), 'widget')
GROUP BY email""")
def job08(spark, d):
    """First words of the 'widget' items of each buyer, picked inside every order before its items become rows."""
    widgets = F.filter("items.item_name", lambda name: name.rlike("(^| )widget( |$)"))
    first_words = F.array_distinct(F.transform(widgets, lambda name: F.substring_index(name, " ", 1)))
    bought = fx.sales(spark, d).select("email", F.explode(first_words).alias("kind"))
    return bought.groupBy("email").agg(F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds"))


# ---- JOB09: abandoned carts -------------------------------------------------

CONVERSIONS_SQL = """
SELECT coalesce(u.email, c.email) AS email, u.user_id, u.user_first_touch_timestamp, u.updated,
       coalesce(c.converted, false) AS converted
FROM users u FULL OUTER JOIN (SELECT DISTINCT email, true AS converted FROM sales) c ON u.email = c.email
WHERE coalesce(u.email, c.email) IS NOT NULL"""

CARTS_SQL = """
SELECT user_id, list(DISTINCT item.item_id) AS cart
FROM (SELECT user_id, unnest(items) AS item FROM events_nested) GROUP BY user_id"""


def conversions(spark, d):
    """Everyone with an e-mail address and whether they bought; buyers unknown to ``users`` included.

    Rows without an address are left out on both sides before the outer join:
    they would all meet in one task, and none of them is in the result.
    """
    known = F.col("email").isNotNull()
    buyers = fx.sales(spark, d).where(known).groupBy("email").agg(F.lit(True).alias("bought"))
    people = fx.users(spark, d).where(known)
    return (people.join(buyers, "email", "full")
            .withColumn("converted", F.coalesce("bought", F.lit(False))).drop("bought"))


def cart_items(spark, d):
    """Distinct (user_id, item_id) pairs: what each user ever put into a cart."""
    return fx.events_nested(spark, d).select("user_id", F.explode("items.item_id").alias("item_id")).distinct()


@register("job09_conversions", CONVERSIONS_SQL)
def job09_conversions(spark, d):
    return conversions(spark, d)


@register("job09_email_carts", """
SELECT v.email, v.user_id, v.converted, array_to_string(list_sort(c.cart), ',') AS cart
FROM (""" + CONVERSIONS_SQL + """) v LEFT JOIN (""" + CARTS_SQL + """) c ON v.user_id = c.user_id""")
def job09_email_carts(spark, d):
    per_user = cart_items(spark, d).groupBy("user_id").agg(
        F.array_join(F.sort_array(F.collect_list("item_id")), ",").alias("cart"))
    return conversions(spark, d).join(per_user, "user_id", "left").select("email", "user_id", "converted", "cart")


@register("job09_abandoned_items", """
SELECT items, count(*) AS count FROM (
  SELECT unnest(c.cart) AS items
  FROM (""" + CONVERSIONS_SQL + """) v JOIN (""" + CARTS_SQL + """) c ON v.user_id = c.user_id
  WHERE v.converted = false)
GROUP BY items ORDER BY items""")
def job09_abandoned_items(spark, d):
    """Items left in carts of users who never bought, with counts."""
    never = conversions(spark, d).where(~F.col("converted")).select("user_id")
    return (cart_items(spark, d).join(never, "user_id").groupBy(F.col("item_id").alias("items"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy("items"))


# ---- JOB16-18: ping reports -------------------------------------------------

@register("job16_record_counts", """
SELECT user_id, count(*) AS total_records FROM user_ping GROUP BY user_id
ORDER BY total_records DESC, user_id ASC""")
def job16(spark, d):
    return (fx.user_ping(spark, d).groupBy("user_id").agg(F.count(F.lit(1)).alias("total_records"))
            .orderBy(F.col("total_records").desc(), F.col("user_id").asc()))


@register("job17_avg_ping_window", f"""
SELECT user_id, time_bucket(INTERVAL 3 MINUTE, time) + INTERVAL 3 MINUTE AS end_time,
       {sround('avg(ping)', 6)} AS avg_ping
FROM user_ping GROUP BY user_id, time_bucket(INTERVAL 3 MINUTE, time)
ORDER BY end_time DESC, user_id ASC""")
def job17(spark, d):
    return (fx.user_ping(spark, d).groupBy("user_id", F.window("time", "3 minutes"))
            .agg(F.round(F.mean("ping"), 6).alias("avg_ping"))
            .select("user_id", F.col("window.end").alias("end_time"), "avg_ping")
            .orderBy(F.col("end_time").desc(), F.col("user_id").asc()))


@register("job18_user_summary", f"""
SELECT user_id, min(time) AS first_seen, max(time) AS last_seen, count(*) AS total_records,
       {sround('avg(ping)', 6)} AS total_avg_ping
FROM user_ping GROUP BY user_id ORDER BY user_id""")
def job18(spark, d):
    return (fx.user_ping(spark, d).groupBy("user_id")
            .agg(F.min("time").alias("first_seen"), F.max("time").alias("last_seen"),
                 F.count(F.lit(1)).alias("total_records"),
                 F.round(F.avg("ping"), 6).alias("total_avg_ping"))
            .orderBy("user_id"))


# ---- JOB19: movie table clean-up --------------------------------------------

@register("job19_movie_cleanup", """
SELECT _c0 AS idx, title, CAST(year AS INTEGER) AS year,
  CASE WHEN budget = 'NA' THEN 0 ELSE CAST(budget AS INTEGER) END AS budget,
  CAST(rating AS DOUBLE) AS rating
FROM movies_raw""")
def job19(spark, d):
    return clean_movies(fx.movies_raw(spark, d))


def clean_movies(raw):
    """Rename ``_c0``, cast text columns, map the 'NA' budget to 0 (ANSI-safe)."""
    return raw.select(
        F.col("_c0").alias("idx"), "title",
        F.col("year").cast("int").alias("year"),
        F.when(F.col("budget") == "NA", F.lit(0)).otherwise(F.expr("try_cast(budget AS INT)")).alias("budget"),
        F.col("rating").cast("double").alias("rating"))


# ---- JOB21-22: dashboard queries over the TPC-H tables -------------------

@register("job21_available_quantity_per_part", """
SELECT l_partkey, sum(l_quantity) AS available_quantity FROM lineitem GROUP BY l_partkey""")
def job21(spark, d):
    li = table(spark, d, "lineitem")
    return li.groupBy("l_partkey").agg(F.sum("l_quantity").alias("available_quantity"))


@register("job22_total_price_by_date_priority", f"""
SELECT o_orderdate, o_orderpriority, {sround('sum(o_totalprice)', 2)} AS total_price, count(*) AS orders
FROM orders GROUP BY o_orderdate, o_orderpriority""")
def job22(spark, d):
    o = table(spark, d, "orders")
    return (o.groupBy("o_orderdate", "o_orderpriority")
             .agg(F.round(F.sum("o_totalprice"), 2).alias("total_price"), F.count(F.lit(1)).alias("orders")))
