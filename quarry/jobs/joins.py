"""Equi-joins.

Strategy is Catalyst's: sort-merge on both keys by default, broadcast only
when AQE has measured a side under ``autoBroadcastJoinThreshold``, and AQE's
skew-join split for a hot key.  Nothing here forces a broadcast of a side
whose size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.jobs.registry import register
from quarry.sources import fixtures as fx

_ITEM_PURCHASES_SQL = """
SELECT s.order_id, s.email, s.item.item_id AS item_id, s.item.quantity AS quantity,
       b.name, b.price, b.item_type
FROM (SELECT order_id, email, unnest(items) AS item FROM sales) s
JOIN item_lookup b ON s.item.item_id = b.item_id"""


def item_purchases(spark, d):
    """Exploded sales lines joined to the product catalog on a nested key."""
    s = fx.sales(spark, d).select("order_id", "email", F.explode("items").alias("item"))
    b = fx.item_lookup(spark, d)
    return (s.join(b, s.item.item_id == b.item_id)
             .select("order_id", "email", b.item_id,
                     F.col("item.quantity").alias("quantity"), "name", "price", "item_type"))


@register("joi01_join_nested_key", _ITEM_PURCHASES_SQL)
def joi01(spark, d):
    return item_purchases(spark, d)


@register("joi02_join_shared_name", """
SELECT s.email, s.order_id, u.user_id FROM sales s JOIN users u USING (email)""")
def joi02(spark, d):
    s = fx.sales(spark, d).select("email", "order_id")
    u = fx.users(spark, d).select("email", "user_id")
    return s.join(u, "email")


@register("joi03_join_several_names", """
SELECT u.user_id, u.user_first_touch_timestamp, u.email, d.email AS dirty_email
FROM users u JOIN users_dirty d USING (user_id, user_first_touch_timestamp)""")
def joi03(spark, d):
    u = fx.users(spark, d).select("user_id", "user_first_touch_timestamp", "email")
    dd = fx.users_dirty(spark, d).select("user_id", "user_first_touch_timestamp",
                                         F.col("email").alias("dirty_email"))
    return u.join(dd, ["user_id", "user_first_touch_timestamp"])


@register("joi04_full_outer", """
SELECT coalesce(u.email, s.email) AS email, u.user_id, s.orders
FROM (SELECT email, user_id FROM users WHERE email IS NOT NULL) u
FULL OUTER JOIN (SELECT email, count(*) AS orders FROM sales WHERE email IS NOT NULL GROUP BY email) s
ON u.email = s.email""")
def joi04(spark, d):
    u = fx.users(spark, d).filter(F.col("email").isNotNull()).select("email", "user_id")
    s = (fx.sales(spark, d).filter(F.col("email").isNotNull())
         .groupBy("email").agg(F.count(F.lit(1)).alias("orders")))
    return u.join(s, "email", "outer").select("email", "user_id", "orders")


@register("joi05_left_outer", """
SELECT u.user_id, u.email, s.order_id
FROM users u LEFT JOIN sales s ON u.email = s.email""")
def joi05(spark, d):
    u = fx.users(spark, d).select("user_id", "email")
    s = fx.sales(spark, d).select(F.col("email").alias("s_email"), "order_id")
    return u.join(s, u.email == s.s_email, "left").select("user_id", "email", "order_id")


@register("joi06_left_join_composite_key", """
SELECT f.order_number, f.customer_id, f.customer_name, c.city, c.state
FROM sales_orders_feed f LEFT JOIN retail_customers c
  ON c.customer_id = f.customer_id AND c.customer_name = f.customer_name""")
def joi06(spark, d):
    f = fx.sales_orders_feed(spark, d).select("order_number", "customer_id", "customer_name")
    c = fx.retail_customers(spark, d).select(
        F.col("customer_id").alias("c_id"), F.col("customer_name").alias("c_name"), "city", "state")
    return (f.join(c, (c.c_id == f.customer_id) & (c.c_name == f.customer_name), "left")
             .select("order_number", "customer_id", "customer_name", "city", "state"))


@register("joi07_right_join", """
SELECT s.order_id, u.user_id, u.email FROM sales s RIGHT JOIN users u ON s.email = u.email""")
def joi07_right(spark, d):
    s = fx.sales(spark, d).select("order_id", F.col("email").alias("s_email"))
    u = fx.users(spark, d).select("user_id", "email")
    return s.join(u, s.s_email == u.email, "right").select("order_id", "user_id", "email")


@register("joi07_semi_join", """
SELECT user_id, email FROM users u WHERE EXISTS (SELECT 1 FROM sales s WHERE s.email = u.email)""")
def joi07_semi(spark, d):
    u = fx.users(spark, d).select("user_id", "email")
    s = fx.sales(spark, d).select("email")
    return u.join(s, "email", "left_semi")


@register("joi07_anti_join", """
SELECT user_id, email FROM users u WHERE NOT EXISTS (SELECT 1 FROM sales s WHERE s.email = u.email)""")
def joi07_anti(spark, d):
    u = fx.users(spark, d).select("user_id", "email")
    s = fx.sales(spark, d).select("email")
    return u.join(s, "email", "left_anti")


@register("joi08_aliased_sides_filter", """
SELECT a.*, b.email
FROM orders_feed a JOIN users b ON a.customer_id = CAST(b.user_id AS BIGINT)
WHERE a.notifications = 'Y'""")
def joi08(spark, d):
    a = fx.orders_feed(spark, d).alias("a")
    b = fx.users(spark, d).alias("b")
    return (a.join(b, F.col("a.customer_id") == F.col("b.user_id").cast("bigint"))
             .where(F.col("a.notifications") == "Y")
             .select("a.*", "b.email"))
