"""Derived datasets in the shapes the lesson jobs work on.

Each function builds one dataset from the base parquet tables with plain
DataFrame expressions, so it scales with the tables and is planned by Catalyst
together with the query that reads it (no materialisation, no driver data).
The DuckDB oracle (``quarry.jobs.oracle``) repeats the same expressions.

Small dimension tables (nation: 25 rows, region: 5 rows by the TPC-H
definition) are broadcast explicitly; every other join is left to the planner
(AQE broadcasts only sides it has measured under the threshold).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.tables import table

# Device names by user_id % 4, and the coupon code.
DEVICES = ["macOS", "Windows", "iOS", "Android"]
COUPON = "NEWBED10"
# 100000 patients offset for medical record numbers.
MRN_OFFSET = 100000
# Cut-over years added to order dates to land them after 2021.
ORDER_YEAR_SHIFT = 27


def _geo(spark: SparkSession, d: str) -> DataFrame:
    """nation + region, both bounded by definition (25 and 5 rows)."""
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    return F.broadcast(n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
                       .select("n_nationkey", "n_name", "r_name"))


def _item(k: Column, event_id: Column) -> Column:
    """One cart item derived from an item number ``k`` (0..199)."""
    qty = (event_id % 3 + 1).cast("bigint")
    price = k.cast("double") + F.lit(0.5)
    return F.struct(
        F.when(event_id % 10 == 0, F.lit(COUPON)).alias("coupon"),
        k.cast("string").alias("item_id"),
        F.concat(F.lit("item "), k.cast("string")).alias("item_name"),
        (price * qty).alias("item_revenue_in_usd"),
        price.alias("price_in_usd"),
        qty.alias("quantity"),
    )


def events_nested(spark: SparkSession, d: str) -> DataFrame:
    """Clickstream events with nested ecommerce/geo structs and an items array."""
    e = table(spark, d, "events")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    g = _geo(spark, d)
    j = (e.join(c, e.user_id == c.c_custkey, "left")
          .join(g, F.col("c_nationkey") == g.n_nationkey, "left"))
    purchase = F.col("event_type") == "purchase"
    eid = F.col("event_id")
    k1 = (eid * 7) % 200
    k2 = (eid * 7 + 3) % 200
    n_items = (F.when(purchase, 2)
                .when(F.col("event_type") == "click", 1)
                .otherwise(0))
    return j.select(
        eid.alias("event_id"),
        F.element_at(F.array(*[F.lit(x) for x in DEVICES]),
                     (F.col("user_id") % 4 + 1).cast("int")).alias("device"),
        F.struct(
            F.when(purchase, F.col("value")).alias("purchase_revenue_in_usd"),
            F.when(purchase, F.col("user_id") % 5 + 1).alias("total_item_quantity"),
            F.when(purchase, eid % 3 + 1).alias("unique_items"),
        ).alias("ecommerce"),
        F.col("event_type").alias("event_name"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("event_timestamp"),
        F.struct(F.col("n_name").alias("city"), F.col("r_name").alias("state")).alias("geo"),
        F.slice(F.array(_item(k1, eid), _item(k2, eid)), F.lit(1), n_items).alias("items"),
        F.col("c_mktsegment").alias("traffic_source"),
        F.col("user_id").cast("string").alias("user_id"),
    )


def events_raw(spark: SparkSession, d: str) -> DataFrame:
    """Message-bus envelope: key/value as bytes, value holds the event JSON."""
    ev = events_nested(spark, d)
    payload = F.to_json(F.struct(*[c for c in ev.columns if c != "event_id"]))
    return ev.select(
        F.col("user_id").cast("binary").alias("key"),
        F.col("event_id").alias("offset"),
        (F.col("event_id") % 2).cast("int").alias("partition"),
        (F.col("event_timestamp") / 1000).cast("bigint").alias("timestamp"),
        F.lit("clickstream").alias("topic"),
        payload.cast("binary").alias("value"),
    )


def users(spark: SparkSession, d: str) -> DataFrame:
    """One row per customer; every third customer has no email."""
    c = table(spark, d, "customer")
    email = F.concat(F.lower(F.regexp_replace("c_name", "#", "")), F.lit("@"),
                     F.lower(F.col("c_mktsegment")), F.lit(".com"))
    return c.select(
        F.col("c_custkey").cast("string").alias("user_id"),
        (F.lit(1704067200000000) + F.col("c_custkey") * 60000000).alias("user_first_touch_timestamp"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit(None).cast("string")).otherwise(email).alias("email"),
        F.timestamp_seconds(F.lit(1706745600) + F.col("c_custkey") * 3600)
         .cast("timestamp_ntz").alias("updated"),
    )


def users_dirty(spark: SparkSession, d: str) -> DataFrame:
    """users plus duplicates that lost their email, plus three all-null rows."""
    u = users(spark, d)
    dup = (u.filter(F.col("user_id").cast("bigint") % 4 == 1)
            .withColumn("email", F.lit(None).cast("string"))
            .withColumn("updated", F.lit(None).cast("timestamp_ntz")))
    nulls = (table(spark, d, "region").filter(F.col("r_regionkey") < 3)
             .select(*[F.lit(None).cast(t).alias(n) for n, t in
                       [("user_id", "string"), ("user_first_touch_timestamp", "bigint"),
                        ("email", "string"), ("updated", "timestamp_ntz")]]))
    return u.unionByName(dup).unionByName(nulls)


def item_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Product catalog: id, printed name, price and a category."""
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").cast("string").alias("item_id"),
                    F.col("p_name").alias("name"),
                    F.col("p_retailprice").alias("price"),
                    F.col("p_type").alias("item_type"))


def sales(spark: SparkSession, d: str) -> DataFrame:
    """One row per order with an ``items`` array of structs.

    The line items are aggregated on the order key first; the join with
    ``orders`` then reuses that hash partitioning, and only the per-order rows
    meet the customer table.
    """
    li = table(spark, d, "lineitem")
    p = table(spark, d, "part").select("p_partkey", "p_name")
    o = table(spark, d, "orders")
    u = users(spark, d).select(F.col("user_id").cast("bigint").alias("uid"), "email")
    item = F.struct(
        F.when(F.col("l_discount") > 0.05, F.lit(COUPON)).alias("coupon"),
        F.col("l_partkey").cast("string").alias("item_id"),
        F.col("p_name").alias("item_name"),
        F.col("l_extendedprice").alias("item_revenue_in_usd"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price_in_usd"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    # The distinct item count comes from the collected (per-order, bounded)
    # item array: a count_distinct next to collect_list would make Spark
    # rewrite the aggregate with an Expand and a second aggregation.
    per_order = (li.join(p, li.l_partkey == p.p_partkey)
                   .groupBy("l_orderkey")
                   .agg(F.sum("l_quantity").cast("bigint").alias("total_item_quantity"),
                        F.round(F.sum("l_extendedprice"), 2).alias("purchase_revenue_in_usd"),
                        F.array_sort(F.collect_list(item)).alias("items"))
                   .withColumn("unique_items", F.size(F.array_distinct("items.item_id")).cast("bigint")))
    return (per_order.join(o, per_order.l_orderkey == o.o_orderkey)
            .join(u, F.col("o_custkey") == u.uid, "left")
            .select(F.col("o_orderkey").alias("order_id"), "email",
                    F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("transaction_timestamp"),
                    "total_item_quantity", "purchase_revenue_in_usd", "unique_items", "items"))


def cdc_feed(spark: SparkSession, d: str) -> DataFrame:
    """Customer change feed: signup INSERT, error DELETE, other events UPDATE.

    Deletes carry NULL in every payload column (key, operation and sequence
    stay).  Some rows break the quality rules on purpose (missing name, bad
    email, missing operation).
    """
    e = table(spark, d, "events")
    g = _geo(spark, d)
    op = (F.when(F.col("event_type") == "signup", "INSERT")
           .when(F.col("event_type") == "error", "DELETE")
           .otherwise("UPDATE"))
    eid = F.col("event_id")
    is_del = F.col("operation") == "DELETE"
    base = (e.withColumn("operation", F.when(eid % 97 == 5, F.lit(None).cast("string")).otherwise(op))
             .join(g, (F.col("user_id") % 25).cast("int") == g.n_nationkey, "left"))

    def payload(c: Column) -> Column:
        return F.when(is_del, F.lit(None).cast("string")).otherwise(c)

    return base.select(
        F.col("user_id").alias("customer_id"),
        payload(F.when(eid % 11 == 0, F.lit(None).cast("string"))
                 .otherwise(F.concat(F.lit("user "), F.col("user_id").cast("string")))).alias("name"),
        payload(F.when(eid % 13 == 0, F.concat(F.lit("user"), eid.cast("string"), F.lit("-at-example")))
                 .otherwise(F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("."),
                                     eid.cast("string"), F.lit("@example.com")))).alias("email"),
        payload(F.concat(eid.cast("string"), F.lit(" Main St"))).alias("address"),
        payload(F.col("n_name")).alias("city"),
        payload(F.col("r_name")).alias("state"),
        payload(F.lpad((eid % 100000).cast("string"), 5, "0")).alias("zip_code"),
        F.col("operation"),
        F.col("ts").alias("timestamp"),
    )


def orders_feed(spark: SparkSession, d: str) -> DataFrame:
    """Raw retail order records as a JSON feed would carry them (all text)."""
    o = table(spark, d, "orders")
    ts = F.col("o_orderdate") + F.expr(f"INTERVAL {ORDER_YEAR_SHIFT} YEARS")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("order_timestamp"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderkey") % 2 == 0, "Y").otherwise("N").alias("notifications"),
    )


def status_feed(spark: SparkSession, d: str) -> DataFrame:
    """Order status updates with epoch-second timestamps (some invalid)."""
    o = table(spark, d, "orders")
    ts = F.col("o_orderdate") + F.expr(f"INTERVAL {ORDER_YEAR_SHIFT} YEARS")
    secs = F.unix_seconds(ts.cast("timestamp"))
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.when(F.col("o_orderkey") % 13 == 0, F.lit(0).cast("bigint")).otherwise(secs).alias("status_timestamp"),
    )


def retail_customers(spark: SparkSession, d: str) -> DataFrame:
    """Customer dimension of the retail job (all columns as CSV text would give)."""
    c = table(spark, d, "customer")
    g = _geo(spark, d)
    return (c.join(g, c.c_nationkey == g.n_nationkey, "left")
             .select(F.col("c_custkey").alias("customer_id"),
                     F.col("c_name").alias("customer_name"),
                     F.col("r_name").alias("state"),
                     F.col("n_name").alias("city"),
                     (F.col("c_nationkey") * 1.5 - 60).alias("lon"),
                     (F.col("c_nationkey") * 0.5 + 20).alias("lat"),
                     (F.col("c_custkey") % 50).alias("units_purchased"),
                     (F.col("c_custkey") % 4).cast("int").alias("loyalty_segment")))


def sales_orders_feed(spark: SparkSession, d: str) -> DataFrame:
    """Retail orders with an ordered_products array and epoch-second text time."""
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    prod = F.struct(
        F.when(F.col("l_linenumber") % 3 == 0, "EUR").otherwise("USD").alias("curr"),
        F.col("l_partkey").cast("string").alias("id"),
        F.col("l_extendedprice").cast("bigint").alias("price"),
        F.col("l_quantity").cast("bigint").alias("qty"),
    )
    per_order = (li.groupBy("l_orderkey")
                   .agg(F.count("*").alias("number_of_line_items"),
                        F.array_sort(F.collect_list(prod)).alias("ordered_products")))
    return (per_order.join(o, per_order.l_orderkey == o.o_orderkey)
            .join(c, F.col("o_custkey") == c.c_custkey, "left")
            .select(F.col("o_custkey").alias("customer_id"),
                    F.col("c_name").alias("customer_name"),
                    "number_of_line_items",
                    F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("string").alias("order_datetime"),
                    F.col("o_orderkey").alias("order_number"),
                    "ordered_products"))


def recordings(spark: SparkSession, d: str) -> DataFrame:
    """Device heart-rate recordings; every 17th reading is invalid (negative)."""
    e = table(spark, d, "events")
    return e.select(
        F.col("user_id").cast("string").alias("device_id"),
        (F.col("user_id") + MRN_OFFSET).cast("string").alias("mrn"),
        F.when(F.col("event_id") % 17 == 0, -F.col("value")).otherwise(F.col("value")).alias("heartrate"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1000000).alias("time"),
    )


def pii(spark: SparkSession, d: str) -> DataFrame:
    """Patient identity table: medical record number and name."""
    c = table(spark, d, "customer")
    return c.select((F.col("c_custkey") + MRN_OFFSET).alias("mrn"), F.col("c_name").alias("name"))


def numbered_recordings(spark: SparkSession, d: str) -> DataFrame:
    """The recordings with an id of their own and exact microseconds."""
    e = table(spark, d, "events")
    return e.select("event_id", (F.col("user_id") + MRN_OFFSET).alias("mrn"),
                    F.when(F.col("event_id") % 17 == 0, -F.col("value")).otherwise(F.col("value")).alias("heartrate"),
                    F.unix_micros(F.col("ts").cast("timestamp")).alias("heard_us"))


def registrations(spark: SparkSession, d: str) -> DataFrame:
    """Patients with the time they were registered; every ninth never is."""
    c = table(spark, d, "customer").where("c_custkey % 9 <> 0")
    day = F.col("c_custkey") * 7 % 40
    return c.select((F.col("c_custkey") + MRN_OFFSET).alias("mrn"), F.col("c_name").alias("name"),
                    (F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp")) + day * 86_400_000_000).alias("known_us"))


def user_ping(spark: SparkSession, d: str) -> DataFrame:
    """Ping measurements per user and time."""
    e = table(spark, d, "events")
    return e.select(F.col("user_id").cast("string").alias("user_id"),
                    F.col("value").cast("int").alias("ping"),
                    F.col("ts").alias("time"))


def movies_raw(spark: SparkSession, d: str) -> DataFrame:
    """A CSV-like movie table, all text, with 'NA' for missing budgets."""
    p = table(spark, d, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("_c0"),
        F.col("p_name").alias("title"),
        (F.col("p_partkey") % 30 + 1990).cast("string").alias("year"),
        F.when(F.col("p_partkey") % 7 == 0, F.lit("NA"))
         .otherwise((F.col("p_size") * 1000000).cast("string")).alias("budget"),
        F.concat((F.col("p_size") % 10).cast("string"), F.lit("."),
                 (F.col("p_partkey") % 10).cast("string")).alias("rating"),
    )


def heartrate_device(spark: SparkSession, d: str) -> DataFrame:
    """Device readings with patient names (protected by the SEC views)."""
    e = table(spark, d, "events")
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    return (e.join(c, e.user_id == c.c_custkey)
             .select(F.col("user_id").cast("int").alias("device_id"),
                     (F.col("user_id") + MRN_OFFSET).cast("string").alias("mrn"),
                     F.col("c_name").alias("name"),
                     F.col("ts").alias("time"),
                     F.when(F.col("event_id") % 17 == 0, -F.col("value"))
                      .otherwise(F.col("value")).alias("heartrate")))


FIXTURES = {
    "events_nested": events_nested, "events_raw": events_raw, "users": users,
    "users_dirty": users_dirty, "item_lookup": item_lookup, "sales": sales,
    "cdc_feed": cdc_feed, "orders_feed": orders_feed, "status_feed": status_feed,
    "retail_customers": retail_customers, "sales_orders_feed": sales_orders_feed,
    "recordings": recordings, "pii": pii, "user_ping": user_ping,
    "movies_raw": movies_raw, "heartrate_device": heartrate_device,
}


def register_fixture_views(spark: SparkSession, d: str) -> None:
    """Expose every derived dataset as a temp view (used by SQL-form jobs)."""
    for name, fn in FIXTURES.items():
        fn(spark, d).createOrReplaceTempView(name)
