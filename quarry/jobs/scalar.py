"""Scalar functions: strings, regex, dates, math."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import scalar as S
from quarry.jobs.oracle import sround
from quarry.jobs.registry import register
from quarry.sources import fixtures as fx
from quarry.sources.tables import table

_EMAIL_RE = r"^([a-zA-Z0-9_\-\.]+)@([a-zA-Z0-9_\-\.]+)\.([a-zA-Z]{2,5})$"


@register("fun01_split", """
SELECT customer_id, address,
  string_split(address, ' ')[1] AS house_number,
  split_part(address, ' ', 1) || '|' || substr(address, strpos(address, ' ') + 1) AS split_limit_2,
  CAST(len(string_split(address, ' ')) AS INTEGER) AS n_words
FROM cdc_feed WHERE address IS NOT NULL""")
def fun01(spark, d):
    c = fx.cdc_feed(spark, d).filter(F.col("address").isNotNull())
    return c.select("customer_id", "address",
                    F.element_at(F.split("address", " "), 1).alias("house_number"),
                    F.array_join(F.split("address", " ", 2), "|").alias("split_limit_2"),
                    F.size(F.split("address", " ")).alias("n_words"))


@register("fun02_regexp_extract_domain", """
SELECT user_id, regexp_extract(email, '@(.+)', 1) AS email_domain FROM users WHERE email IS NOT NULL""")
def fun02(spark, d):
    u = fx.users(spark, d).filter(F.col("email").isNotNull())
    return u.select("user_id", S.email_domain("email").alias("email_domain"))


@register("fun03_string_functions", """
SELECT p_partkey, regexp_replace(p_name, '[aeiou]', '_', 'g') AS no_vowels,
  translate(p_brand, '#', '-') AS brand, ltrim('  ' || p_type) AS type_trimmed, lower(p_type) AS type_lower
FROM part""")
def fun03(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", F.regexp_replace("p_name", "[aeiou]", "_").alias("no_vowels"),
                    F.translate("p_brand", "#", "-").alias("brand"),
                    F.ltrim(F.concat(F.lit("  "), F.col("p_type"))).alias("type_trimmed"),
                    F.lower("p_type").alias("type_lower"))


@register("fun04_rlike_valid_email", f"""
SELECT customer_id, timestamp, email, regexp_matches(email, '{_EMAIL_RE}') AS valid_email
FROM cdc_feed WHERE email IS NOT NULL""")
def fun04(spark, d):
    c = fx.cdc_feed(spark, d).filter(F.col("email").isNotNull())
    return c.select("customer_id", "timestamp", "email", S.valid_email("email").alias("valid_email"))


@register("fun05_masking_functions", """
SELECT c_custkey, concat('***', right(c_name, 4)) AS masked,
  repeat('*', length(c_name) - 2) || right(c_name, 2) AS masked_all_but_two, CAST(length(c_name) AS INTEGER) AS name_len
FROM customer""")
def fun05(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey",
                    F.concat(F.lit("***"), F.right("c_name", F.lit(4))).alias("masked"),
                    S.mask_keep_last("c_name", 2).alias("masked_all_but_two"),
                    F.length("c_name").alias("name_len"))


@register("fun06_first_letter", "SELECT item_id, substr(name, 1, 1) AS first_letter FROM item_lookup")
def fun06(spark, d):
    return fx.item_lookup(spark, d).select("item_id", S.first_letter("name").alias("first_letter"))


@register("fun07_epoch_micros_to_timestamp", """
SELECT event_id, make_timestamp(event_timestamp) AS event_time,
  CAST(make_timestamp(event_timestamp) AS DATE) AS event_date
FROM events_nested""")
def fun07(spark, d):
    ev = fx.events_nested(spark, d)
    return ev.select("event_id", S.micros_to_timestamp("event_timestamp").alias("event_time"),
                     (F.col("event_timestamp") / 1e6).cast("timestamp").cast("date").alias("event_date"))


@register("fun08_date_format", """
SELECT event_id, strftime(ts, '%b %-d, %Y') AS date_string, strftime(ts, '%H:%M:%S.%f') AS time_string
FROM events""")
def fun08(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", F.date_format("ts", "MMM d, yyyy").alias("date_string"),
                    F.date_format("ts", "HH:mm:ss.SSSSSS").alias("time_string"))


@register("fun09_date_parts", """
SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
  CAST(dayofweek(ts) + 1 AS INTEGER) AS dayofweek, CAST(minute(ts) AS INTEGER) AS minute,
  CAST(second(ts) AS INTEGER) AS second
FROM events""")
def fun09(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", F.year("ts").alias("year"), F.month("ts").alias("month"),
                    F.dayofweek("ts").alias("dayofweek"), F.minute("ts").alias("minute"),
                    F.second("ts").alias("second"))


@register("fun10_to_date", "SELECT order_id, CAST(CAST(order_timestamp AS TIMESTAMP) AS DATE) AS order_date FROM orders_feed")
def fun10(spark, d):
    return fx.orders_feed(spark, d).select("order_id", F.to_date("order_timestamp").alias("order_date"))


@register("fun11_date_add", "SELECT event_id, CAST(ts AS DATE) + 2 AS plus_two_days FROM events")
def fun11(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", F.date_add(F.col("ts").cast("date"), 2).alias("plus_two_days"))


@register("fun12_more_datetime", """
SELECT o_orderkey,
  CAST(o_orderdate + INTERVAL 3 MONTH AS DATE) AS plus_3_months,
  strftime(make_timestamp((epoch_us(o_orderdate) // 1000000 + 3600) * 1000000), '%Y-%m-%d %H:%M:%S') AS from_unix,
  epoch_us(o_orderdate) // 1000000 AS unix_ts,
  CAST(strftime(o_orderdate, '%Y-%m-%d') || ' 12:30:00' AS TIMESTAMP) AS parsed_ts
FROM orders""")
def fun12(spark, d):
    o = table(spark, d, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return o.select(
        "o_orderkey",
        F.add_months(F.col("o_orderdate").cast("date"), 3).alias("plus_3_months"),
        F.from_unixtime(F.unix_timestamp(day, "yyyy-MM-dd") + 3600).alias("from_unix"),
        F.unix_timestamp(day, "yyyy-MM-dd").alias("unix_ts"),
        F.to_timestamp(F.concat(day, F.lit(" 12:30:00"))).cast("timestamp_ntz").alias("parsed_ts"))


@register("fun13_from_unixtime_seconds", """
SELECT order_number,
  make_timestamp(CAST(order_datetime AS BIGINT) * 1000000) AS order_datetime,
  CAST(make_timestamp(CAST(order_datetime AS BIGINT) * 1000000) AS DATE) AS order_date
FROM sales_orders_feed""")
def fun13(spark, d):
    f = fx.sales_orders_feed(spark, d)
    ts = F.from_unixtime(F.col("order_datetime").cast("long"))
    return f.select("order_number", F.to_timestamp_ntz(ts).alias("order_datetime"),
                    F.to_date(ts).alias("order_date"))


@register("fun14_date_trunc_day", """
SELECT date_trunc('day', time) AS day, count(*) AS readings FROM heartrate_device GROUP BY 1""")
def fun14(spark, d):
    h = fx.heartrate_device(spark, d)
    return (h.groupBy(F.date_trunc("DD", "time").cast("timestamp_ntz").alias("day"))
             .agg(F.count(F.lit(1)).alias("readings")))


@register("fun15_current_timestamp")
def fun15(spark, d):
    """Load-time stamp per row (time dependent: rows-only)."""
    return table(spark, d, "orders").select("o_orderkey", F.current_timestamp().alias("processing_time"))


@register("fun16_sqrt_cos", f"""
SELECT event_id, {sround('sqrt(value)', 6)} AS sqrt_value, {sround('cos(CAST(user_id AS DOUBLE))', 6)} AS cos_user
FROM events""")
def fun16(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", F.round(F.sqrt("value"), 6).alias("sqrt_value"),
                    F.round(F.cos(F.col("user_id").cast("double")), 6).alias("cos_user"))


@register("fun17_ceil_log_round", f"""
SELECT event_id, CAST(ceil(value) AS BIGINT) AS ceil_value, {sround('ln(value)', 6)} AS log_value,
  {sround('value * 1.5', 1)} AS rounded
FROM events""")
def fun17(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", F.ceil("value").alias("ceil_value"),
                    F.round(F.log("value"), 6).alias("log_value"),
                    F.round(F.col("value") * 1.5, 1).alias("rounded"))


@register("fun18_truncate_two_decimals", """
SELECT traffic_source, CAST(trunc(avg(ecommerce.purchase_revenue_in_usd) * 100) AS BIGINT) / 100 AS avg_rev_cut
FROM events_nested GROUP BY traffic_source""")
def fun18(spark, d):
    ev = fx.events_nested(spark, d)
    return (ev.groupBy("traffic_source")
              .agg(F.avg("ecommerce.purchase_revenue_in_usd").alias("a"))
              .select("traffic_source", S.truncate_decimals("a", 2).alias("avg_rev_cut")))


@register("fun19_rand")
def fun19(spark, d):
    """Random ping and active flag per event (seeded, still random: rows-only)."""
    e = table(spark, d, "events")
    return e.select("event_id", (F.rand(seed=7) * 100).cast("int").alias("ping"),
                    (F.rand(seed=11) < 0.5).alias("active"))


@register("fun20_isnull_col", """
SELECT user_id, email IS NULL AS email_missing FROM users_dirty""")
def fun20(spark, d):
    u = fx.users_dirty(spark, d)
    return u.select(F.column("user_id"), F.isnull(F.col("email")).alias("email_missing"))
