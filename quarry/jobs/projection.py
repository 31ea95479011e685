"""Projection, predicates, null handling, de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.jobs.registry import register
from quarry.operators import clean
from quarry.sources import fixtures as fx

_FLAT = ["event_id", "device", "event_name", "event_timestamp", "traffic_source", "user_id"]
_FLAT_SQL = ", ".join(_FLAT)


@register("prj01_select", "SELECT user_id, event_name, device FROM events_nested")
def prj01(spark, d):
    return fx.events_nested(spark, d).select("user_id", "event_name", "device")


@register("prj02_nested_field_alias", """
SELECT user_id, geo.city AS city, geo.state AS state,
       ecommerce.purchase_revenue_in_usd AS revenue FROM events_nested""")
def prj02(spark, d):
    return fx.events_nested(spark, d).select(
        "user_id", F.col("geo.city").alias("city"), F.col("geo.state").alias("state"),
        F.col("ecommerce.purchase_revenue_in_usd").alias("revenue"))


@register("prj03_select_expr", """
SELECT user_id, device IN ('macOS', 'iOS') AS apple_user FROM events_nested""")
def prj03(spark, d):
    return fx.events_nested(spark, d).selectExpr("user_id", "device in ('macOS', 'iOS') as apple_user")


@register("prj04_column_arithmetic", """
SELECT event_id, user_id,
       ecommerce.purchase_revenue_in_usd * 100 AS revenue_cents,
       ecommerce.total_item_quantity * 2 + 1 AS qty_expr,
       event_timestamp // 1000000 AS event_seconds
FROM events_nested ORDER BY qty_expr DESC, event_id""")
def prj04(spark, d):
    ev = fx.events_nested(spark, d)
    return (ev.select(ev.event_id, ev["user_id"],
                      (F.col("ecommerce.purchase_revenue_in_usd") * 100).alias("revenue_cents"),
                      (ev.ecommerce.total_item_quantity * 2 + 1).alias("qty_expr"),
                      F.floor(F.col("event_timestamp") / 1000000).cast("bigint").alias("event_seconds"))
              .sort(F.col("qty_expr").desc(), "event_id"))


@register("prj05_with_column", """
SELECT event_id, device IN ('iOS', 'Android') AS mobile,
       CAST(ecommerce.total_item_quantity AS INTEGER) AS purchase_quantity,
       CAST(event_id AS VARCHAR) AS event_id_text
FROM events_nested""")
def prj05(spark, d):
    return (fx.events_nested(spark, d)
            .withColumn("mobile", F.col("device").isin("iOS", "Android"))
            .withColumn("purchase_quantity", F.col("ecommerce.total_item_quantity").cast("int"))
            .withColumn("event_id_text", F.col("event_id").cast("string"))
            .select("event_id", "mobile", "purchase_quantity", "event_id_text"))


@register("prj06_rename", "SELECT event_id, device AS platform, event_name AS action FROM events_nested")
def prj06(spark, d):
    return (fx.events_nested(spark, d).select("event_id", "device", "event_name")
            .withColumnRenamed("device", "platform")
            .withColumnsRenamed({"event_name": "action"}))


@register("prj07_drop_columns", f"SELECT event_id, event_name, event_timestamp, traffic_source, user_id FROM events_nested")
def prj07(spark, d):
    return (fx.events_nested(spark, d).drop("items")
            .drop("geo", "ecommerce", "device"))


@register("prj08_star_except", f"SELECT * EXCLUDE (items, geo, ecommerce) FROM events_nested")
def prj08(spark, d):
    fx.events_nested(spark, d).createOrReplaceTempView("events_nested")
    return spark.sql("SELECT * EXCEPT (items, geo, ecommerce) FROM events_nested")


@register("prj09_struct_star", "SELECT user_id, geo.city AS city, geo.state AS state, ecommerce.* FROM events_nested")
def prj09(spark, d):
    return fx.events_nested(spark, d).select("user_id", "geo.*", "ecommerce.*")


@register("prj10_literal_column", "SELECT event_id, 'web' AS source, 1 AS version FROM events_nested")
def prj10(spark, d):
    return fx.events_nested(spark, d).select("event_id", F.lit("web").alias("source"),
                                              F.lit(1).alias("version"))


@register("prj11_casts", """
SELECT event_id, CAST(user_id AS INTEGER) AS user_int, CAST(event_timestamp AS VARCHAR) AS ts_text,
  make_timestamp(event_timestamp) AS event_time,
  CAST(make_timestamp(event_timestamp) AS DATE) AS event_date,
  CAST(trunc(ecommerce.purchase_revenue_in_usd) AS BIGINT) AS revenue_long
FROM events_nested""")
def prj11(spark, d):
    ev = fx.events_nested(spark, d)
    t = F.timestamp_micros("event_timestamp").cast("timestamp_ntz")
    return ev.select("event_id", F.col("user_id").cast("int").alias("user_int"),
                     F.col("event_timestamp").cast("string").alias("ts_text"),
                     t.alias("event_time"), t.cast("date").alias("event_date"),
                     F.col("ecommerce.purchase_revenue_in_usd").cast("long").alias("revenue_long"))


@register("prj12_case_when", """
SELECT item_id, name,
  CASE WHEN price >= 1800 THEN 'premium'
       WHEN price >= 1200 THEN 'standard'
       ELSE 'basic' END AS tier
FROM item_lookup""")
def prj12(spark, d):
    return fx.item_lookup(spark, d).select(
        "item_id", "name",
        F.when(F.col("price") >= 1800, "premium")
         .when(F.col("price") >= 1200, "standard")
         .otherwise("basic").alias("tier"))


@register("prj13_filter_sql_string", f"""
SELECT {_FLAT_SQL} FROM events_nested
WHERE ecommerce.total_item_quantity > 3 AND event_name = 'purchase'""")
def prj13(spark, d):
    return (fx.events_nested(spark, d)
            .filter("ecommerce.total_item_quantity > 3 and event_name = 'purchase'")
            .select(*_FLAT))


@register("prj14_boolean_predicates", f"""
SELECT {_FLAT_SQL} FROM events_nested
WHERE (traffic_source <> 'BUILDING' AND device = 'macOS') OR NOT (event_name <> 'signup')""")
def prj14(spark, d):
    c = F.col
    return (fx.events_nested(spark, d)
            .filter(((c("traffic_source") != "BUILDING") & (c("device") == "macOS"))
                    | ~(c("event_name") != "signup"))
            .select(*_FLAT))


@register("prj15_isin", f"SELECT {_FLAT_SQL} FROM events_nested WHERE event_name IN ('purchase', 'signup')")
def prj15(spark, d):
    return (fx.events_nested(spark, d).filter(F.col("event_name").isin("purchase", "signup"))
            .select(*_FLAT))


@register("prj16_like_endswith", """
SELECT user_id, email FROM users
WHERE email LIKE '%@building.com' OR (email LIKE 'customer%' AND suffix(email, '0@household.com'))""")
def prj16(spark, d):
    e = F.col("email")
    return (fx.users(spark, d)
            .filter(e.like("%@building.com") | (e.startswith("customer") & e.endswith("0@household.com")))
            .select("user_id", "email"))


@register("prj17_is_null", """
SELECT user_id, user_first_touch_timestamp, email IS NULL AS missing_email
FROM users_dirty WHERE user_id IS NOT NULL AND updated IS NULL""")
def prj17(spark, d):
    return (fx.users_dirty(spark, d)
            .filter(F.col("user_id").isNotNull() & F.col("updated").isNull())
            .select("user_id", "user_first_touch_timestamp", F.col("email").isNull().alias("missing_email")))


@register("prj18_isnan", """
SELECT CAST(count_if(isnan(ratio)) AS BIGINT) AS nan_rows, CAST(count_if(NOT isnan(ratio)) AS BIGINT) AS number_rows
FROM (SELECT CASE WHEN event_type = 'error' THEN CAST('NaN' AS DOUBLE) ELSE value END AS ratio FROM events)""")
def prj18(spark, d):
    from quarry.sources.tables import table
    ev = table(spark, d, "events")
    r = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return (ev.select(r.alias("ratio"))
              .agg(F.count_if(F.isnan("ratio")).alias("nan_rows"),
                   F.count_if(~F.isnan("ratio")).alias("number_rows")))


@register("prj19_conditional_predicate", f"""
SELECT {_FLAT_SQL} FROM events_nested
WHERE CASE WHEN traffic_source = 'BUILDING' THEN ecommerce.purchase_revenue_in_usd > 100 ELSE TRUE END""")
def prj19(spark, d):
    c = F.col
    return (fx.events_nested(spark, d)
            .filter(F.when(c("traffic_source") == "BUILDING", c("ecommerce.purchase_revenue_in_usd") > 100)
                     .otherwise(True))
            .select(*_FLAT))


# ---- null handling -------------------------------------------------------

@register("nul01_drop_any", "SELECT * FROM users_dirty WHERE user_id IS NOT NULL AND user_first_touch_timestamp IS NOT NULL AND email IS NOT NULL AND updated IS NOT NULL")
def nul01_any(spark, d):
    return fx.users_dirty(spark, d).na.drop(how="any")


@register("nul01_drop_all", "SELECT * FROM users_dirty WHERE NOT (user_id IS NULL AND user_first_touch_timestamp IS NULL AND email IS NULL AND updated IS NULL)")
def nul01_all(spark, d):
    return fx.users_dirty(spark, d).na.drop(how="all")


@register("nul01_drop_thresh_subset", """
SELECT * FROM users_dirty
WHERE (CASE WHEN user_id IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN email IS NOT NULL THEN 1 ELSE 0 END
       + CASE WHEN updated IS NOT NULL THEN 1 ELSE 0 END) >= 2""")
def nul01_thresh(spark, d):
    return fx.users_dirty(spark, d).na.drop(thresh=2, subset=["user_id", "email", "updated"])


@register("nul02_fill", """
SELECT user_id, coalesce(email, 'unknown') AS email,
       coalesce(CASE WHEN email IS NOT NULL THEN true END, false) AS has_email
FROM users_dirty""")
def nul02(spark, d):
    u = fx.users_dirty(spark, d).select(
        "user_id", "email", F.when(F.col("email").isNotNull(), F.lit(True)).alias("has_email"))
    return u.na.fill("unknown", subset=["email"]).na.fill(False, subset=["has_email"])


@register("nul03_replace", """
SELECT _c0, title, CASE WHEN budget = 'NA' THEN '0' ELSE budget END AS budget FROM movies_raw""")
def nul03(spark, d):
    return fx.movies_raw(spark, d).select("_c0", "title", "budget").na.replace("NA", "0", subset=["budget"])


@register("nul04_null_profile", """
SELECT count(*) AS total, count(user_id) AS user_id_non_null,
  count(user_first_touch_timestamp) AS user_first_touch_timestamp_non_null,
  count(email) AS email_non_null, count(updated) AS updated_non_null
FROM users_dirty""")
def nul04(spark, d):
    return clean.null_profile(fx.users_dirty(spark, d))


@register("nul05_count_if", """
SELECT CAST(count_if(email IS NULL) AS BIGINT) AS email_nulls, CAST(count_if(updated IS NULL) AS BIGINT) AS updated_nulls,
       count(*) FILTER (WHERE user_id IS NULL) AS user_id_nulls
FROM users_dirty""")
def nul05(spark, d):
    u = fx.users_dirty(spark, d)
    return u.agg(F.count_if(F.col("email").isNull()).alias("email_nulls"),
                 F.count_if(F.col("updated").isNull()).alias("updated_nulls"),
                 F.count(F.when(F.col("user_id").isNull(), 1)).alias("user_id_nulls"))


# ---- de-duplication ------------------------------------------------------

@register("ded01_distinct", "SELECT DISTINCT * FROM users_dirty")
def ded01(spark, d):
    return fx.users_dirty(spark, d).distinct()


@register("ded02_drop_duplicates_keys", """
SELECT DISTINCT user_id, user_first_touch_timestamp FROM users_dirty""")
def ded02(spark, d):
    # Which row survives is arbitrary; the check compares the key set.
    return (fx.users_dirty(spark, d).dropDuplicates(["user_id", "user_first_touch_timestamp"])
            .select("user_id", "user_first_touch_timestamp"))


DEDUPED_SQL = """
SELECT user_id, user_first_touch_timestamp, max(email) AS email, max(updated) AS updated
FROM users_dirty WHERE user_id IS NOT NULL AND user_first_touch_timestamp IS NOT NULL
GROUP BY user_id, user_first_touch_timestamp"""


def deduped_users(spark, d):
    return clean.dedupe_keep_max(fx.users_dirty(spark, d), ["user_id", "user_first_touch_timestamp"])


@register("ded03_dedupe_keep_max", DEDUPED_SQL)
def ded03(spark, d):
    return deduped_users(spark, d)


@register("ded04_count_distinct_tuple", """
SELECT count(DISTINCT CASE WHEN user_id IS NOT NULL AND user_first_touch_timestamp IS NOT NULL
                           THEN (user_id, user_first_touch_timestamp) END) AS distinct_users,
       count(*) AS total_rows
FROM users_dirty""")
def ded04(spark, d):
    return fx.users_dirty(spark, d).agg(
        F.count_distinct("user_id", "user_first_touch_timestamp").alias("distinct_users"),
        F.count(F.lit(1)).alias("total_rows"))


@register("ded05_unique_key_check", f"""
SELECT max(row_count) <= 1 AS no_duplicate_ids
FROM (SELECT user_id, count(*) AS row_count FROM ({DEDUPED_SQL}) GROUP BY user_id)""")
def ded05(spark, d):
    return clean.max_rows_per_key(deduped_users(spark, d), ["user_id"])


@register("ded06_at_most_one_check", f"""
SELECT max(value_count) <= 1 AS at_most_one_id
FROM (SELECT email, count(user_id) AS value_count FROM ({DEDUPED_SQL}) WHERE email IS NOT NULL GROUP BY email)""")
def ded06(spark, d):
    return clean.at_most_one(deduped_users(spark, d), "email", "user_id")
