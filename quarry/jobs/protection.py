"""Row- and column-level protection views and UDFs (§2.12)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.functions import udfs
from quarry.jobs.oracle import sround
from quarry.jobs.registry import register
from quarry.operators import protect as P
from quarry.sources import fixtures as fx

GROUP, OTHERS = "account users", "contractors"
_MEMBERS: dict[str, str] = {}


def members(spark) -> str:
    """The membership table of this application: whoever reads is in GROUP, and not in OTHERS."""
    app = spark.sparkContext.applicationId
    if app not in _MEMBERS:
        me = spark.sql("SELECT current_user()").first()[0]
        _MEMBERS[app] = P.members_table(spark, [(me, GROUP), ("intern@example.com", GROUP), ("admin@example.com", OTHERS)],
                                        f"members_{uuid.uuid4().hex[:12]}")
    return _MEMBERS[app]


def _view(spark, df, group: str = GROUP, **protection):
    """A protected catalog view over ``df``, read as the current user."""
    base = f"base_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(base)
    return spark.table(P.secured_view(spark, f"secured_{base}", base, members(spark), group, **protection))


def _daily_by_patient(spark, d):
    return (fx.heartrate_device(spark, d).groupBy("mrn", "name", F.date_trunc("DD", "time").cast("timestamp_ntz").alias("date"))
            .agg(F.round(F.mean("heartrate"), 6).alias("avg_heartrate")))


def _readings(spark, d):
    return fx.heartrate_device(spark, d).select("mrn", "time", "device_id", "heartrate")


_MASK_SQL = "CASE WHEN length({c}) <= 2 THEN {c} ELSE repeat('*', length({c}) - 2) || right({c}, 2) END"


@register("sec01_redact_for_group", f"""
SELECT 'REDACTED' AS mrn, 'REDACTED' AS name, {sround('avg(heartrate)', 6)} AS avg_heartrate,
       date_trunc('day', time) AS date
FROM heartrate_device GROUP BY mrn, name, date_trunc('day', time)""")
def sec01(spark, d):
    """Aggregate view with identity columns redacted for the group's members."""
    return _view(spark, _daily_by_patient(spark, d), redact_cols=["mrn", "name"]).select("mrn", "name", "avg_heartrate", "date")


@register("sec01_redact_other_user", f"""
SELECT mrn, name, {sround('avg(heartrate)', 6)} AS avg_heartrate, date_trunc('day', time) AS date
FROM heartrate_device GROUP BY mrn, name, date_trunc('day', time)""")
def sec01_other(spark, d):
    """The same view for a group the reader is not in."""
    return _view(spark, _daily_by_patient(spark, d), OTHERS, redact_cols=["mrn", "name"])


@register("sec02_row_filter_for_group", """
SELECT mrn, time, device_id, heartrate FROM heartrate_device WHERE device_id < 30""")
def sec02(spark, d):
    return _view(spark, _readings(spark, d), predicate="device_id < 30")


@register("sec03_mask_and_filter", f"""
SELECT {_MASK_SQL.format(c='mrn')} AS mrn, time, device_id, heartrate
FROM heartrate_device WHERE device_id < 30""")
def sec03(spark, d):
    return _view(spark, _readings(spark, d), mask_cols=["mrn"], predicate="device_id < 30")


@register("sec04_daily_aggregate_protected", f"""
SELECT device_id, date_trunc('day', time) AS day, {sround('avg(heartrate)', 6)} AS avg_heartrate, count(*) AS readings
FROM heartrate_device WHERE device_id < 30 GROUP BY device_id, date_trunc('day', time)""")
def sec04(spark, d):
    """A daily aggregate over the protected rows."""
    h = _view(spark, _readings(spark, d), predicate="device_id < 30")
    return (h.groupBy("device_id", F.date_trunc("DD", "time").cast("timestamp_ntz").alias("day"))
            .agg(F.round(F.avg("heartrate"), 6).alias("avg_heartrate"), F.count(F.lit(1)).alias("readings")))


@register("sec05_rows_of_current_user", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS value FROM customer
WHERE lower(c_mktsegment) || '@example.com' = 'building@example.com'""")
def sec05(spark, d):
    """Rows keyed to the current user (owner column); the user comes in as a parameter."""
    from quarry.jobs.change import accounts
    acc = accounts(spark, d).withColumn("owner", F.concat(F.lower("segment"), F.lit("@example.com")))
    return P.owned_by(acc, "owner", "building@example.com").select("id", "name", "value")


# ---- UDFs ------------------------------------------------------------------

_FIRST_SQL = "SELECT item_id, substr(name, 1, 1) AS first_letter FROM item_lookup"


@register("udf01_python_udf", _FIRST_SQL)
def udf01(spark, d):
    return fx.item_lookup(spark, d).select("item_id", udfs.first_letter_udf()("name").alias("first_letter"))


@register("udf02_registered_for_sql", _FIRST_SQL)
def udf02(spark, d):
    udfs.register_python(spark)
    view = "items_udf02"
    fx.item_lookup(spark, d).createOrReplaceTempView(view)
    return spark.sql(f"SELECT item_id, sql_first_letter(name) AS first_letter FROM {view}")


@register("udf03_decorator_udf", _FIRST_SQL)
def udf03(spark, d):
    return fx.item_lookup(spark, d).select("item_id", udfs.first_letter_decorated()("name").alias("first_letter"))


@register("udf04_pandas_udf", _FIRST_SQL)
def udf04(spark, d):
    udfs.register_python(spark)
    a = fx.item_lookup(spark, d).select("item_id", udfs.first_letter_vectorized()("name").alias("first_letter"))
    view = "items_udf04"
    fx.item_lookup(spark, d).createOrReplaceTempView(view)
    b = spark.sql(f"SELECT item_id, sql_first_letter_vectorized(name) AS first_letter FROM {view}")
    return a.unionByName(b).distinct()


@register("udf05_sql_udf_parameters", f"""
SELECT item_id, {sround('price * (1 - 0.2)', 2)} AS sale_price FROM item_lookup""")
def udf05(spark, d):
    udfs.register_sql(spark)
    return fx.item_lookup(spark, d).select("item_id", F.expr("price_with_discount(price, 0.2D)").alias("sale_price"))


@register("udf06_sql_udf_case", """
SELECT item_id, CASE WHEN price >= 1800 THEN 'premium' WHEN price >= 1200 THEN 'standard' ELSE 'basic' END AS band
FROM item_lookup""")
def udf06(spark, d):
    udfs.register_sql(spark)
    return fx.item_lookup(spark, d).select("item_id", F.expr("price_band(price)").alias("band"))


@register("udf07_zero_arg_random_udf")
def udf07(spark, d):
    """Non-deterministic zero-argument SQL function (rows-only)."""
    udfs.register_sql(spark)
    return fx.user_ping(spark, d).select("user_id").distinct().select("user_id", F.expr("random_ping()").alias("ping"))


@register("udf08_mask_function", f"""
SELECT c_custkey, {_MASK_SQL.format(c='c_name')} AS masked_name,
       {_MASK_SQL.format(c="CAST(c_nationkey AS VARCHAR)")} AS masked_nation
FROM customer""")
def udf08(spark, d):
    from quarry.sources.tables import table
    udfs.register_sql(spark)
    return table(spark, d, "customer").select(
        "c_custkey", F.expr("mask_all_but_two(c_name)").alias("masked_name"),
        F.expr("mask_all_but_two(CAST(c_nationkey AS STRING))").alias("masked_nation"))
