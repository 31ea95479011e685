"""Row-level change and versioned tables.

The versioned jobs write real snapshots under the shared checkpoint folder
(``quarry.session.scratch_dir``) and return a read of the resulting version.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.jobs.registry import register
from quarry.operators import buckets
from quarry.operators import change as C
from quarry.operators import layout, versions
from quarry.session import scratch_dir
from quarry.sources import fixtures as fx
from quarry.sources import fs
from quarry.sources.tables import table

# ---- inputs ------------------------------------------------------------------

ACCOUNTS_SQL = """accounts AS (
  SELECT c_custkey AS id, c_name AS name, c_acctbal AS value, c_mktsegment AS segment, c_nationkey AS nation
  FROM customer)"""

SUPPLIER_ROWS_SQL = """supplier_rows AS (
  SELECT s_suppkey + 1000000 AS id, s_name AS name, s_acctbal AS value, 'SUPPLIER' AS segment, s_nationkey AS nation
  FROM supplier)"""

UPDATES_SQL = """updates AS (
  SELECT c_custkey AS id, c_name AS name, c_acctbal * 2 AS value, c_mktsegment AS segment, c_nationkey AS nation,
         CASE c_custkey % 7 WHEN 0 THEN 'update' WHEN 3 THEN 'delete' WHEN 5 THEN 'insert' ELSE 'skip' END AS type
  FROM customer
  UNION ALL
  SELECT s_suppkey + 2000000, s_name, s_acctbal, 'SUPPLIER', s_nationkey, 'insert' FROM supplier)"""


def accounts(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                    F.col("c_acctbal").alias("value"), F.col("c_mktsegment").alias("segment"),
                    F.col("c_nationkey").alias("nation"))


def supplier_rows(spark: SparkSession, d: str, offset: int = 1000000) -> DataFrame:
    s = table(spark, d, "supplier")
    return s.select((F.col("s_suppkey") + offset).alias("id"), F.col("s_name").alias("name"),
                    F.col("s_acctbal").alias("value"), F.lit("SUPPLIER").alias("segment"),
                    F.col("s_nationkey").alias("nation"))


def updates(spark: SparkSession, d: str) -> DataFrame:
    """A change row for every customer (update / delete / insert / skip) plus new suppliers.

    'skip' rows match their target row but satisfy no clause, so they leave it
    untouched, as a change feed row without an applicable action does.
    """
    c = table(spark, d, "customer")
    kind = (F.when(F.col("c_custkey") % 7 == 0, "update")
             .when(F.col("c_custkey") % 7 == 3, "delete")
             .when(F.col("c_custkey") % 7 == 5, "insert").otherwise("skip"))
    cust = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                    (F.col("c_acctbal") * 2).alias("value"), F.col("c_mktsegment").alias("segment"),
                    F.col("c_nationkey").alias("nation"), kind.alias("type"))
    return cust.unionByName(supplier_rows(spark, d, 2000000).withColumn("type", F.lit("insert")))


STUDENT_CLAUSES = [
    C.Clause("matched", "update", "s.type = 'update'"),
    C.Clause("matched", "delete", "s.type = 'delete'"),
    C.Clause("not_matched", "insert", "s.type = 'insert'"),
]

MERGE_SQL = """
SELECT t.id,
  CASE WHEN s.type = 'update' THEN s.name ELSE t.name END AS name,
  CASE WHEN s.type = 'update' THEN s.value ELSE t.value END AS value,
  CASE WHEN s.type = 'update' THEN s.segment ELSE t.segment END AS segment,
  CASE WHEN s.type = 'update' THEN s.nation ELSE t.nation END AS nation
FROM {t} t LEFT JOIN updates s ON t.id = s.id
WHERE s.type IS DISTINCT FROM 'delete'
UNION ALL
SELECT s.id, s.name, s.value, s.segment, s.nation FROM updates s
WHERE s.type = 'insert' AND NOT EXISTS (SELECT 1 FROM {t} t WHERE t.id = s.id)"""

# ---- CHG01-06, 08-10 -----------------------------------------------------------


@register("chg01_update", """
SELECT id, name, CASE WHEN name LIKE '%7' THEN value + 1 ELSE value END AS value, segment, nation
FROM accounts""", ctes=ACCOUNTS_SQL)
def chg01(spark, d):
    return C.update(accounts(spark, d), {"value": "value + 1"}, "name LIKE '%7'")


@register("chg02_delete", "SELECT * FROM accounts WHERE NOT (value < 0)", ctes=ACCOUNTS_SQL)
def chg02(spark, d):
    return C.delete(accounts(spark, d), "value < 0")


@register("chg03_merge_update_delete_insert", MERGE_SQL.format(t="accounts"),
          ctes=ACCOUNTS_SQL + ",\n" + UPDATES_SQL)
def chg03(spark, d):
    return C.merge(accounts(spark, d), updates(spark, d), ["id"], STUDENT_CLAUSES)


def bucketed(spark: SparkSession, d: str, df: DataFrame, keys: list[str], base: str) -> str:
    """``df`` as a bucketed folder, a bucket for every 64 MB of the table it comes from (8 at least)."""
    n = max(8, fs.path_bytes(spark, f"{d}/{base}.parquet") >> 26)
    return buckets.write_bucketed(df, scratch_dir(spark, f"buckets-{base}"), keys, n)


@register("chg03_merge_into_buckets", MERGE_SQL.format(t="accounts"), ctes=ACCOUNTS_SQL + ",\n" + UPDATES_SQL)
def chg03_buckets(spark, d):
    """The same MERGE into a written table: touched buckets are rewritten, the others are not read."""
    path = bucketed(spark, d, accounts(spark, d), ["id"], "customer")
    buckets.merge_into(spark, path, updates(spark, d), ["id"], STUDENT_CLAUSES)
    return buckets.read_bucketed(spark, path)


STOCK_SQL = """stock_a AS (
  SELECT p_name AS name, p_brand AS color, CAST(sum(p_size) AS BIGINT) AS grams
  FROM part WHERE p_partkey % 2 = 0 GROUP BY p_name, p_brand),
stock_b AS (
  SELECT p_name AS name, p_brand AS color, CAST(sum(p_size) AS BIGINT) AS grams, sum(p_size) > 30 AS delicious
  FROM part WHERE p_partkey % 2 = 1 GROUP BY p_name, p_brand)"""


def _stock(spark, d, parity: int) -> DataFrame:
    p = table(spark, d, "part").where(F.col("p_partkey") % 2 == parity)
    g = p.groupBy(F.col("p_name").alias("name"), F.col("p_brand").alias("color")).agg(
        F.sum("p_size").cast("bigint").alias("grams"))
    return g if parity == 0 else g.withColumn("delicious", F.col("grams") > 30)


@register("chg04_merge_accumulate_composite_key", """
SELECT a.name, a.color, a.grams + coalesce(b.grams, 0) AS grams
FROM stock_a a LEFT JOIN stock_b b ON a.name = b.name AND a.color = b.color
UNION ALL
SELECT b.name, b.color, b.grams FROM stock_b b
WHERE b.delicious AND NOT EXISTS (SELECT 1 FROM stock_a a WHERE a.name = b.name AND a.color = b.color)""",
          ctes=STOCK_SQL)
def chg04(spark, d):
    a, b = _stock(spark, d, 0), _stock(spark, d, 1)
    return C.merge(a, b, ["name", "color"], [
        C.Clause("matched", "update", set={"grams": "t.grams + s.grams"}),
        C.Clause("not_matched", "insert", "s.delicious = true"),
    ])


@register("chg04_merge_accumulate_into_buckets", """
SELECT a.name, a.color, a.grams + coalesce(b.grams, 0) AS grams
FROM stock_a a LEFT JOIN stock_b b ON a.name = b.name AND a.color = b.color
UNION ALL
SELECT b.name, b.color, b.grams FROM stock_b b
WHERE b.delicious AND NOT EXISTS (SELECT 1 FROM stock_a a WHERE a.name = b.name AND a.color = b.color)""",
          ctes=STOCK_SQL)
def chg04_buckets(spark, d):
    path = bucketed(spark, d, _stock(spark, d, 0), ["name", "color"], "part")
    buckets.merge_into(spark, path, _stock(spark, d, 1), ["name", "color"], [
        C.Clause("matched", "update", set={"grams": "t.grams + s.grams"}),
        C.Clause("not_matched", "insert", "s.delicious = true"),
    ])
    return buckets.read_bucketed(spark, path)


USERS_UPDATE_SQL = """users_update AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, 1704067200000000 + c_custkey * 60000000 AS user_first_touch_timestamp,
         lower(replace(c_name, '#', '')) || '@updated.com' AS email,
         make_timestamp((1709251200 + c_custkey * 60) * 1000000) AS updated
  FROM customer
  UNION ALL
  SELECT 's' || CAST(s_suppkey AS VARCHAR), 1704067200000000 + s_suppkey, lower(replace(s_name, '#', '')) || '@supplier.com',
         make_timestamp(1709251200000000)
  FROM supplier)"""


def users_update(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    s = table(spark, d, "supplier")
    cu = c.select(F.col("c_custkey").cast("string").alias("user_id"),
                  (F.lit(1704067200000000) + F.col("c_custkey") * 60000000).alias("user_first_touch_timestamp"),
                  F.concat(F.lower(F.regexp_replace("c_name", "#", "")), F.lit("@updated.com")).alias("email"),
                  F.timestamp_seconds(F.lit(1709251200) + F.col("c_custkey") * 60).cast("timestamp_ntz").alias("updated"))
    su = s.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("user_id"),
                  (F.lit(1704067200000000) + F.col("s_suppkey")).alias("user_first_touch_timestamp"),
                  F.concat(F.lower(F.regexp_replace("s_name", "#", "")), F.lit("@supplier.com")).alias("email"),
                  F.timestamp_seconds(F.lit(1709251200)).cast("timestamp_ntz").alias("updated"))
    return cu.unionByName(su)


@register("chg05_merge_update_if_null", """
SELECT a.user_id, a.user_first_touch_timestamp,
  CASE WHEN a.email IS NULL AND b.email IS NOT NULL THEN b.email ELSE a.email END AS email,
  CASE WHEN a.email IS NULL AND b.email IS NOT NULL THEN b.updated ELSE a.updated END AS updated
FROM users a LEFT JOIN users_update b ON a.user_id = b.user_id
UNION ALL
SELECT b.* FROM users_update b WHERE NOT EXISTS (SELECT 1 FROM users a WHERE a.user_id = b.user_id)""",
          ctes=USERS_UPDATE_SQL)
def chg05(spark, d):
    return C.merge(fx.users(spark, d), users_update(spark, d), ["user_id"], [
        C.Clause("matched", "update", "t.email IS NULL AND s.email IS NOT NULL",
                 {"email": "s.email", "updated": "s.updated"}),
        C.Clause("not_matched", "insert"),
    ])


@register("chg05_merge_if_null_into_buckets", """
SELECT a.user_id, a.user_first_touch_timestamp,
  CASE WHEN a.email IS NULL AND b.email IS NOT NULL THEN b.email ELSE a.email END AS email,
  CASE WHEN a.email IS NULL AND b.email IS NOT NULL THEN b.updated ELSE a.updated END AS updated
FROM users a LEFT JOIN users_update b ON a.user_id = b.user_id
UNION ALL
SELECT b.* FROM users_update b WHERE NOT EXISTS (SELECT 1 FROM users a WHERE a.user_id = b.user_id)""",
          ctes=USERS_UPDATE_SQL)
def chg05_buckets(spark, d):
    path = bucketed(spark, d, fx.users(spark, d), ["user_id"], "customer")
    buckets.merge_into(spark, path, users_update(spark, d), ["user_id"], [
        C.Clause("matched", "update", "t.email IS NULL AND s.email IS NOT NULL", {"email": "s.email", "updated": "s.updated"}),
        C.Clause("not_matched", "insert"),
    ])
    return buckets.read_bucketed(spark, path)


_EV_COLS = ["event_id", "user_id", "event_timestamp", "event_name", "device", "traffic_source"]


@register("chg06_insert_only_merge", """
SELECT event_id, user_id, event_timestamp, event_name, device, traffic_source FROM events_nested WHERE event_name <> 'purchase'
UNION ALL
SELECT event_id, user_id, event_timestamp, event_name, device, traffic_source FROM events_nested
WHERE event_name = 'purchase' AND traffic_source = 'BUILDING'""")
def chg06(spark, d):
    ev = fx.events_nested(spark, d).select(*_EV_COLS)
    target = ev.where(F.col("event_name") != "purchase")
    new = C.insert_only_merge(target, ev, ["user_id", "event_timestamp"], "traffic_source = 'BUILDING'")
    return target.unionByName(new)


@register("chg08_merge_schema_evolution", """
SELECT id, name, value, segment, nation, CAST(NULL AS VARCHAR) AS band FROM accounts
UNION ALL
SELECT id, name, value, segment, nation, CASE WHEN value > 5000 THEN 'high' ELSE 'low' END AS band
FROM supplier_rows""", ctes=ACCOUNTS_SQL + ",\n" + SUPPLIER_ROWS_SQL)
def chg08(spark, d):
    src = supplier_rows(spark, d).withColumn("band", F.when(F.col("value") > 5000, "high").otherwise("low"))
    return C.merge(accounts(spark, d), src, ["id"], [C.Clause("not_matched", "insert")], evolve_schema=True)


@register("chg08_merge_fills_generated", """
SELECT id, transaction_timestamp, price, CAST(make_timestamp(transaction_timestamp) AS DATE) AS date,
       strftime(make_timestamp(transaction_timestamp), '%Y-%m') AS month,
       strftime(make_timestamp(transaction_timestamp), '%Y-%m') || CASE WHEN price >= 100000 THEN ' large' ELSE ' small' END AS kind
FROM (SELECT order_id AS id, transaction_timestamp + CASE WHEN order_id % 3 = 0 THEN 2678400000000 ELSE 0 END AS transaction_timestamp,
             CASE WHEN order_id % 3 = 0 THEN purchase_revenue_in_usd * 2 ELSE purchase_revenue_in_usd END AS price
      FROM sales WHERE order_id % 3 = 0 OR order_id % 2 = 0)""")
def chg08_generated(spark, d):
    """MERGE into a table with generated columns, one of which depends on others; the source has none of them.

    Every third sale comes a month later at twice the price: updates where the
    target (every second sale) has it, inserts where it does not.
    """
    s = fx.sales(spark, d).select(F.col("order_id").alias("id"), "transaction_timestamp", F.col("purchase_revenue_in_usd").alias("price"))
    generated = {"kind": "concat(month, CASE WHEN price >= 100000 THEN ' large' ELSE ' small' END)",
                 "month": "date_format(date, 'yyyy-MM')", "date": "CAST(timestamp_micros(transaction_timestamp) AS DATE)"}
    target = s.where("id % 2 = 0")
    for name in buckets.generated_order(generated):
        target = C.with_generated(target, name, generated[name])
    later = s.where("id % 3 = 0").select("id", (F.col("transaction_timestamp") + 2678400000000).alias("transaction_timestamp"),
                                         (F.col("price") * 2).alias("price"))
    path = bucketed(spark, d, target, ["id"], "orders")
    buckets.merge_into(spark, path, later, ["id"], [C.Clause("matched", "update"), C.Clause("not_matched", "insert")], generated)
    return buckets.read_bucketed(spark, path)


@register("chg09_generated_column", """
SELECT order_id AS id, transaction_timestamp, purchase_revenue_in_usd AS price,
       CAST(make_timestamp(transaction_timestamp) AS DATE) AS date
FROM sales""")
def chg09(spark, d):
    s = fx.sales(spark, d).select(F.col("order_id").alias("id"), "transaction_timestamp",
                                  F.col("purchase_revenue_in_usd").alias("price"))
    gen = "CAST(CAST(transaction_timestamp / 1e6 AS TIMESTAMP) AS DATE)"
    first = C.with_generated(s, "date", gen)
    # A second write that supplies the column must agree with the expression.
    return C.with_generated(first, "date", gen)


@register("chg10_constraint_violations", """
SELECT *, 'non_negative_value' AS "constraint" FROM accounts WHERE NOT coalesce(value >= 0, true)
UNION ALL
SELECT *, 'known_segment' AS "constraint" FROM accounts
WHERE NOT coalesce(segment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'), true)""",
          ctes=ACCOUNTS_SQL)
def chg10(spark, d):
    return C.constraint_violations(accounts(spark, d), {
        "non_negative_value": "value >= 0",
        "known_segment": "segment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')",
    })


# ---- versioned life cycle (JOB20, CHG07, CHG12-21, CHG23) ---------------------------

_LIFECYCLES: dict[tuple[str, str], dict] = {}


def lifecycle(spark: SparkSession, d: str) -> dict:
    """Run the table life cycle once per (application, sf) and remember its root.

    v0 create, v1 insert, v2 update, v3 delete, v4 merge, v5 optimize,
    v6 restore of v2.
    """
    key = (spark.sparkContext.applicationId, d)
    if key in _LIFECYCLES:
        return _LIFECYCLES[key]
    root = scratch_dir(spark, "accounts")
    read = lambda v: versions.snapshot_read(spark, root, v)
    versions.commit(spark, root, accounts(spark, d), "CREATE TABLE AS SELECT")
    versions.commit(spark, root, read(0).unionByName(supplier_rows(spark, d)), "WRITE", {"mode": "Append"})
    versions.commit(spark, root, C.update(read(1), {"value": "value + 1"}, "name LIKE '%7'"), "UPDATE",
                    {"predicate": "name LIKE '%7'"})
    versions.commit(spark, root, C.delete(read(2), "value < 0"), "DELETE", {"predicate": "value < 0"})
    versions.commit(spark, root, C.merge(read(3), updates(spark, d), ["id"], STUDENT_CLAUSES), "MERGE",
                    {"predicate": "t.id = s.id"})
    layout.compact(spark, root, 4)
    versions.restore(spark, root, 2)
    _LIFECYCLES[key] = {"root": root}
    return _LIFECYCLES[key]


V1_SQL = "SELECT * FROM accounts UNION ALL SELECT * FROM supplier_rows"
V2_SQL = f"""SELECT id, name, CASE WHEN name LIKE '%7' THEN value + 1 ELSE value END AS value, segment, nation
FROM ({V1_SQL})"""
V3_SQL = f"SELECT * FROM ({V2_SQL}) WHERE NOT (value < 0)"
_LC_CTES = ACCOUNTS_SQL + ",\n" + SUPPLIER_ROWS_SQL + ",\n" + UPDATES_SQL


@register("chg12_time_travel_version", V3_SQL, ctes=_LC_CTES)
def chg12(spark, d):
    return versions.snapshot_read(spark, lifecycle(spark, d)["root"], version=3)


@register("chg13_time_travel_timestamp", V1_SQL, ctes=_LC_CTES)
def chg13(spark, d):
    root = lifecycle(spark, d)["root"]
    ts = versions.history(spark, root).where("version = 1").select("timestamp").first()[0]
    return versions.snapshot_read(spark, root, as_of=ts)


@register("chg14_history")
def chg14(spark, d):
    """version, timestamp, operation, parameters, rows, files of every commit."""
    return versions.history(spark, lifecycle(spark, d)["root"]).orderBy(F.col("version").desc())


@register("chg15_restore", V2_SQL, ctes=_LC_CTES)
def chg15(spark, d):
    return versions.snapshot_read(spark, lifecycle(spark, d)["root"])


@register("chg16_snapshot_diff", f"""
SELECT *, 'added' AS change FROM (({V2_SQL}) EXCEPT ALL ({V1_SQL}))
UNION ALL
SELECT *, 'removed' AS change FROM (({V1_SQL}) EXCEPT ALL ({V2_SQL}))""", ctes=_LC_CTES)
def chg16(spark, d):
    return versions.diff(spark, lifecycle(spark, d)["root"], 1, 2)


@register("chg17_compaction")
def chg17(spark, d):
    """File count and bytes before (v4) and after (v5) OPTIMIZE."""
    root = lifecycle(spark, d)["root"]
    return versions.detail(spark, root, 4).unionByName(versions.detail(spark, root, 5))


@register("chg17_compact_small_files", "SELECT * FROM accounts", ctes=ACCOUNTS_SQL)
def chg17_files(spark, d):
    """A partitioned folder of many small files after file-wise compaction: the same rows."""
    path = scratch_dir(spark, "small-files")
    accounts(spark, d).repartition(12).write.partitionBy("segment").parquet(path)
    done = layout.compact_files(spark, path)
    assert done["files_after"] < done["files_before"], done
    return spark.read.parquet(path).select("id", "name", "value", "segment", "nation")


@register("chg18_zorder", "SELECT * FROM accounts", ctes=ACCOUNTS_SQL)
def chg18(spark, d):
    """Z-order by (value, nation): same rows, clustered file layout (~128 MB files)."""
    root = scratch_dir(spark, "zorder")
    versions.commit(spark, root, accounts(spark, d), "CREATE TABLE AS SELECT")
    v = layout.zorder(spark, root, ["value", "nation"])
    return versions.snapshot_read(spark, root, v)


@register("chg19_vacuum_dry_run")
def chg19(spark, d):
    """Snapshots a zero-hour retention would remove (newest never listed)."""
    root = lifecycle(spark, d)["root"]
    future = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(hours=1)
    return versions.vacuum(spark, root, retain_hours=0, dry_run=True, now=future)


@register("chg07_read_vacuumed_version")
def chg07(spark, d):
    """After VACUUM, old versions fail to read; the current one still reads."""
    src = lifecycle(spark, d)["root"]
    root = scratch_dir(spark, "vacuumed")
    versions.deep_clone(spark, src, root)
    future = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(hours=1)
    versions.vacuum(spark, root, retain_hours=0, dry_run=False, now=future)
    rows = []
    for v in range(versions.latest_version(spark, root) + 1):
        try:
            versions.snapshot_read(spark, root, v).limit(1).count()
            rows.append((v, True))
        except versions.VersionNotFound:
            rows.append((v, False))
    return spark.createDataFrame(rows, "version bigint, readable boolean")


@register("chg20_deep_clone", V2_SQL, ctes=_LC_CTES)
def chg20(spark, d):
    src = lifecycle(spark, d)["root"]
    root = scratch_dir(spark, "deepclone")
    versions.deep_clone(spark, src, root)
    again = versions.deep_clone(spark, src, root)   # incremental: nothing new
    assert again == []
    return versions.snapshot_read(spark, root)


@register("chg21_shallow_clone")
def chg21(spark, d):
    """Shallow clone of v4; a later write to the clone does not touch the source."""
    src = lifecycle(spark, d)["root"]
    root = scratch_dir(spark, "shallow")
    versions.shallow_clone(spark, src, root, 4)
    versions.commit(spark, root, C.delete(versions.snapshot_read(spark, root), "segment = 'SUPPLIER'"), "DELETE")
    clone = versions.snapshot_read(spark, root).agg(F.lit("clone").alias("table"),
                                                    F.count(F.lit(1)).alias("rows"))
    source = versions.snapshot_read(spark, src, 4).agg(F.lit("source").alias("table"),
                                                       F.count(F.lit(1)).alias("rows"))
    return clone.unionByName(source)


@register("chg23_table_detail")
def chg23(spark, d):
    return versions.detail(spark, lifecycle(spark, d)["root"])


@register("job20_table_lifecycle", V2_SQL, ctes=_LC_CTES)
def job20(spark, d):
    """Final state after create, insert, update, delete, merge, optimize, restore(v2)."""
    return versions.snapshot_read(spark, lifecycle(spark, d)["root"])


@register("job20_merge_version", MERGE_SQL.format(t="v3"), ctes=_LC_CTES + ",\nv3 AS (" + V3_SQL + ")")
def job20_merge(spark, d):
    """Version 4 of the life cycle: the MERGE result."""
    return versions.snapshot_read(spark, lifecycle(spark, d)["root"], 4)


@register("chg11_copy_into_idempotent", """
SELECT order_id, order_status, status_timestamp FROM status_feed""")
def chg11(spark, d):
    """COPY INTO twice over the same files, then once more after new files land.

    The second run loads nothing; the table holds every source row exactly once.
    """
    from quarry.jobs.streams import landed
    from quarry.streaming import ingest
    src = landed(spark, d, "status")
    target = scratch_dir(spark, "copy-into")
    schema = "order_id BIGINT, order_status STRING, status_timestamp BIGINT"
    first = ingest.copy_into(spark, target, src, schema)
    again = ingest.copy_into(spark, target, src, schema)
    assert first > 0 and again == 0, (first, again)
    return spark.read.parquet(target)


@register("chg22_migration_ctas", """
SELECT _c0 AS idx, title, CAST(year AS INTEGER) AS year,
  CASE WHEN budget = 'NA' THEN 0 ELSE CAST(budget AS INTEGER) END AS budget,
  CAST(rating AS DOUBLE) AS rating
FROM movies_raw""")
def chg22(spark, d):
    """CTAS of the cleaned movie table into a new versioned table (rename, casts, NA -> 0)."""
    from quarry.jobs.composite import clean_movies
    root = scratch_dir(spark, "movies")
    versions.commit(spark, root, clean_movies(fx.movies_raw(spark, d)), "CREATE TABLE AS SELECT")
    return versions.snapshot_read(spark, root)
