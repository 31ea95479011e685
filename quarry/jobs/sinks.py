"""Sinks and table creation.

Tables live in a per-application database whose location is under the
shared scratch folder, so "managed" tables are still on shared storage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quarry.jobs.change import ACCOUNTS_SQL, accounts
from quarry.jobs.registry import register
from quarry.jobs.streams import _memo
from quarry.operators import versions
from quarry.session import scratch_dir
from quarry.sources import fixtures as fx
from quarry.sources.tables import table


def database(spark: SparkSession, d: str) -> str:
    def build():
        name = f"quarry_{uuid.uuid4().hex[:8]}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{scratch_dir(spark, 'warehouse')}'")
        return name
    return _memo(spark, d, "database", build)


def _t(spark, d, stem: str) -> str:
    return f"{database(spark, d)}.{stem}_{uuid.uuid4().hex[:8]}"


@register("snk01_write_parquet_snappy", "SELECT * FROM accounts", ctes=ACCOUNTS_SQL)
def snk01(spark, d):
    p1, p2 = scratch_dir(spark, "snk01a"), scratch_dir(spark, "snk01b")
    df = accounts(spark, d)
    df.write.mode("overwrite").option("compression", "snappy").parquet(p1)
    df.write.parquet(p2, mode="overwrite", compression="snappy")
    a, b = spark.read.parquet(p1), spark.read.parquet(p2)
    assert a.exceptAll(b).isEmpty()
    return a


@register("snk02_managed_table", "SELECT * FROM accounts", ctes=ACCOUNTS_SQL)
def snk02(spark, d):
    name = _t(spark, d, "accounts")
    accounts(spark, d).write.mode("overwrite").saveAsTable(name)
    return spark.table(name)


@register("snk03_write_versioned_path", "SELECT * FROM accounts", ctes=ACCOUNTS_SQL)
def snk03(spark, d):
    root = scratch_dir(spark, "snk03")
    versions.commit(spark, root, accounts(spark, d), "WRITE", {"mode": "Overwrite"})
    return versions.snapshot_read(spark, root)


@register("snk04_append_directory", "SELECT * FROM accounts UNION ALL SELECT * FROM accounts", ctes=ACCOUNTS_SQL)
def snk04(spark, d):
    p = scratch_dir(spark, "snk04")
    accounts(spark, d).write.parquet(p)
    accounts(spark, d).write.mode("append").parquet(p)
    return spark.read.parquet(p)


@register("snk05_create_table_schema", "SELECT * FROM accounts", ctes=ACCOUNTS_SQL)
def snk05(spark, d):
    name = _t(spark, d, "accounts")
    spark.sql(f"CREATE TABLE {name} (id BIGINT, name STRING, value DOUBLE, segment STRING, nation INT) USING parquet")
    accounts(spark, d).write.insertInto(name)
    return spark.table(name)


@register("snk06_ctas_and_replace", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0")
def snk06(spark, d):
    view = f"cust_{uuid.uuid4().hex[:8]}"
    table(spark, d, "customer").createOrReplaceTempView(view)
    name = _t(spark, d, "ctas")
    spark.sql(f"CREATE TABLE {name} USING parquet AS SELECT c_custkey, c_name FROM {view}")
    # create-or-replace: overwrite the table with a new query result
    spark.sql(f"SELECT c_custkey, c_name FROM {view} WHERE c_acctbal > 0").write.mode("overwrite").saveAsTable(name)
    return spark.table(name)


@register("snk07_ctas_rename_subset", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS total FROM orders""")
def snk07(spark, d):
    view = f"orders_{uuid.uuid4().hex[:8]}"
    table(spark, d, "orders").createOrReplaceTempView(view)
    name = _t(spark, d, "orders_subset")
    q = f"SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS total FROM {view}"
    spark.sql(f"CREATE TABLE {name} USING parquet AS {q}")
    spark.sql(f"CREATE OR REPLACE TEMP VIEW {view}_v AS {q}")
    t, v = spark.table(name), spark.table(f"{view}_v")
    assert t.exceptAll(v).isEmpty()
    return t


@register("snk08_external_table_survives_drop", "SELECT count(*) AS rows_after_drop FROM customer")
def snk08(spark, d):
    """External CTAS with LOCATION: DROP TABLE leaves the files."""
    loc = scratch_dir(spark, "snk08")
    name = _t(spark, d, "external")
    accounts(spark, d).write.option("path", loc).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(loc).agg(F.count(F.lit(1)).alias("rows_after_drop"))


@register("snk09_ctas_partitioned_by_date", """
SELECT user_id, CAST(make_timestamp(user_first_touch_timestamp) AS DATE) AS first_touch_date FROM users""")
def snk09(spark, d):
    name = _t(spark, d, "users_pt")
    u = (fx.users(spark, d)
         .withColumn("first_touch_date", F.timestamp_micros("user_first_touch_timestamp").cast("date"))
         .withColumn("updated_at", F.current_timestamp())
         .withColumn("source_table", F.lit("users")))
    (u.write.partitionBy("first_touch_date").option("comment", "users by first touch date")
     .saveAsTable(name))
    out = spark.table(name)
    assert out.inputFiles(), "partitioned table has files"
    return out.select("user_id", "first_touch_date")


@register("snk09_ctas_provenance_and_comment", """
SELECT user_id, CAST(make_timestamp(user_first_touch_timestamp) AS DATE) AS first_touch_date, true AS own_source_file,
       'users by first touch date' AS comment
FROM users""")
def snk09_provenance(spark, d):
    """CTAS with a comment, partitioned by a derived date, with the file and time every row came from.

    The file is the scan's hidden metadata column, so it is each row's own:
    rows are checked against the file that a second read finds their id in.
    """
    landing, name = scratch_dir(spark, "snk09-landing"), _t(spark, d, "users_from_files")
    fx.users(spark, d).select("user_id", "user_first_touch_timestamp").repartition(4).write.parquet(landing)
    spark.sql(f"""
        CREATE TABLE {name} USING parquet PARTITIONED BY (first_touch_date) COMMENT 'users by first touch date' AS
        SELECT user_id, current_timestamp() AS updated, _metadata.file_path AS source_file,
               CAST(timestamp_micros(user_first_touch_timestamp) AS DATE) AS first_touch_date
        FROM parquet.`{landing}`""")
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Comment'").select(F.col("data_type").alias("comment"))
    again = spark.read.parquet(landing).select("user_id", F.col("_metadata.file_path").alias("read_from"))
    out = spark.table(name).join(again, "user_id")
    return out.select("user_id", "first_touch_date", (F.col("source_file") == F.col("read_from")).alias("own_source_file")).join(
        F.broadcast(told))  # one row


@register("snk10_insert_values", """
SELECT * FROM accounts UNION ALL
SELECT * FROM (VALUES (9000001, 'Yve', 1.0, 'MANUAL', 0), (9000002, 'Omar', 2.5, 'MANUAL', 1),
                      (9000003, 'Elia', 3.3, 'MANUAL', 2)) v(id, name, value, segment, nation)""", ctes=ACCOUNTS_SQL)
def snk10(spark, d):
    name = _t(spark, d, "accounts")
    accounts(spark, d).write.saveAsTable(name)
    spark.sql(f"INSERT INTO {name} VALUES (9000001, 'Yve', 1.0, 'MANUAL', 0)")
    spark.sql(f"INSERT INTO {name} VALUES (9000002, 'Omar', 2.5, 'MANUAL', 1), (9000003, 'Elia', 3.3, 'MANUAL', 2)")
    return spark.table(name)


@register("snk11_insert_select_rerun_duplicates", """
SELECT * FROM accounts UNION ALL SELECT * FROM accounts WHERE segment = 'BUILDING'
UNION ALL SELECT * FROM accounts WHERE segment = 'BUILDING'""", ctes=ACCOUNTS_SQL)
def snk11(spark, d):
    name = _t(spark, d, "accounts")
    src = f"src_{uuid.uuid4().hex[:8]}"
    accounts(spark, d).createOrReplaceTempView(src)
    spark.sql(f"CREATE TABLE {name} USING parquet AS SELECT * FROM {src}")
    for _ in range(2):   # INSERT INTO is not idempotent: a re-run appends again
        spark.sql(f"INSERT INTO {name} SELECT * FROM {src} WHERE segment = 'BUILDING'")
    return spark.table(name)


@register("snk12_insert_overwrite", "SELECT * FROM accounts WHERE value > 0", ctes=ACCOUNTS_SQL)
def snk12(spark, d):
    name = _t(spark, d, "accounts")
    src = f"src_{uuid.uuid4().hex[:8]}"
    accounts(spark, d).createOrReplaceTempView(src)
    spark.sql(f"CREATE TABLE {name} USING parquet AS SELECT * FROM {src}")
    spark.sql(f"INSERT OVERWRITE {name} SELECT * FROM {src} WHERE value > 0")
    return spark.table(name)


@register("snk13_schema_enforcement", "SELECT count(*) AS rows, true AS extra_column_rejected FROM customer")
def snk13(spark, d):
    """An overwrite with an extra column is rejected; the table is unchanged."""
    name = _t(spark, d, "accounts")
    accounts(spark, d).write.saveAsTable(name)
    rejected = False
    try:
        accounts(spark, d).withColumn("extra", F.lit(1)).write.insertInto(name, overwrite=True)
    except AnalysisException:
        rejected = True
    return spark.table(name).agg(F.count(F.lit(1)).alias("rows"), F.lit(rejected).alias("extra_column_rejected"))


@register("snk14_describe_metadata")
def snk14(spark, d):
    """DESCRIBE EXTENDED of a table as rows (rows-only)."""
    name = _t(spark, d, "accounts")
    accounts(spark, d).write.saveAsTable(name)
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}")


@register("snk14_metadata_rows", """
SELECT unnest(['id', 'name', 'value', 'segment', 'nation']) AS name, 'column' AS kind,
  unnest(['bigint', 'string', 'double', 'string', 'int']) AS detail
UNION ALL SELECT unnest(['id', 'name', 'value', 'segment', 'nation']), 'shown column', NULL
UNION ALL SELECT 'owner_team', 'property', 'sales'
UNION ALL SELECT unnest(['Type', 'Provider', 'Comment']), 'detail', unnest(['MANAGED', 'parquet', 'one row a customer'])
UNION ALL SELECT 'rows', 'statistics', CAST(count(*) AS VARCHAR) FROM customer
UNION ALL SELECT 'tables', 'catalog', '1'""")
def snk14_rows(spark, d):
    """What the catalog says of a table, as rows: columns, properties, provider, comment, analysed row count."""
    name = _t(spark, d, "accounts")
    db, short = name.split(".")
    accounts(spark, d).createOrReplaceTempView(f"{short}_rows")
    spark.sql(f"CREATE TABLE {name} USING parquet COMMENT 'one row a customer' "
              f"TBLPROPERTIES ('owner_team' = 'sales') AS SELECT * FROM {short}_rows")
    spark.catalog.dropTempView(f"{short}_rows")
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    extended = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    parts = [
        spark.sql(f"DESCRIBE TABLE {name}").selectExpr("col_name AS name", "'column' AS kind", "data_type AS detail"),
        spark.sql(f"SHOW COLUMNS IN {name}").selectExpr("col_name", "'shown column'", "CAST(NULL AS STRING)"),
        spark.sql(f"SHOW TBLPROPERTIES {name}").where("key = 'owner_team'").selectExpr("key", "'property'", "value"),
        extended.where("col_name IN ('Type', 'Provider', 'Comment')").selectExpr("col_name", "'detail'", "data_type"),
        extended.where("col_name = 'Statistics'").selectExpr("'rows'", "'statistics'", r"regexp_extract(data_type, '([0-9]+) rows', 1)"),
        spark.sql(f"SHOW TABLES IN {db} LIKE '{short}'").selectExpr("'tables'", "'catalog'", "CAST(count(*) AS STRING)")]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


@register("snk15_dynamic_partition_overwrite", """
SELECT * FROM accounts WHERE segment <> 'BUILDING'
UNION ALL SELECT id, name, value * 2 AS value, segment, nation FROM accounts WHERE segment = 'BUILDING'""",
          ctes=ACCOUNTS_SQL)
def snk15(spark, d):
    """Overwrite only the partitions present in the new data."""
    p = scratch_dir(spark, "snk15")
    acc = accounts(spark, d)
    acc.write.partitionBy("segment").parquet(p)
    (acc.where(F.col("segment") == "BUILDING").withColumn("value", F.col("value") * 2)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("segment").parquet(p))
    out = spark.read.parquet(p)
    return out.select("id", "name", "value", "segment", F.col("nation").cast("int").alias("nation"))
