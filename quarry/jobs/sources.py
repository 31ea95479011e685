"""Sources and scans: fixtures are re-encoded by Spark as
JSON / CSV / text files under the shared scratch folder and read back.

SRC18/SRC19 (JDBC) are not registered: the only database available here
would be an embedded one visible to this JVM alone (see README).
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from quarry.jobs.registry import register
from quarry.jobs.streams import _memo, landed
from quarry.operators import versions
from quarry.session import scratch_dir
from quarry.sources import files
from quarry.sources import fixtures as fx
from quarry.sources.tables import files_for, table
from quarry.streaming import ingest

USERS_SCHEMA = StructType([
    StructField("user_id", StringType()), StructField("user_first_touch_timestamp", LongType()),
    StructField("email", StringType()), StructField("updated", TimestampNTZType())])
USERS_DDL = "user_id STRING, user_first_touch_timestamp BIGINT, email STRING, updated TIMESTAMP_NTZ"

ITEM = StructType([StructField("coupon", StringType()), StructField("item_id", StringType()),
                   StructField("item_name", StringType()), StructField("item_revenue_in_usd", DoubleType()),
                   StructField("price_in_usd", DoubleType()), StructField("quantity", LongType())])
EVENTS_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("device", StringType()),
    StructField("ecommerce", StructType([StructField("purchase_revenue_in_usd", DoubleType()),
                                         StructField("total_item_quantity", LongType()),
                                         StructField("unique_items", LongType())])),
    StructField("event_name", StringType()), StructField("event_timestamp", LongType()),
    StructField("geo", StructType([StructField("city", StringType()), StructField("state", StringType())])),
    StructField("items", ArrayType(ITEM)), StructField("traffic_source", StringType()),
    StructField("user_id", StringType())])

_TS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _land(spark, d, name, build):
    return _memo(spark, d, f"src:{name}", build)


def users_csv(spark: SparkSession, d: str) -> str:
    """users as tab-separated CSV with a header (file count from the data size)."""
    def build():
        p = scratch_dir(spark, "users-csv")
        n = files_for(spark, d, "customer", minimum=4)
        (fx.users(spark, d).repartition(n).write.options(**_TS)
         .option("sep", "\t").option("header", True).csv(p))
        return p
    return _land(spark, d, "users_csv", build)


def users_by_segment_json(spark: SparkSession, d: str) -> str:
    """users as JSON, one directory per email domain segment, each written by many tasks."""
    def build():
        p = scratch_dir(spark, "users-json")
        u = fx.users(spark, d).withColumn("segment", F.regexp_extract("email", "@([a-z]+)", 1))
        u.repartition(files_for(spark, d, "customer", minimum=2)).write.options(**_TS).partitionBy("segment").json(p)
        return p
    return _land(spark, d, "users_json", build)


def events_json(spark: SparkSession, d: str) -> str:
    def build():
        p = scratch_dir(spark, "events-json")
        ingest.deal(fx.events_nested(spark, d), files_for(spark, d, "events", minimum=4)).write.json(p)
        return p
    return _land(spark, d, "events_json", build)


def events_raw_json(spark: SparkSession, d: str) -> str:
    """The message envelope as JSON (binary columns become base64 text)."""
    def build():
        p = scratch_dir(spark, "events-raw-json")
        ingest.deal(fx.events_raw(spark, d), files_for(spark, d, "events", minimum=4)).write.json(p)
        return p
    return _land(spark, d, "events_raw_json", build)


_USERS_SQL = "SELECT user_id, user_first_touch_timestamp, email, updated FROM users"


@register("src01_single_file_by_path", """
SELECT user_id, user_first_touch_timestamp, email FROM users WHERE email LIKE '%@building.com'""")
def src01(spark, d):
    base = users_by_segment_json(spark, d)
    return spark.sql(f"SELECT user_id, user_first_touch_timestamp, email FROM json.`{base}/segment=building/*.json`")


@register("src02_directory_of_files", """
SELECT user_id, user_first_touch_timestamp, email,
  CASE WHEN email IS NULL THEN NULL ELSE regexp_extract(email, '@([a-z]+)', 1) END AS segment FROM users""")
def src02(spark, d):
    df = spark.read.json(users_by_segment_json(spark, d))
    return df.select("user_id", "user_first_touch_timestamp", "email", F.col("segment").cast("string"))


@register("src03_text_lines", """
SELECT event_id, event_name FROM events_nested""")
def src03(spark, d):
    t = spark.read.text(events_json(spark, d))
    return t.select(F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"),
                    F.get_json_object("value", "$.event_name").alias("event_name"))


@register("src04_binary_files")
def src04(spark, d):
    """path, modificationTime, length, content of every data file (rows-only)."""
    b = files.read_binary(spark, events_json(spark, d), "*.json")
    return b.select("path", "modificationTime", "length", F.length("content").alias("content_bytes"))


@register("src04_binary_content", """
SELECT event_id, event_name, user_id FROM events_nested""")
def src04_content(spark, d):
    """The bytes of whole files decoded, cut into lines and parsed: every record is there once."""
    lines = (files.read_binary(spark, events_json(spark, d), "*.json")
             .select(F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("line")).where("line <> ''"))
    return lines.select(F.from_json("line", "event_id BIGINT, event_name STRING, user_id STRING").alias("e")).select("e.*")


@register("src05_parquet_by_path", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def src05(spark, d):
    return spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")


@register("src06_csv_option_chain", _USERS_SQL)
def src06(spark, d):
    df = (spark.read.option("sep", "\t").option("header", True).option("inferSchema", True)
          .csv(users_csv(spark, d)))
    return df.select(F.col("user_id").cast("string"), F.col("user_first_touch_timestamp").cast("bigint"),
                     "email", F.col("updated").cast("timestamp_ntz"))


@register("src07_csv_keyword_args", _USERS_SQL)
def src07(spark, d):
    df = spark.read.csv(users_csv(spark, d), sep="\t", header=True, inferSchema=True)
    return df.select(F.col("user_id").cast("string"), F.col("user_first_touch_timestamp").cast("bigint"),
                     "email", F.col("updated").cast("timestamp_ntz"))


@register("src08_naive_csv")
def src08(spark, d):
    """No options: the header is a data row and each line is one wide column."""
    return spark.read.csv(users_csv(spark, d))


@register("src08_naive_csv_lines", """
SELECT 'user_id' || chr(9) || 'user_first_touch_timestamp' || chr(9) || 'email' || chr(9) || 'updated' AS line
UNION ALL SELECT user_id || chr(9) || user_first_touch_timestamp || chr(9) || coalesce(email, '') || chr(9)
  || strftime(updated, '%Y-%m-%dT%H:%M:%S.%f') FROM users""")
def src08_lines(spark, d):
    """The naive scan's lines, the header of the files once: every field of a row is in its one wide column."""
    return spark.read.csv(users_csv(spark, d)).select(F.col("_c0").alias("line")).distinct()


@register("src09_struct_type_schema", _USERS_SQL)
def src09(spark, d):
    return files.read_csv(spark, users_csv(spark, d), sep="\t", schema=USERS_SCHEMA, options=_TS)


@register("src10_ddl_schema", _USERS_SQL)
def src10(spark, d):
    return files.read_csv(spark, users_csv(spark, d), sep="\t", schema=USERS_DDL, options=_TS)


@register("src11_nested_schema", """
SELECT event_id, geo.city AS city, ecommerce.purchase_revenue_in_usd AS revenue, CAST(len(items) AS INTEGER) AS n_items,
       items[1].item_id AS first_item FROM events_nested""")
def src11(spark, d):
    df = files.read_json(spark, events_json(spark, d), EVENTS_SCHEMA)
    return df.select("event_id", F.col("geo.city").alias("city"),
                     F.col("ecommerce.purchase_revenue_in_usd").alias("revenue"),
                     F.size("items").alias("n_items"), F.get("items", 0)["item_id"].alias("first_item"))


@register("src12_json_inferred", """
SELECT event_id, device, event_name, traffic_source, CAST(user_id AS BIGINT) AS user_id FROM events_nested""")
def src12(spark, d):
    df = spark.read.json(events_json(spark, d))
    return df.select("event_id", "device", "event_name", "traffic_source",
                     F.col("user_id").cast("bigint").alias("user_id"))


@register("src13_schema_as_ddl", """
SELECT '`device` string, `ecommerce` struct<purchase_revenue_in_usd:double,total_item_quantity:bigint,unique_items:bigint>, '
  || '`event_id` bigint, `event_name` string, `event_timestamp` bigint, `geo` struct<city:string,state:string>, '
  || '`items` array<struct<coupon:string,item_id:string,item_name:string,item_revenue_in_usd:double,price_in_usd:double,'
  || 'quantity:bigint>>, `traffic_source` string, `user_id` string' AS ddl, count(*) AS rows FROM events""")
def src13(spark, d):
    """Infer once, keep the DDL, read every file again with it."""
    ddl = files.schema_ddl(spark.read.json(events_json(spark, d)))
    df = spark.read.schema(ddl).json(events_json(spark, d))
    return df.agg(F.lit(ddl).alias("ddl"), F.count(F.lit(1)).alias("rows"))


def _uid() -> str:
    return uuid.uuid4().hex[:10]


@register("src14_external_csv_table", _USERS_SQL)
def src14(spark, d):
    name = f"users_ext_{_uid()}"
    spark.sql(f"""CREATE TABLE {name} ({USERS_DDL}) USING CSV
                  OPTIONS (header = "true", sep = "\\t", timestampNTZFormat = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
                  LOCATION '{users_csv(spark, d)}'""")
    return spark.table(name)


@register("src15_external_json_binary", """
SELECT event_id AS "offset", user_id AS key_text FROM events_nested""")
def src15(spark, d):
    name = f"events_raw_{_uid()}"
    spark.sql(f"""CREATE TABLE {name} (key BINARY, offset BIGINT, partition INT, timestamp BIGINT,
                  topic STRING, value BINARY) USING JSON LOCATION '{events_raw_json(spark, d)}'""")
    return spark.table(name).select("offset", F.col("key").cast("string").alias("key_text"))


@register("src16_temp_view_csv_failfast", _USERS_SQL)
def src16(spark, d):
    view = f"users_csv_{_uid()}"
    spark.sql(f"""CREATE OR REPLACE TEMPORARY VIEW {view} ({USERS_DDL}) USING CSV
                  OPTIONS (path = '{users_csv(spark, d)}', header = "true", sep = "\\t", mode = "FAILFAST",
                           timestampNTZFormat = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")""")
    return spark.table(view)


@register("src17_refresh_after_outside_append", """
SELECT 'before' AS state, count(*) AS rows FROM users UNION ALL
SELECT 'after_refresh', 2 * count(*) FROM users""")
def src17(spark, d):
    """Counts of a cached table before an outside append and after the REFRESH that follows it.

    In between a reader may see either; it never sees more than REFRESH does.
    """
    p = scratch_dir(spark, "refresh")
    fx.users(spark, d).write.parquet(p)
    name = f"users_ref_{_uid()}"
    spark.sql(f"CREATE TABLE {name} USING PARQUET LOCATION '{p}'")
    spark.sql(f"CACHE TABLE {name}")
    before = spark.table(name).count()
    fx.users(spark, d).write.mode("append").parquet(p)
    stale = spark.table(name).count()
    spark.catalog.refreshTable(name)
    fresh = spark.table(name).count()
    spark.sql(f"UNCACHE TABLE {name}")
    assert before <= stale <= fresh
    return spark.createDataFrame([("before", before), ("after_refresh", fresh)], "state string, rows bigint")


@register("src20_named_table_scan", "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def src20(spark, d):
    view = f"geo_{_uid()}"
    (table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
     .select("n_nationkey", "n_name", "r_name").createOrReplaceGlobalTempView(view))
    return spark.read.table(f"global_temp.{view}")


@register("src21_range_source", """
SELECT k AS missing_orderkey FROM range(0, (SELECT max(o_orderkey) + 1 FROM orders)) t(k)
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = k)""")
def src21(spark, d):
    """Gaps in the order keys: a key range sized from the data, anti-joined to orders."""
    o = table(spark, d, "orders")
    hi = o.agg(F.max("o_orderkey")).first()[0]
    keys = spark.range(0, hi + 1).withColumnRenamed("id", "missing_orderkey")
    return keys.join(o, keys.missing_orderkey == o.o_orderkey, "left_anti")


@register("src22_local_rows_typed", """
SELECT * FROM users UNION ALL
SELECT CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS TIMESTAMP)""")
def src22(spark, d):
    nulls = spark.createDataFrame([(None, None, None, None)], USERS_DDL)
    return fx.users(spark, d).unionByName(nulls)


@register("src23_values_view", """
SELECT c_custkey, c_mktsegment, v.discount FROM customer c JOIN (VALUES ('BUILDING', 0.1::DOUBLE),
  ('MACHINERY', 0.2::DOUBLE), ('AUTOMOBILE', 0.05::DOUBLE)) v(segment, discount) ON c.c_mktsegment = v.segment""")
def src23(spark, d):
    view = f"seg_{_uid()}"
    spark.sql(f"""CREATE OR REPLACE TEMP VIEW {view}(segment, discount) AS VALUES
                  ('BUILDING', 0.1D), ('MACHINERY', 0.2D), ('AUTOMOBILE', 0.05D)""")
    c = table(spark, d, "customer")
    v = spark.table(view)
    return c.join(v, c.c_mktsegment == v.segment).select("c_custkey", "c_mktsegment", "discount")


@register("src24_views_and_cte_over_files", """
SELECT count(*) AS n, count(email) AS with_email FROM users""")
def src24(spark, d):
    path = users_by_segment_json(spark, d)
    tv = f"users_tv_{_uid()}"
    spark.sql(f"CREATE OR REPLACE TEMP VIEW {tv} AS SELECT * FROM json.`{path}`")
    pv = f"users_pv_{_uid()}"
    spark.sql(f"CREATE VIEW {pv} AS SELECT * FROM json.`{path}`")
    a = spark.sql(f"WITH cte AS (SELECT * FROM {tv}) SELECT count(*) AS n, count(email) AS with_email FROM cte")
    b = spark.sql(f"SELECT count(*) AS n, count(email) AS with_email FROM {pv}")
    return a.union(b).distinct()


@register("src25_dataframe_to_sql", """
SELECT traffic_source, count(*) AS events FROM events_nested GROUP BY traffic_source""")
def src25(spark, d):
    view = f"ev_{_uid()}"
    fx.events_nested(spark, d).createOrReplaceTempView(view)
    return spark.sql(f"SELECT traffic_source, count(*) AS events FROM {view} GROUP BY traffic_source")


@register("src26_provenance_columns", """
SELECT event_id, true AS from_landing, true AS loaded_now FROM events_nested""")
def src26(spark, d):
    """Load time and source file per row: the file lies in the landing folder, the time is this run's."""
    landing = events_json(spark, d)
    rows = files.with_provenance(spark.read.json(landing))
    folder = landing.rstrip("/").rsplit("/", 1)[1]
    now = F.abs(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(F.col("processing_time").cast("timestamp")))
    return rows.select("event_id", F.col("source_file").contains(f"/{folder}/").alias("from_landing"), (now < 3600).alias("loaded_now"))


@register("src27_directory_listing")
def src27(spark, d):
    """Files and bytes per partition directory of a partitioned table (rows-only)."""
    return files.directory_summary(spark, users_by_segment_json(spark, d))


@register("src27_listing_matches_scan", """
SELECT split_part(split_part(email, '@', 2), '.', 1) AS segment, count(*) AS rows, true AS same_files, true AS same_bytes
FROM users GROUP BY ALL""")
def src27_scan(spark, d):
    """Per partition directory: the listed files and bytes are those that a scan of the table reads."""
    path = users_by_segment_json(spark, d)
    key = r"([^/]+/[^/]+)$"
    listed = files.list_files(spark, path).select(F.regexp_extract("path", key, 1).alias("file"), "length")
    read = (spark.read.json(path).select("segment", "_metadata.file_path", "_metadata.file_size")
            .groupBy("segment", F.regexp_extract("file_path", key, 1).alias("file"), "file_size").count())
    both = read.join(listed, "file", "full")
    return both.groupBy("segment").agg(F.sum("count").alias("rows"), F.every(F.col("length").isNotNull() & F.col("file_size").isNotNull())
                                       .alias("same_files"), F.every(F.col("length").eqNullSafe(F.col("file_size"))).alias("same_bytes"))


@register("src28_message_envelope", """
SELECT user_id AS key, event_id AS "offset", CAST(event_id % 2 AS INTEGER) AS partition, 'clickstream' AS topic,
  event_name FROM events_nested""")
def src28(spark, d):
    schema = "key BINARY, offset BIGINT, partition INT, timestamp BIGINT, topic STRING, value BINARY"
    raw = spark.read.schema(schema).json(events_raw_json(spark, d))
    return raw.select(F.col("key").cast("string").alias("key"), "offset", "partition", "topic",
                      F.get_json_object(F.col("value").cast("string"), "$.event_name").alias("event_name"))


def _stream_to_table(spark, stream, label: str):
    root = scratch_dir(spark, label)
    ingest.run_available_now(stream, f"{root}/sink", f"{root}/ckpt")
    return spark.read.parquet(f"{root}/sink")


@register("src29_incremental_file_stream", """
SELECT order_id, customer_id, notifications, order_timestamp FROM orders_feed""")
def src29(spark, d):
    s = ingest.cloud_files(spark, landed(spark, d, "orders"), "json")
    return _stream_to_table(spark, s, "src29").select("order_id", "customer_id", "notifications", "order_timestamp")


@register("src30_stream_no_type_inference", """
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id FROM orders_feed""")
def src30(spark, d):
    s = ingest.cloud_files(spark, landed(spark, d, "orders"), "json", infer_types=False)
    out = _stream_to_table(spark, s, "src30")
    assert dict(out.dtypes)["order_id"] == "string"
    return out.select("order_id", "customer_id")


@register("src31_schema_hints", """
SELECT device_id, time, heartrate FROM recordings""")
def src31(spark, d):
    s = ingest.cloud_files(spark, landed(spark, d, "recordings"), "json", infer_types=False,
                           schema_hints="time DOUBLE, heartrate DOUBLE")
    out = _stream_to_table(spark, s, "src31")
    assert dict(out.dtypes)["time"] == "double"
    return out.select("device_id", "time", "heartrate")


@register("src32_rescued_data", """
SELECT order_id,
  '{"order_status":"' || order_status || '"' || CASE WHEN order_id % 5 = 0 THEN ',"note":"late"' ELSE '' END || '}'
    AS _rescued_data
FROM status_feed""")
def src32(spark, d):
    """Declared INT for a text field plus an undeclared field: both land in _rescued_data."""
    def build():
        p = scratch_dir(spark, "status-extra")
        extra = fx.status_feed(spark, d).withColumn(
            "note", F.when(F.col("order_id") % 5 == 0, F.lit("late")))
        ingest.land_files(extra, p, "json", n_files=files_for(spark, d, "orders", minimum=4), order_by="order_id")
        return p
    path = _land(spark, d, "status_extra", build)
    s = ingest.cloud_files(spark, path, "json",
                           schema="order_id BIGINT, order_status INT, status_timestamp BIGINT")
    return _stream_to_table(spark, s, "src32").select("order_id", "_rescued_data")


@register("src32_rescued_nested_data", """
SELECT order_id, '{"ship.note":"n' || CAST(order_id AS VARCHAR) || '","lines[' || CAST(order_id % 3 AS VARCHAR) || '].qty":"many"}' AS _rescued_data
FROM status_feed""")
def src32_nested(spark, d):
    """A misfit inside an array of structs and an unknown nested field are rescued by their paths."""
    def build():
        p = scratch_dir(spark, "status-nested")
        line = lambda k: F.struct(F.when(F.col("order_id") % 3 == k, "many").otherwise(F.lit(str(k))).alias("qty"))
        nested = F.struct("order_id", F.struct(F.concat(F.lit("n"), "order_id").alias("note"), F.lit("x").alias("mode")).alias("ship"),
                          F.array(*[line(k) for k in range(3)]).alias("lines"))
        # quantities as numbers, but for the misfits
        text = F.regexp_replace(F.to_json(nested), '"qty":"([0-9]+)"', '"qty":$1')
        ingest.deal(fx.status_feed(spark, d).select(text.alias("value")), files_for(spark, d, "orders", minimum=4)).write.text(p)
        return p
    s = ingest.cloud_files(spark, _land(spark, d, "status_nested", build), "json",
                           schema="order_id BIGINT, ship STRUCT<mode: STRING>, lines ARRAY<STRUCT<qty: INT>>")
    return _stream_to_table(spark, s, "src32n").select("order_id", "_rescued_data")


@register("src30_schema_stored_and_evolved", """
SELECT order_id, 1 AS run, CAST(NULL AS VARCHAR) AS note, CAST(NULL AS VARCHAR) AS _rescued_data FROM status_feed
UNION ALL
SELECT order_id, 2, NULL, '{"note":"n' || CAST(order_id AS VARCHAR) || '"}' FROM status_feed
UNION ALL
SELECT order_id, 3, 'n' || CAST(order_id AS VARCHAR), NULL FROM status_feed""")
def src30_evolved(spark, d):
    """Three runs of one stream: the schema is stored, a new field is rescued, then it is a column."""
    root = scratch_dir(spark, "evolving")
    feed = fx.status_feed(spark, d).select("order_id")
    added = []
    for k in (1, 2, 3):
        rows = feed.withColumn("run", F.lit(k))
        if k > 1:
            rows = rows.withColumn("note", F.concat(F.lit("n"), "order_id"))
        ingest.land_files(rows, f"{root}/in", "json", n_files=files_for(spark, d, "orders", minimum=2), mode="append")
        added.append(ingest.run_evolving(spark, f"{root}/in", f"{root}/sink", f"{root}/schema", f"{root}/ckpt", schema_hints="run INT"))
    assert added == [[], ["note"], []], added
    return ingest.read_evolved(spark, f"{root}/sink").select("order_id", "run", "note", "_rescued_data")


@register("src33_csv_stream_header", """
SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer""")
def src33(spark, d):
    s = ingest.cloud_files(spark, landed(spark, d, "retail_customers"), "csv", infer_types=True)
    return _stream_to_table(spark, s, "src33").select(F.col("customer_id").cast("bigint"), "customer_name")


@register("src33_csv_stream_no_header")
def src33_no_header(spark, d):
    """Without header the header line is a data row and columns are _c0.. (rows-only)."""
    schema = ingest.infer_schema(spark, landed(spark, d, "retail_customers"), "csv", infer_types=False,
                                 options={"header": False})
    s = ingest.read_csv_stream(spark, landed(spark, d, "retail_customers"), schema, header=False)
    return _stream_to_table(spark, s, "src33b")


@register("src33_csv_stream_no_header_lines", """
SELECT 'customer_id' AS _c0, 'customer_name' AS _c1, 'state' AS _c2, 'city' AS _c3, 'lon' AS _c4, 'lat' AS _c5,
  'units_purchased' AS _c6, 'loyalty_segment' AS _c7
UNION ALL SELECT CAST(customer_id AS VARCHAR), customer_name, state, city, CAST(lon AS VARCHAR), CAST(lat AS VARCHAR),
  CAST(units_purchased AS VARCHAR), CAST(loyalty_segment AS VARCHAR) FROM retail_customers""")
def src33_no_header_lines(spark, d):
    """The header-less stream's rows, the files' header line once."""
    return src33_no_header(spark, d).drop("source_file").distinct()


@register("src34_replayed_feed_one_file_per_trigger", """
SELECT order_id, order_status, status_timestamp FROM status_feed""")
def src34(spark, d):
    """Replay a landed feed one file per micro-batch; all rows arrive, once."""
    path = landed(spark, d, "status")
    schema = ingest.infer_schema(spark, path, "json")
    s = ingest.read_json_stream(spark, path, schema, max_files_per_trigger=1)
    root = scratch_dir(spark, "replay")
    batches = [p for p in ingest.run_available_now(s.drop("source_file"), f"{root}/sink", f"{root}/ckpt")
               if p.numInputRows]
    assert len(batches) >= 2, "one file per trigger must give several micro-batches"
    out = spark.read.parquet(f"{root}/sink")
    assert out.where("_rescued_data IS NOT NULL").isEmpty()
    return out.drop("_rescued_data")


@register("src35_table_by_path", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS value, c_mktsegment AS segment, c_nationkey AS nation
FROM customer""")
def src35(spark, d):
    root = scratch_dir(spark, "by-path")
    versions.commit(spark, root, table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("value"),
        F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")), "CREATE TABLE AS SELECT")
    by_api = versions.snapshot_read(spark, root)
    by_sql = spark.sql(f"SELECT * FROM parquet.`{versions.snapshot_path(root, 0)}`")
    assert by_api.exceptAll(by_sql).isEmpty()
    return by_sql
