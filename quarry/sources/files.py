"""File readers and listings as thin, explicit Spark reader calls.

Prefer a declared schema: inference costs a full extra pass over the files
(``inferSchema`` / JSON sampling), which at scale is a second full read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, sep: str = ",", header: bool = True,
             infer_schema: bool = False, schema: StructType | str | None = None,
             mode: str = "PERMISSIVE", corrupt_column: str | None = None,
             options: Mapping[str, str] | None = None) -> DataFrame:
    """CSV scan with the options of the lessons (separator, header, inference, read mode).

    ``mode``: PERMISSIVE keeps malformed lines (NULL fields, raw line in
    ``corrupt_column``), DROPMALFORMED drops them, FAILFAST aborts the job.
    """
    r = (spark.read.option("sep", sep).option("header", header).option("mode", mode)
         .options(**(options or {})))
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", infer_schema)
    if corrupt_column:
        r = r.option("columnNameOfCorruptRecord", corrupt_column)
    return r.csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              mode: str = "PERMISSIVE", corrupt_column: str | None = None) -> DataFrame:
    """JSON lines scan; a declared schema (StructType or DDL) skips inference."""
    r = spark.read.option("mode", mode)
    if corrupt_column:
        r = r.option("columnNameOfCorruptRecord", corrupt_column)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def schema_ddl(df: DataFrame) -> str:
    """A DataFrame's schema as a reusable DDL string (``a BIGINT, b STRUCT<..>``)."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def with_provenance(df: DataFrame) -> DataFrame:
    """Add load time and source file of every row (``_metadata`` of file sources)."""
    return df.select("*", F.current_timestamp().alias("processing_time"),
                     F.col("_metadata.file_path").alias("source_file"))


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files under ``path`` (path, modificationTime, length), content not read.

    A ``binaryFile`` scan with the ``content`` column pruned: Spark lists and
    stats the files in parallel and never opens them.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", "modificationTime", "length")


def directory_summary(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """File count and bytes per directory (partition directories show separately)."""
    files = list_files(spark, path, glob)
    parent = F.regexp_replace("path", "/[^/]*$", "")
    return (files.groupBy(parent.alias("directory"))
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")))


def read_binary(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Whole files as rows: path, modificationTime, length, content (bytes)."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def read_jdbc_partitioned(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int,
                          num_partitions: int, properties: Mapping[str, str] | None = None) -> DataFrame:
    """Range-partitioned JDBC read: ``num_partitions`` parallel range queries on ``column``.

    Filters on the result are pushed into the database's WHERE clause.
    (Needs a JDBC driver and a database reachable from every executor.)
    """
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions, properties=dict(properties or {}))
