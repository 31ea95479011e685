"""Access to the base parquet tables.

Tables are read lazily; Catalyst prunes columns and pushes filters into the
parquet scan, so callers never need to pre-select.

The schemas of the base tables are declared, so a read needs no footer
inference job, and the DataFrame of each path is built once per session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)
# The declared schemas of the base tables.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}

_CACHE: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one base table, ``{sf_dir}/{name}.parquet``."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _CACHE.get(key)
    if df is None:
        df = _CACHE[key] = spark.read.schema(SCHEMAS[name]).parquet(path)
    return df


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Expose every base table as a temp view of the same name."""
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def table_bytes(spark: SparkSession, sf_dir: str, *names: str) -> int:
    """On-disk size of base tables (file-system metadata, nothing is read)."""
    from quarry.sources import fs
    return sum(fs.path_bytes(spark, f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names)


#: Rows of a file that is derived from a table: tens of MB as text, a few hundred bytes a row.
ROWS_PER_FILE = 100_000


def files_for(spark: SparkSession, sf_dir: str, *names: str, minimum: int = 1,
              target_bytes: int = 128 * 1024 * 1024) -> int:
    """Output files / partitions for data derived from ``names``: ~target_bytes of them, ~ROWS_PER_FILE rows of the last each.

    Keeps writers proportional to the data: a handful at test scale, tens of
    thousands at 100 TB (never a fixed small count that funnels everything
    through a few tasks).  The last table is the one whose rows are written; the
    rows bound a file, since text can take thirty times the bytes of its encoded
    source.  They are counted from the file footers.
    """
    rows = table(spark, sf_dir, names[-1]).count()
    return max(minimum, -(-table_bytes(spark, sf_dir, *names) // target_bytes), -(-rows // ROWS_PER_FILE))
