"""Exact dedup against a persistent digest index.

Two texts are equal when they are the same after deleting every character of
``[\\x20\\x09-\\x0D]``; they are compared by the SHA-256 of that form.  The
index is a table bucketed and sorted by digest, so a batch is looked up by a
sort-merge anti-join that shuffles only the batch, and then appended.

A batch has an id.  What the index holds of the same id does not count when
the batch is looked up, and digests the index has are not appended again; so a
batch that is run again after a lost driver or a failed next step gives the
same result and leaves the index as it was.

Defined results: a null text counts as the empty text (all empty texts are
copies of each other); a null doc_id loses ties; repeated rows (same doc_id,
same text) are told apart by a row id, one of them stays; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import BLANKS, hot_join, save, with_row_id, without_rows
from quarry.session import scratch_dir

_COLUMNS = "digest STRING, keep_id BIGINT, keep_rid BIGINT, points BIGINT, copies BIGINT, batch STRING"


def digest(text: Column) -> Column:
    """SHA-256 (lower-case hex) of the text without white space."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), BLANKS, "").cast("binary"), 256)


class DigestIndex:
    """Digests seen so far, in a folder bucketed and sorted by digest.

    A new index gets as many buckets as the session has shuffle partitions, so
    an append is one task, one bucket, one file.  The count is stored beside
    the data (``<path>/meta``) and read back when the index is opened again,
    so hashing never changes under the data.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.table = f"digest_index_{uuid.uuid4().hex}"
        jvm = spark.sparkContext._jvm
        meta = jvm.org.apache.hadoop.fs.Path(f"{self.path}/meta/_SUCCESS")
        fs = meta.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(meta):
            buckets = spark.read.parquet(f"{self.path}/meta").first()["buckets"]
        else:
            buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(f"{self.path}/meta")
        self.buckets = buckets
        spark.sql(f"CREATE TABLE {self.table} ({_COLUMNS}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) "
                  f"INTO {buckets} BUCKETS LOCATION '{self.path}/data'")

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, winners: DataFrame) -> None:
        """Add a batch; one task per bucket writes one sorted file."""
        (winners.repartition(self.buckets, "digest").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table))
        self.spark.catalog.refreshTable(self.table)

    def close(self) -> None:
        """Forget the catalogue entry; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def deduplicate(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """One row per document: rid, doc_id, keep_id, group_size, kept, text_sha256.

    Within the batch the text with the most code points stays, then the
    smallest doc_id, then the first row; a text the index already has loses to
    the index.  ``group_size`` counts the batch's copies and those the index
    counted.  The batch's new digests are appended to ``index``.  ``batch``
    names the batch, the same name in every attempt; without one the call is a
    batch of its own, and its repetition finds copies.
    """
    batch = batch or uuid.uuid4().hex
    rows = with_row_id(docs.select("doc_id", "text")).select(
        "rid", "doc_id", digest(F.col("text")).alias("digest"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("points"))
    rows = save(rows, "digests")
    # a partial maximum per map task, so a group of copies shuffles one row a task
    rank = F.struct((-F.col("points")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    best = save(rows.groupBy("digest").agg(F.min(rank).alias("b"), F.count("*").alias("copies"))
                .select("digest", F.col("b.doc_id").alias("keep_id"), F.col("b.rid").alias("keep_rid"),
                        (-F.col("b.less")).alias("points"), "copies"), "winners")
    known = index.read()
    new = best.join(known.hint("merge"), "digest", "left_anti")
    old = known.where(F.col("batch") != batch).groupBy("digest").agg(F.min_by("keep_id", "batch").alias("old_id"), F.sum("copies").alias("before"))
    verdict = save(best.join(old, "digest", "left").select(
        "digest", F.when(F.col("before").isNull(), F.col("keep_id")).otherwise(F.col("old_id")).alias("keep_id"),
        F.when(F.col("before").isNull(), F.col("keep_rid")).alias("keep_rid"),
        (F.col("copies") + F.coalesce("before", F.lit(0))).alias("group_size"), "copies"), "verdicts")
    index.append(new.withColumn("batch", F.lit(batch)).select("digest", "keep_id", "keep_rid", "points", "copies", "batch"))
    return hot_join(rows, verdict, "digest", "copies").select(
        "rid", "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("rid") == F.col("keep_rid"), F.lit(False)).alias("kept"), F.col("digest").alias("text_sha256"))


def new_index(spark: SparkSession, label: str = "digest-index", buckets: int | None = None) -> DigestIndex:
    """An empty index in a fresh folder of the shared checkpoint directory."""
    return DigestIndex(spark, scratch_dir(spark, label), buckets)


def keep_first(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """The documents that stay, with all their columns."""
    return without_rows(docs, deduplicate(docs, index, batch).where("NOT kept").select(F.col("rid").alias("__rid")))
