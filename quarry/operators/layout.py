"""Physical layout jobs: small-file compaction and Z-order clustering.

Both rewrite one snapshot into a new version (``versions.commit``); the rows
are unchanged, only their placement in files differs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DateType, StringType, TimestampNTZType, TimestampType

from quarry.operators import versions
from quarry.session import scratch_dir
from quarry.sources import fs


def compaction_plan(spark: SparkSession, root: str, version: int | None = None,
                    target_file_bytes: int = 128 * 1024 * 1024) -> tuple[int, int, int]:
    """(num_files, total_bytes, files_after) for a version, from a listing only."""
    if version is None:
        version = versions.latest_version(spark, root)
    # a clone has no files of its own: its source's count
    row = versions.detail(spark, *versions._resolve_source(spark, root, version)).first()
    total = int(row["size_in_bytes"])
    return int(row["num_files"]), total, max(1, math.ceil(total / target_file_bytes))


def compact(spark: SparkSession, root: str, version: int | None = None,
            target_file_bytes: int = 128 * 1024 * 1024) -> int:
    """OPTIMIZE: rewrite a version into ~target-sized files (a new version).

    ``repartition(n)`` is a round-robin shuffle, so output files are even in
    size whatever the skew of the input files.
    """
    if version is None:
        version = versions.latest_version(spark, root)
    n_before, total, n_after = compaction_plan(spark, root, version, target_file_bytes)
    df = versions.snapshot_read(spark, root, version).repartition(n_after)
    return versions.commit(spark, root, df, "OPTIMIZE",
                           {"files_before": n_before, "files_after": n_after, "bytes": total})


#: Files below this share of the target size are small.
SMALL = 0.75


def small_files(spark: SparkSession, path: str, target_file_bytes: int = 128 * 1024 * 1024) -> DataFrame:
    """Rows ``(file, directory, bytes, bin)``: the small files, packed per directory.

    The files come from the metadata columns of the scan, with a filter on their
    size, so larger files are pruned from the listing and not opened.  Packing
    is a running sum over a directory's files, largest first: a bin is what
    falls into one target size.  Bins of a single file are left out.
    """
    files = (spark.read.option("recursiveFileLookup", True).parquet(path)
             .where(F.col("_metadata.file_size") < F.lit(int(target_file_bytes * SMALL)))
             .groupBy(F.col("_metadata.file_path").alias("file")).agg(F.first(F.col("_metadata.file_size")).alias("bytes")))
    directory = Window.partitionBy("directory")
    before = F.sum("bytes").over(directory.orderBy(F.desc("bytes"), "file").rowsBetween(Window.unboundedPreceding, -1))
    packed = files.withColumn("directory", F.regexp_extract("file", "^(.*)/", 1)).withColumn(
        "bin", F.floor(F.coalesce(before, F.lit(0)) / F.lit(target_file_bytes)))
    mates = F.count("*").over(Window.partitionBy("directory", "bin"))
    return packed.withColumn("mates", mates).where("mates > 1").drop("mates")


def compact_files(spark: SparkSession, path: str, target_file_bytes: int = 128 * 1024 * 1024) -> dict[str, int]:
    """Merge the small files below ``path`` (a folder, partitioned or not) into files of about the target size.

    Only rows of small files are read and written; a file of the target size
    stays as it is.  The plan and the new files are written to a scratch folder
    first; ``swap_files`` then moves them in and removes the old ones, and can
    be run again with the same folder if it was cut off.  A reader that lists
    the folder during the swap may see rows of a bin in both files, so readers
    should be between runs.
    """
    staged = scratch_dir(spark, "compaction")
    small_files(spark, path, target_file_bytes).write.parquet(f"{staged}/plan")
    plan = spark.read.parquet(f"{staged}/plan")
    if plan.isEmpty():
        return {"files_before": 0, "files_after": 0}
    rows = (spark.read.option("recursiveFileLookup", True).parquet(path)
            .where(F.col("_metadata.file_size") < F.lit(int(target_file_bytes * SMALL)))
            .select("*", F.col("_metadata.file_path").alias("__file")))
    where = plan.select(F.col("file").alias("__file"), F.concat_ws("#", "directory", "bin").alias("__bin"))
    # one bin is one task and one file; its size is the target's
    (rows.join(where, "__file").drop("__file").repartition("__bin").write.partitionBy("__bin").parquet(f"{staged}/data"))
    return swap_files(spark, staged)


def swap_files(spark: SparkSession, staged: str) -> dict[str, int]:
    """Move the staged files of every bin to its directory, then remove the files they replace."""
    plan = spark.read.parquet(f"{staged}/plan")
    if not fs.exists(spark, f"{staged}/data/_SUCCESS"):
        raise ValueError(f"{staged} holds no finished compaction")
    new = spark.read.schema("__bin string").parquet(f"{staged}/data").select(F.col("_metadata.file_path").alias("file"), "__bin").distinct()
    moved = removed = 0
    # file names, as many as the driver lists anyway
    for r in new.toLocalIterator():
        directory, number = r["__bin"].rsplit("#", 1)
        fs.move(spark, r["file"], f"{directory}/compact-{number}-{r['file'].rsplit('/', 1)[1]}")  # one task may write many bins
        moved += 1
    for r in plan.select("file").toLocalIterator():
        removed += fs.delete(spark, fs.decoded(r["file"]))
    return {"files_before": removed, "files_after": moved}


def sort_rank(df: DataFrame, column: str):
    """A number in the order of a column: itself, its time, or the first six bytes of its text."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, (StringType, BinaryType)):
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    return c.cast("double")


def with_z_value(df: DataFrame, columns: Sequence[str], bits: int, out: str = "__z") -> DataFrame:
    """Add a bit-interleaved Morton key over quantile ranks of ``columns``.

    Quantile boundaries come from ``approxQuantile`` (one pass; 2**bits - 1
    numbers per column).  Each value's rank is found by the JVM ``Bucketizer``
    (a binary search over the boundaries), then the rank bits are interleaved
    with shifts and masks.  No Python per row and no global window.
    """
    from pyspark.ml.feature import Bucketizer

    n = 2 ** bits
    tmp_in = [f"__zin{i}" for i in range(len(columns))]
    tmp_out = [f"__zb{i}" for i in range(len(columns))]
    staged = df.select("*", *[F.coalesce(sort_rank(df, c), F.lit(float("nan"))).alias(t)
                              for c, t in zip(columns, tmp_in)])
    bounds = staged.approxQuantile(tmp_in, [i / n for i in range(1, n)], 1 / (4 * n))
    splits = [[float("-inf"), *sorted(set(b)), float("inf")] for b in bounds]
    ranked = Bucketizer(splitsArray=splits, inputCols=tmp_in, outputCols=tmp_out,
                        handleInvalid="keep").transform(staged)
    k = len(columns)
    z = F.lit(0).cast("long")
    for bit in range(bits):
        for i, col in enumerate(tmp_out):
            rank = F.least(F.col(col).cast("long"), F.lit(n - 1))
            z = z + F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), bit * k + i)
    return ranked.withColumn(out, z).drop(*tmp_in, *tmp_out)


def zorder(spark: SparkSession, root: str, columns: Sequence[str], version: int | None = None,
           num_files: int | None = None) -> int:
    """OPTIMIZE .. ZORDER BY (columns): range-partition on the Morton key.

    Nearby values of all the columns land in the same files, so parquet
    row-group min/max statistics skip more files for filters on any of them.
    The grid has about four cells a file, and a hash of the row is the second
    range key, so a cell that holds many equal values is split as well.
    """
    if version is None:
        version = versions.latest_version(spark, root)
    df = versions.snapshot_read(spark, root, version)
    if num_files is None:
        num_files = compaction_plan(spark, root, version)[2]
    if len(columns) == 1:
        # the order of one column is its own: Spark's sampled range bounds, nothing on the driver that grows
        out = (df.withColumn("__h", F.xxhash64(*df.columns)).repartitionByRange(num_files, columns[0], "__h")
               .sortWithinPartitions(columns[0], "__h").drop("__h"))
        return versions.commit(spark, root, out, "OPTIMIZE", {"zOrderBy": list(columns), "files_after": num_files})
    # with two columns and more, 2 ** bits is at most twice the square root of the files
    bits = max(4, math.ceil((math.log2(num_files) + 2) / len(columns)))
    out = (with_z_value(df, columns, bits).withColumn("__h", F.xxhash64(*df.columns))
           .repartitionByRange(num_files, "__z", "__h").sortWithinPartitions("__z", "__h").drop("__z", "__h"))
    return versions.commit(spark, root, out, "OPTIMIZE", {"zOrderBy": list(columns), "files_after": num_files})
