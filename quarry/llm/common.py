"""Shared helpers: written intermediates, row ids, hot-key joins, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import scratch_dir

#: Rows that one join key may hold before it is joined by broadcast, as a share of all rows.
HOT_SHARE = 512

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The white space [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"


def save(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage at a place every executor sees; a lost executor costs
    only the tasks that read it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_row_id(df: DataFrame, name: str = "rid") -> DataFrame:
    """Add a row id that tells equal rows apart.

    The id is partition number and place, so it is the same in every
    evaluation of a deterministic plan (a file scan, a written table).
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def without_rows(df: DataFrame, lost: DataFrame, name: str = "__rid") -> DataFrame:
    """``df`` without the rows whose row id (``with_row_id``) is in ``lost(name)``.

    The ids are written first, so their size is known when the join is
    planned: below the session's broadcast threshold they go to the rows and no
    text is shuffled; above it both sides are shuffled by the id.
    """
    own = name
    while own in df.columns:
        own = f"_{own}"
    return with_row_id(df, own).join(save(lost.select(F.col(name).alias(own)), "lost-rows"), own, "left_anti").drop(own)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def hot_join(left: DataFrame, right: DataFrame, key: str, count: str, how: str = "inner") -> DataFrame:
    """Join ``left`` to ``right`` on ``key`` whatever the skew of ``key``.

    ``right`` has one row per key, and ``count`` says how many rows of
    ``left`` hold it.  A key with more than 1/512 of all rows is joined by
    broadcast: there are fewer than 512 of them by arithmetic.  The others go
    through a shuffle join whose largest key is under 1/512 of the rows.
    ``right`` should be a written table, as it is read several times.
    """
    total = right.agg(F.sum(count)).first()[0] or 0
    is_hot = F.col(count) * HOT_SHARE > F.lit(total)
    hot = right.where(is_hot)
    big = left.join(F.broadcast(hot), key)
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti")
    # (a null key joins with nothing, and stays in ``rest`` for a left join)
    return big.unionByName(rest.join(right.where(~is_hot), key, how))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows ``(id, component)``.

    ``component`` is the smallest id that can be reached.  Ids without an edge
    are absent.  Alternating large-star and small-star steps (Kiveris et al.
    2014): every step is a grouped minimum and a join back, both without a
    group in memory; hubs go through ``hot_join``.  Each step is written, so
    the plan does not grow.  Ends when a round changes nothing.
    """
    e = save(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .distinct(), "cc-edges")

    def mark(df):
        r = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    def star(pairs, with_own):
        low = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        low = save(low.withColumn("m", F.least("m", "u")), "cc-min")
        if with_own:  # small star: neighbours below u and u itself go to the minimum
            out = hot_join(pairs, low, "u", "n").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            out = out.unionByName(low.select("u", F.col("m").alias("v")))
        else:  # large star: neighbours above u go to the minimum
            out = hot_join(pairs, low, "u", "n").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return out.distinct()

    seen = mark(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        e = save(star(both, False), "cc-large")
        e = save(star(e, True), "cc-small")
        now = mark(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def file_bytes(path: str) -> bytes:
    """A small model file (a tokenizer), read on the driver for a broadcast."""
    with open(path, "rb") as f:
        return f.read()
