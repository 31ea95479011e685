"""Two streams joined by key within a time, with nothing lost without a trace.

``pair`` is a left outer stream-stream join: a left row comes out with each
right row whose time is at most ``wait`` after its own, or alone once the
watermark shows that none can follow.  Spark drops left rows that arrive
behind the watermark; ``account`` finds them and those that still wait, so that
every left row has exactly one status.

A right row behind the watermark is dropped as well; ``Paired.dropped`` counts
both sides.

State: left rows leave when their wait is over; right rows stay, so the right
side is a dimension (a row a key), not a second feed of facts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.streaming import ingest


@dataclass(frozen=True)
class Paired:
    """What a run did: its rows so far, the last watermark and how many rows Spark dropped as late in this run."""
    sink: str
    watermark: str | None
    dropped: int


def pair(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, root: str,
         wait: str = "1 day", delay: str = "1 hour") -> Paired:
    """Join all available input into ``root``; a later call goes on from the same state.

    ``left`` and ``right`` share the column ``key`` and no other.  A null key
    meets nothing and comes out alone.  A row without a time never falls
    behind the watermark and is not waited for; give it one before.
    """
    a = left.withWatermark(left_time, delay)
    b = right.withColumnRenamed(key, "__key").withWatermark(right_time, delay)
    near = (F.col(key) == F.col("__key")) & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {wait}"))
    batches = ingest.run_available_now(a.join(b, near, "left_outer").withColumn("matched", F.col("__key").isNotNull()).drop("__key"),
                                       f"{root}/paired", f"{root}/checkpoint")
    marks = [m for p in batches if (m := (p.eventTime or {}).get("watermark"))]
    lost = sum(op.numRowsDroppedByWatermark or 0 for p in batches for op in p.stateOperators or [])
    return Paired(f"{root}/paired", max(marks, default=None), lost)


def account(spark: SparkSession, left: DataFrame, done: Paired, row_id: str, left_time: str, wait: str = "1 day") -> DataFrame:
    """``left`` (all rows given so far, read as a table) with a ``status`` for each ``row_id``.

    ``matched`` and ``unmatched`` rows are in the join's result; of the others a
    row ``waits`` while its partner may still come, and is ``late`` after
    that: it came behind the watermark.  ``row_id`` names one row.  One shuffle
    by that id; the result's side brings a flag for each row, no payload.
    """
    out = spark.read.parquet(done.sink).groupBy(row_id).agg(F.max("matched").alias("__matched"))
    over = F.coalesce(F.col(left_time) + F.expr(f"INTERVAL {wait}") < F.lit(done.watermark).cast("timestamp"), F.lit(False))
    return (left.join(out, row_id, "left")
            .withColumn("status", F.when(F.col("__matched"), "matched").when(~F.col("__matched"), "unmatched")
                        .when(over, "late").otherwise("waiting")).drop("__matched"))


#: Rows of join state, both sides together, for each core that a run has: some 400 bytes a row of the executors' heap.
STATE_ROWS_PER_CORE = 1_000_000


def join_parts(spark: SparkSession, rows: int) -> int:
    """In how many parts a stream-stream join runs whose first run holds up to ``rows`` rows."""
    return max(1, -(-rows // (STATE_ROWS_PER_CORE * spark.sparkContext.defaultParallelism)))


def join_in_parts(left: DataFrame, right: DataFrame, left_key: str, right_key: str, parts: int, root: str,
                  join: Callable[[DataFrame, DataFrame], DataFrame]) -> tuple[list, DataFrame]:
    """An inner stream-stream join on a key, a part of the keys after the other; the progress of all batches, and the rows.

    A join's first run holds its whole backlog, since the watermark moves after
    it, and Spark keeps that state in the executors' heap.  Rows meet only by their
    key, so each part of the keys (dealt by hash) is a join of its own, with its
    own checkpoint and watermark; the next part unloads the state of the one before.
    Both keys have one type, and ``parts`` stays the same for a ``root``.  A part's state
    is dealt to two tasks a core, or to fewer where the session asks for that.
    """
    spark = left.sparkSession
    key = "spark.sql.shuffle.partitions"
    conf = {key: str(min(int(spark.conf.get(key)), 2 * spark.sparkContext.defaultParallelism))}

    def part(df: DataFrame, name: str, i: int) -> DataFrame:
        return df.where(F.pmod(F.xxhash64(name), F.lit(parts)) == i)

    batches, sinks = [], []
    for i in range(parts):
        sinks.append(f"{root}/sink-{i}")
        batches += ingest.run_available_now(join(part(left, left_key, i), part(right, right_key, i)), sinks[-1],
                                            f"{root}/ckpt-{i}", conf=conf)
    return batches, reduce(DataFrame.unionByName, [spark.read.parquet(p) for p in sinks])
