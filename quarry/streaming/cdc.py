"""APPLY CHANGES: a CDC feed into an SCD type-1 table, out-of-order and replay safe.

State: the latest change per key, including deletes kept as tombstones,
hash-partitioned into buckets.  Unless the caller fixes their number it follows
the state: one bucket for each ``ROWS_PER_BUCKET`` rows, a power of two, set by the
first batch; a batch that finds the state outgrown hashes it anew into more buckets
(one rewrite each time the state has doubled).  Below the table's root

* ``versions/<v>/part=<bucket>`` holds the buckets that version ``v`` wrote;
* ``manifest/<v>.json``, written last, says for every bucket which version
  holds it and how many rows it has, the bucket count, the schema, and the
  micro-batch it came from.

Each micro-batch reads only the buckets it touches (from the versions the last
manifest names), merges them with the newest change per key, and writes them
to a fresh version directory.  Nothing that a manifest names is ever written
again, so a crash at any point leaves the last manifest whole; a batch that is
replayed after its manifest was written changes nothing.  Directories
that neither of the last two manifests names are removed.

"Newest" is ``max(struct(sequence, is_delete, ...))``, a partial aggregate: a key
with a third of all changes is pre-combined in every task, a delete wins over
an update of the same sequence, then the larger payload.  A delete keeps a
tombstone, so an older update arriving later cannot revive the key.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quarry.sources import fs

DELETED = "__deleted"
BUCKET = "__bucket"
#: About what a task rewrites when a micro-batch touches one bucket.
ROWS_PER_BUCKET = 1_000_000


def _latest(df: DataFrame, keys: Sequence[str], sequence_by: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in (sequence_by, DELETED)]
    newest = F.max(F.struct(F.col(sequence_by), F.col(DELETED), *[F.col(c) for c in rest])).alias("__r")
    return df.groupBy(*keys).agg(newest).select(*keys, "__r.*")


def _marked(changes: DataFrame, delete_when: str | Column) -> DataFrame:
    cond = F.expr(delete_when) if isinstance(delete_when, str) else delete_when
    return changes.withColumn(DELETED, F.coalesce(cond, F.lit(False)))


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def buckets_for(rows: int) -> int:
    """The power of two of buckets that leaves each at most about ``ROWS_PER_BUCKET`` rows."""
    return 1 << max(0, -(-rows // ROWS_PER_BUCKET) - 1).bit_length()


def _newest_changes(marked: DataFrame, keys: Sequence[str], sequence_by: str) -> DataFrame:
    """The newest change per key; rows without key or sequence are dropped."""
    valid = marked.where(F.col(sequence_by).isNotNull())
    for k in keys:
        valid = valid.where(F.col(k).isNotNull())
    return _latest(valid, keys, sequence_by)


def merge_changes(state: DataFrame | None, changes: DataFrame, keys: Sequence[str], sequence_by: str,
                  delete_when: str | Column, buckets: int) -> DataFrame:
    """New content of the state buckets touched by ``changes`` (a batch DataFrame)."""
    batch = _newest_changes(_marked(changes, delete_when), keys, sequence_by).withColumn(BUCKET, _bucket(keys, buckets))
    if state is None:
        return batch
    ids = [r[0] for r in batch.select(BUCKET).distinct().collect()]   # <= buckets small ints
    touched = state.where(F.col(BUCKET).isin(ids))
    return _latest(touched.unionByName(batch, allowMissingColumns=True), keys, sequence_by)


# ---- versions and manifests ------------------------------------------------------

def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict | None:
    """The given manifest, or the last one; None when there is none."""
    names = [n for n in fs.list_names(spark, f"{root}/manifest") if n.endswith(".json") and not n.startswith("_")]
    numbers = sorted(int(n.removesuffix(".json")) for n in names)
    if version is None:
        version = numbers[-1] if numbers else None
    if version is None or version not in numbers:
        return None
    text = spark.read.option("wholetext", True).text(f"{root}/manifest/{version}.json").first()[0]
    return json.loads(text)


def _read_buckets(spark: SparkSession, root: str, m: dict, ids: Sequence[int] | None = None) -> DataFrame:
    schema = StructType.fromJson(m["schema"])
    paths = [f"{root}/versions/{v}/part={b}" for b, v in m["at"].items() if ids is None or int(b) in ids]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def write_batch(spark: SparkSession, root: str, marked: DataFrame, batch: str, keys: Sequence[str],
                sequence_by: str, buckets: int | None = None) -> None:
    """Merge one micro-batch (with its ``__deleted`` column) into the state at ``root``.

    ``batch`` names the micro-batch (its query and id): a second call with the
    name of the last version returns at once, as its manifest was written when
    the first was done.  A given ``buckets`` is fixed by the first batch, another
    number later is refused; without one the number follows the state's rows.
    """
    last = manifest(spark, root)
    if last is not None and buckets not in (None, last["buckets"]):
        raise ValueError(f"{root} has {last['buckets']} buckets, not {buckets}")
    if last is not None and last["batch"] == batch:
        return
    version, base = 0 if last is None else last["version"] + 1, last
    follows = buckets is None if last is None else last.get("follows", False)
    grown = False
    # one row a key, used more than once: their count, touched buckets, then the merge
    newest = _newest_changes(marked, keys, sequence_by).persist()
    try:
        if last is None:
            buckets = buckets or buckets_for(newest.count())
        else:
            buckets = max(last["buckets"], buckets_for(sum(last["rows"].values()))) if follows else last["buckets"]
            grown = buckets > last["buckets"]
        new = newest.withColumn(BUCKET, _bucket(keys, buckets))
        if base is not None:
            ids = None if grown else [r[0] for r in new.select(BUCKET).distinct().collect()]  # <= buckets small ints
            state = _read_buckets(spark, root, base, ids)
            if grown:
                state = state.withColumn(BUCKET, _bucket(keys, buckets))
            new = _latest(state.unionByName(new, allowMissingColumns=True), keys, sequence_by)
        # REBALANCE: about one writer per bucket, while AQE still splits a bucket that grew large
        (new.withColumn("part", F.col(BUCKET)).hint("rebalance", "part").write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy("part").parquet(f"{root}/versions/{version}"))
        written = spark.read.schema(f"{BUCKET} int").parquet(f"{root}/versions/{version}").groupBy(BUCKET).count()
        count = {str(b): n for b, n in written.collect()}  # <= buckets rows
        keep = base if base and not grown else {"at": {}, "rows": {}}
        at = keep["at"] | {b: version for b in count}
        fs.write_text(spark, f"{root}/manifest/{version}.json", json.dumps({
            "version": version, "batch": batch, "buckets": buckets, "follows": follows, "at": at,
            "rows": keep.get("rows", {}) | count, "schema": new.schema.jsonValue()}))
    finally:
        newest.unpersist()
    named = {*at.items(), *(base["at"] if base else {}).items()}
    for v in fs.list_names(spark, f"{root}/versions"):
        if int(v) < version and not any(str(x) == v for _, x in named):
            fs.delete(spark, f"{root}/versions/{v}")
    for n in fs.list_names(spark, f"{root}/manifest"):
        if n.endswith(".json") and int(n.removesuffix(".json")) < version - 1:
            fs.delete(spark, f"{root}/manifest/{n}")


def apply_changes(spark: SparkSession, stream: DataFrame, root: str, keys: Sequence[str], sequence_by: str,
                  delete_when: str | Column, except_columns: Sequence[str] = (), buckets: int | None = None,
                  checkpoint: str | None = None) -> StreamingQuery:
    """Run the CDC stream to completion (availableNow) into the state at ``root``.

    Only ``except_columns`` are dropped; ``delete_when`` is evaluated before that.
    """
    root = root.rstrip("/")
    checkpoint = checkpoint or f"{root}/_checkpoint"
    src = _marked(stream, delete_when).drop(*except_columns)

    def batch_fn(batch_df: DataFrame, batch_id: int) -> None:
        write_batch(spark, root, batch_df, f"{checkpoint}#{batch_id}", keys, sequence_by, buckets)

    q = (src.writeStream.foreachBatch(batch_fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """All buckets of the last version, tombstones included."""
    root = root.rstrip("/")
    m = manifest(spark, root)
    if m is None:
        raise FileNotFoundError(f"no state at {root}")
    return _read_buckets(spark, root, m)


def read_target(spark: SparkSession, root: str, except_columns: Sequence[str] = ()) -> DataFrame:
    """The SCD type-1 table: newest row per key, deletes removed (batch read only)."""
    return read_state(spark, root).where(~F.col(DELETED)).drop(*except_columns, DELETED, BUCKET)


def apply_changes_batch(changes: DataFrame, keys: Sequence[str], sequence_by: str,
                        delete_when: str | Column, except_columns: Sequence[str] = ()) -> DataFrame:
    """The same semantics over a static change table (one pass, no state)."""
    merged = merge_changes(None, changes, keys, sequence_by, delete_when, buckets=1)
    return merged.where(~F.col(DELETED)).drop(*except_columns, DELETED, BUCKET)
