"""Versioned tables on plain parquet: snapshots, history, time travel.

Layout under a table root (a directory on the shared file system):

    {root}/version=N/          parquet data of version N (written by Spark)
    {root}/_history/commit=N/  one metadata row for commit N (a JSON line
                               plus a _SUCCESS marker, written last)

History rows are the source of truth: a snapshot directory without its
history row (a crashed writer) is invisible, and a retried commit simply
overwrites it.  Reads go straight to ``version=N``, so a read touches only
that version's files.  No transaction-log format is built (SURVEY "Not
built"); concurrent writers to one root are not supported.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quarry.sources import fs

HISTORY_SCHEMA = ("version bigint, timestamp timestamp_ntz, operation string, "
                  "parameters string, num_rows bigint, num_files bigint, source string")


def _hist_path(root: str) -> str:
    return f"{root.rstrip('/')}/_history"


def snapshot_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/version={int(version)}"


class VersionNotFound(ValueError):
    """The requested version does not exist or its files were vacuumed."""


_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def history(spark: SparkSession, root: str) -> DataFrame:
    """All commits of a table: version, timestamp, operation, parameters, metrics."""
    if latest_version(spark, root) is None:
        return spark.createDataFrame([], HISTORY_SCHEMA)
    h = (spark.read.schema(HISTORY_SCHEMA).option("timestampNTZFormat", _TS_FORMAT)
         .option("pathGlobFilter", "part-*.json").json(_hist_path(root)))
    return h.select(*[c.split()[0] for c in HISTORY_SCHEMA.split(", ")]).where(F.col("version").isNotNull())


def latest_version(spark: SparkSession, root: str) -> int | None:
    """Newest committed version, from the history directory listing.

    A commit counts once its history row was written completely (the
    writer's ``_SUCCESS`` marker); a listing is a metadata call, no Spark job.
    """
    hist = _hist_path(root)
    done = []
    for name in fs.list_names(spark, hist):
        if name.startswith("commit=") and fs.exists(spark, f"{hist}/{name}/_SUCCESS"):
            done.append(int(name.split("=", 1)[1]))
    return max(done) if done else None


def _data_files(spark: SparkSession, path: str) -> int:
    return sum(1 for n in fs.list_names(spark, path) if n.endswith(".parquet"))


def commit(spark: SparkSession, root: str, df: DataFrame | None, operation: str,
           parameters: Mapping | None = None, source: str | None = None,
           timestamp: dt.datetime | None = None) -> int:
    """Write ``df`` as the next version of ``root`` and record it in the history.

    ``df`` may read an older version of the same table: the new version goes
    to a new directory, so reading and writing never touch the same files.
    ``df=None`` records a metadata-only commit (e.g. a shallow clone pointer).
    """
    last = latest_version(spark, root)
    version = 0 if last is None else last + 1
    n_rows = n_files = 0
    if df is not None:
        path = snapshot_path(root, version)
        obs = Observation(f"commit_{version}")
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        n_rows, n_files = int(obs.get.get("rows", 0)), _data_files(spark, path)
    ts = timestamp or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = {"version": version, "timestamp": ts.strftime("%Y-%m-%dT%H:%M:%S.%f"), "operation": operation,
           "parameters": json.dumps(dict(parameters or {}), sort_keys=True, default=str),
           "num_rows": n_rows, "num_files": n_files, "source": source}
    # One metadata line written by the driver (no Spark job); the _SUCCESS
    # marker, written last, is what makes the commit visible.
    commit_dir = f"{_hist_path(root)}/commit={version}"
    fs.write_text(spark, f"{commit_dir}/part-00000.json", json.dumps(row) + "\n")
    fs.write_text(spark, f"{commit_dir}/_SUCCESS", "")
    return version


def snapshot_write(spark: SparkSession, df: DataFrame, root: str, operation: str = "WRITE",
                   parameters: Mapping | None = None) -> int:
    """Write ``df`` as the next version of the table at ``root`` (see ``commit``)."""
    return commit(spark, root, df, operation, parameters)


def version_as_of(spark: SparkSession, root: str, timestamp: dt.datetime | str) -> int:
    """Newest version committed at or before ``timestamp``."""
    ts = F.lit(timestamp).cast("timestamp_ntz")
    row = (history(spark, root).where(F.col("timestamp") <= ts)
           .agg(F.max("version").alias("v")).first())
    if row is None or row["v"] is None:
        raise VersionNotFound(f"no version of {root} at or before {timestamp}")
    return int(row["v"])


def _resolve_source(spark: SparkSession, root: str, version: int) -> tuple[str, int]:
    """Follow shallow-clone pointers until a version with its own data.

    A version with its own data directory is read directly (a listing, no
    job); only metadata-only commits look up their source in the history.
    """
    if fs.exists(spark, snapshot_path(root, version)):
        return root, version
    row = history(spark, root).where(F.col("version") == version).select("operation", "source").first()
    if row is None:
        raise VersionNotFound(f"{root} has no version {version}")
    if row["operation"] == "SHALLOW CLONE" and row["source"]:
        src_root, src_version = row["source"].rsplit("@", 1)
        return _resolve_source(spark, src_root, int(src_version))
    return root, version


def snapshot_read(spark: SparkSession, root: str, version: int | None = None,
                  as_of: dt.datetime | str | None = None) -> DataFrame:
    """Read the table at ``version`` / as of a timestamp / latest.

    Reading a version whose files were vacuumed raises ``VersionNotFound``.
    """
    if as_of is not None:
        version = version_as_of(spark, root, as_of)
    if version is None:
        version = latest_version(spark, root)
        if version is None:
            raise VersionNotFound(f"{root} has no versions")
    data_root, data_version = _resolve_source(spark, root, version)
    if not fs.exists(spark, snapshot_path(data_root, data_version)):
        raise VersionNotFound(f"{root} version {version}: files are gone (vacuumed)")
    try:
        return spark.read.parquet(snapshot_path(data_root, data_version))
    except AnalysisException as e:
        raise VersionNotFound(f"{root} version {version}: files are gone ({e.__class__.__name__})") from e


def restore(spark: SparkSession, root: str, version: int) -> int:
    """RESTORE: the content of ``version`` becomes a new, newest version."""
    return commit(spark, root, snapshot_read(spark, root, version), "RESTORE", {"version": version})


def diff(spark: SparkSession, root: str, v_from: int, v_to: int) -> DataFrame:
    """Rows added and removed between two versions (multiset difference).

    ``exceptAll`` both ways: a distributed shuffle on all columns, the
    user-level reading of a log's add/remove entries.
    """
    a = snapshot_read(spark, root, v_from)
    b = snapshot_read(spark, root, v_to)
    return (b.exceptAll(a).withColumn("change", F.lit("added"))
            .unionByName(a.exceptAll(b).withColumn("change", F.lit("removed"))))


def detail(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Table detail: location, file count and bytes of one version (a listing, content not read)."""
    if version is None:
        version = latest_version(spark, root)
    path = snapshot_path(root, version)
    files = fs.list_files(spark, path, ".parquet")
    return spark.createDataFrame(
        [(path, int(version), len(files), sum(n for _, n in files))],
        "location string, version bigint, num_files bigint, size_in_bytes bigint")


def deep_clone(spark: SparkSession, source_root: str, target_root: str) -> list[int]:
    """Copy every source version the clone does not have yet (incremental on re-run)."""
    have = {r["source"] for r in history(spark, target_root).select("source").collect()}
    copied = []
    src_versions = [r["version"] for r in history(spark, source_root).orderBy("version")
                    .select("version").collect()]
    for v in src_versions:
        tag = f"{source_root}@{v}"
        if tag in have:
            continue
        copied.append(commit(spark, target_root, snapshot_read(spark, source_root, v),
                             "CLONE", {"source_version": v}, source=tag))
    return copied


def shallow_clone(spark: SparkSession, source_root: str, target_root: str,
                  version: int | None = None) -> int:
    """Metadata-only clone: version 0 points at the source files; writes diverge."""
    if version is None:
        version = latest_version(spark, source_root)
    return commit(spark, target_root, None, "SHALLOW CLONE", {"source_version": version},
                  source=f"{source_root}@{version}")


def vacuum_candidates(spark: SparkSession, root: str, retain_hours: float = 168.0,
                      now: dt.datetime | None = None) -> DataFrame:
    """DRY RUN: snapshot directories older than the retention, never the newest.

    A version is expired when a newer version was committed more than
    ``retain_hours`` ago (its files are no longer needed to read any version
    inside the retention window).
    """
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    cutoff = now - dt.timedelta(hours=retain_hours)
    h = history(spark, root).select("version", "timestamp", "num_files")
    nxt = h.select((F.col("version") - 1).alias("version"), F.col("timestamp").alias("next_ts"))
    newest = latest_version(spark, root)
    # Versions are consecutive, so "superseded by the next commit" is an
    # equi-join on version + 1.
    superseded = (h.where(F.col("num_files") > 0).join(nxt, "version")
                   .where(F.col("next_ts") <= F.lit(cutoff))
                   .select("version"))
    base = root.rstrip("/")
    return (superseded.where(F.col("version") != F.lit(newest))
            .select("version", F.concat(F.lit(f"{base}/version="), F.col("version").cast("string")).alias("path")))


def vacuum(spark: SparkSession, root: str, retain_hours: float = 168.0, dry_run: bool = True,
           now: dt.datetime | None = None) -> DataFrame:
    """VACUUM: list (dry run) or delete expired snapshot directories under ``root``.

    Deletion goes through the Hadoop FileSystem of the path, only for paths
    under ``root``; the newest version is never removed.
    """
    cand = vacuum_candidates(spark, root, retain_hours, now)
    if dry_run:
        return cand
    paths = [r["path"] for r in cand.collect()]     # one row per version: bounded metadata
    for p in paths:
        if not p.startswith(root.rstrip("/") + "/version="):
            raise ValueError(f"refusing to delete {p} outside {root}")
        fs.delete(spark, p)
    return cand
