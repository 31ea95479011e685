"""Small metadata operations through the Hadoop FileSystem of a path.

Listing one directory on the driver is a metadata call (no Spark job); it
works for any file system Spark can read (local, HDFS, object stores).
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import SparkSession


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of ``path`` (empty when it does not exist)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.delete(p, True))


def decoded(uri: str) -> str:
    """The path of a URI as Spark's ``_metadata.file_path`` gives it (escapes resolved)."""
    scheme, rest = uri.split(":", 1) if re.match(r"^[A-Za-z][\w+.-]*:/", uri) else ("", uri)
    return f"{scheme}:{unquote(rest)}" if scheme else unquote(rest)


def move(spark: SparkSession, source_uri: str, target_uri: str) -> None:
    """Rename a file to a free name (both as ``_metadata.file_path`` gives them)."""
    fs, p = _fs_path(spark, decoded(source_uri))
    _, to = _fs_path(spark, decoded(target_uri))
    if fs.exists(to) or not fs.rename(p, to):
        raise OSError(f"could not rename {p} to {to}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file (Spark's readers skip names that begin with ``_``)."""
    fs, p = _fs_path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def list_files(spark: SparkSession, path: str, suffix: str = "") -> list[tuple[str, int]]:
    """(name, length) of the files directly under ``path`` ending with ``suffix``."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return [(s.getPath().getName(), int(s.getLen())) for s in fs.listStatus(p)
            if s.isFile() and s.getPath().getName().endswith(suffix)]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file atomically for readers: temp name, then rename."""
    fs, p = _fs_path(spark, path)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), "_tmp-" + p.getName())
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(tmp, p):
        raise OSError(f"could not rename {tmp} to {path}")


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes of a file or of everything under a directory (a metadata call)."""
    fs, p = _fs_path(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0
