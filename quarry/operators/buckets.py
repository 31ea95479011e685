"""MERGE into a hash-bucketed directory: only touched buckets are read and written.

A table is a folder ``<path>/__bucket=<n>`` of parquet files; a row's bucket is
the hash of its key.  A MERGE finds the buckets its source touches, reads
those alone (a partition filter), joins them with the source by one full outer
join, writes the result beside the table and then swaps the touched buckets in by
a dynamic partition overwrite.  What was staged is complete before the first
bucket changes, so a swap that was cut off is run again from it
(``swap``), not the MERGE.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators.change import Clause, _and, _expr
from quarry.session import scratch_dir
from quarry.sources import fs

BUCKET = "__bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def generated_order(generated: Mapping[str, str]) -> list[str]:
    """Generated columns, each after those its expression names; a cycle is an error."""
    def named(e: str) -> set[str]:
        bare = re.sub(r"'(?:[^'\\]|\\.)*'", "", e)
        return {g for g in generated if re.search(rf"(?<![\w.]){re.escape(g)}(?!\w)", bare)}

    needs, out = {g: named(e) - {g} for g, e in generated.items()}, []
    while len(out) < len(needs):
        ready = [g for g in needs if g not in out and needs[g] <= set(out)]
        if not ready:
            raise ValueError(f"generated columns depend on each other: {sorted(set(needs) - set(out))}")
        out += ready
    return out


def merged_rows(target: DataFrame, source: DataFrame, on: Sequence[str], clauses: Sequence[Clause],
                generated: Mapping[str, str] | None = None, evolve_schema: bool = False) -> DataFrame:
    """``MERGE INTO target USING source`` as one full outer join; nothing runs until it is read.

    NULL keys never match.  A target row that more than one source row matches
    fails the job.  Rows that a clause writes get their ``generated`` columns
    from the merged row, in order of dependence; a value the clause supplies
    must equal its expression.  Rows no clause touches keep what they have.
    """
    generated = dict(generated or {})
    columns = list(target.columns)
    if evolve_schema:
        columns += [c for c in source.columns if c not in columns]
    columns += [c for c in generated if c not in columns]
    tgt = target.select(*[F.col(c) if c in target.columns else
                          F.lit(None).cast(source.schema[c].dataType if c in source.columns else "void").alias(c) for c in columns])
    kinds = {c: tgt.schema[c].dataType for c in columns}
    t = tgt.withColumn("__t", F.lit(True)).alias("t")
    same = Window.partitionBy(*on)
    s = (source.withColumn("__s", F.lit(True)).withColumn("__n", F.count("*").over(same))
         .withColumn("__i", F.row_number().over(same.orderBy(*on))).alias("s"))
    j = t.join(s, _and([F.col(f"t.{k}") == F.col(f"s.{k}") for k in on]), "full_outer")
    both = F.col("t.__t").isNotNull() & F.col("s.__s").isNotNull()
    new = F.col("t.__t").isNull()

    def first(kind: str) -> Column:
        pick = F.lit(-1)
        for i, c in reversed(list(enumerate(clauses))):
            if c.kind == kind:
                pick = F.when(F.lit(True) if c.when is None else F.coalesce(_expr(c.when), F.lit(False)), i).otherwise(pick)
        return pick

    # a matched row that no clause may change is one row, however many source rows match it
    many = both & (F.col("s.__n") > 1)
    if any(c.kind == "matched" for c in clauses):
        j = j.where(F.when(many, F.raise_error(F.lit("MERGE: a target row matches more than one source row")).cast("boolean"))
                    .otherwise(F.lit(True)))
    else:
        j = j.where(~both | (F.col("s.__i") == 1))
    j = j.withColumn("__clause", F.when(both, first("matched")).when(new, first("not_matched")).otherwise(-1))
    action = [c.action for c in clauses]
    gone = F.col("__clause").isin([i for i, a in enumerate(action) if a == "delete"]) | (new & (F.col("__clause") == -1))

    def supplied(c: Clause, name: str) -> Column | None:
        if c.set == "*":
            return F.col(f"s.{name}") if name in source.columns else None
        return _expr(c.set[name]) if name in c.set else None

    out, given = [], []
    for name in columns:
        v, said = F.col(f"t.{name}"), F.lit(False)
        for i, c in enumerate(clauses):
            if c.action == "delete":
                continue
            x = supplied(c, name)
            hit = F.col("__clause") == i
            if x is not None:
                said = said | hit
                v = F.when(hit, x.cast(kinds[name]) if name not in generated else x).otherwise(v)
        out.append(v.alias(name))
        if name in generated:
            given.append(said.alias(f"__given_{name}"))
    rows = j.where(~gone).select(*out, *given, (F.col("__clause") >= 0).alias("__written"))
    for name in generated_order(generated):
        e = F.expr(generated[name])
        wrong = F.raise_error(F.lit(f"generated column {name} does not match its expression"))
        value = F.when(~F.col("__written"), F.col(name)).when(
            F.col(f"__given_{name}") & ~F.col(name).eqNullSafe(e), wrong).otherwise(e)
        rows = rows.withColumn(name, value)
    return rows.select(*columns)


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> str:
    """Write ``df`` as a bucketed folder; a bucket is about one file, large ones are split by AQE."""
    (df.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path))
    fs.write_text(df.sparkSession, f"{path}/_buckets", str(buckets))
    return path


def read_bucketed(spark: SparkSession, path: str, ids: Sequence[int] | None = None) -> DataFrame:
    """The table, or the given buckets of it (a partition filter: no other file is opened)."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    if BUCKET not in df.columns:
        return df
    return (df if ids is None else df.where(F.col(BUCKET).isin(list(ids)))).drop(BUCKET)


def touched(source: DataFrame, keys: Sequence[str], buckets: int) -> list[int]:
    """Buckets that rows of ``source`` fall into (numbers below ``buckets``, NULL keys too)."""
    return sorted(r[0] for r in source.select(bucket_of(keys, buckets).alias("b")).distinct().collect())


def swap(spark: SparkSession, path: str, staged: str, ids: Sequence[int]) -> None:
    """Put the staged buckets in place of ``ids``; may be run again after a cut.

    The partitions written replace theirs; a touched bucket that has no row
    left is removed.
    """
    df = spark.read.parquet(staged)
    held = {r[0] for r in df.select(BUCKET).distinct().collect()}
    (df.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET).parquet(path))
    for b in set(ids) - held:
        fs.delete(spark, f"{path}/{BUCKET}={b}")


def merge_into(spark: SparkSession, path: str, source: DataFrame, on: Sequence[str], clauses: Sequence[Clause],
               generated: Mapping[str, str] | None = None, evolve_schema: bool = False) -> list[int]:
    """MERGE ``source`` into the bucketed table at ``path``; the buckets that were rewritten."""
    buckets = int(fs.read_text(spark, f"{path}/_buckets"))
    kinds = read_bucketed(spark, path).schema
    # keys are hashed as the target has them
    source = source.select(*[F.col(c).cast(kinds[c].dataType).alias(c) if c in on else F.col(c) for c in source.columns])
    ids = touched(source, on, buckets)
    if not ids:
        return []
    rows = merged_rows(read_bucketed(spark, path, ids), source, on, clauses, generated, evolve_schema)
    staged = scratch_dir(spark, "merge")
    rows.withColumn(BUCKET, bucket_of(on, buckets)).write.parquet(staged)
    swap(spark, path, staged, ids)
    return ids
