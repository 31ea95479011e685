"""Row-level change as DataFrame jobs: UPDATE, DELETE, MERGE.

Each function takes the current table state and returns the next state; the
caller writes it as a new snapshot (``quarry.operators.versions``).  Nothing
is collected.  MERGE is planned so that the (large) target is never shuffled
when the (usually small) source is small:

* matched clauses: ``target LEFT JOIN source`` on the key plus a CASE chain;
  AQE turns it into a broadcast hash join when the source's measured size is
  under the broadcast threshold, otherwise it is a sort-merge join (AQE
  splits a skewed key);
* inserts: source rows whose key matched no target row, found by
  semi-joining the target's key column against the distinct source keys
  (again broadcastable) and anti-joining the source with that small result.

A full outer join would always shuffle the whole target (Spark cannot
broadcast either side of a full outer join).

SQL semantics kept:
* a NULL predicate never selects a row (UPDATE/DELETE keep it untouched);
* NULL keys never match in MERGE;
* MERGE clauses are tried in order, the first whose condition is TRUE wins;
  an UNKNOWN condition counts as not satisfied;
* a target row matched by more than one source row is an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _expr(e: str | Column | None) -> Column | None:
    if e is None:
        return None
    return F.expr(e) if isinstance(e, str) else e


def update(df: DataFrame, assignments: Mapping[str, str | Column], where: str | Column | None = None) -> DataFrame:
    """``UPDATE df SET col = expr, .. WHERE where`` -> next state."""
    cond = _expr(where)
    cols = []
    for c in df.columns:
        if c in assignments:
            new = _expr(assignments[c])
            v = new if cond is None else F.when(cond, new).otherwise(F.col(c))
            cols.append(v.cast(df.schema[c].dataType).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def delete(df: DataFrame, where: str | Column | None = None) -> DataFrame:
    """``DELETE FROM df WHERE where``: keep rows where the predicate is FALSE or NULL."""
    if where is None:
        return df.limit(0)
    return df.filter(F.coalesce(~_expr(where), F.lit(True)))


@dataclass
class Clause:
    """One MERGE clause.

    kind: 'matched' | 'not_matched'; action: 'update' | 'delete' | 'insert'.
    ``set`` maps target columns to expressions over ``t.<col>`` / ``s.<col>``;
    ``'*'`` means every target column from the same-named source column.
    """
    kind: str
    action: str
    when: str | Column | None = None
    set: Mapping[str, str | Column] | str = field(default="*")


def _and(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, cols)


class MergeError(ValueError):
    """A target row matched more than one source row."""


def check_single_match(target: DataFrame, source: DataFrame, on: Sequence[str]) -> None:
    """Fail when some target key is matched by more than one source row.

    First the source alone: keys occurring more than once (one aggregation,
    partial on the map side).  Only when there are such keys - rare - are
    they semi-joined to the target's key column.  Only a boolean reaches the
    driver.
    """
    dup = (source.where(_and([F.col(k).isNotNull() for k in on]))
                 .groupBy(*on).count().where(F.col("count") > 1).select(*on))
    if dup.isEmpty():
        return
    if not target.select(*on).join(dup, list(on), "left_semi").isEmpty():
        raise MergeError("MERGE: a target row matches more than one source row")


def merge(target: DataFrame, source: DataFrame, on: Sequence[str], clauses: Sequence[Clause],
          evolve_schema: bool = False, check: bool = True) -> DataFrame:
    """``MERGE INTO target USING source ON t.k = s.k (for k in on) <clauses>``.

    With ``evolve_schema`` source columns missing from the target are added
    (NULL for existing rows), as a merge with schema evolution does.
    """
    on = list(on)
    matched = [(i, c) for i, c in enumerate(clauses) if c.kind == "matched"]
    inserts = [(i, c) for i, c in enumerate(clauses) if c.kind == "not_matched"]
    if check and matched:
        check_single_match(target, source, on)
    out_cols = list(target.columns)
    if evolve_schema:
        out_cols += [c for c in source.columns if c not in out_cols]
    tgt = target
    for c in out_cols:
        if c not in tgt.columns:
            tgt = tgt.withColumn(c, F.lit(None).cast(source.schema[c].dataType))
    types = {c: tgt.schema[c].dataType for c in out_cols}

    def value(cl: Clause, c: str) -> Column:
        if cl.set == "*":
            return F.col(f"s.{c}") if c in source.columns else (
                F.col(f"t.{c}") if cl.action == "update" else F.lit(None))
        if c in cl.set:
            return _expr(cl.set[c])
        return F.col(f"t.{c}") if cl.action == "update" else F.lit(None)

    def chain(pairs, scope: Column) -> Column:
        pick = None
        for i, cl in pairs:
            cond = scope if cl.when is None else scope & F.coalesce(_expr(cl.when), F.lit(False))
            pick = F.when(cond, F.lit(i)) if pick is None else pick.when(cond, F.lit(i))
        return F.lit(-1) if pick is None else pick.otherwise(F.lit(-1))

    def project(df: DataFrame, pairs, keep: Column, base) -> DataFrame:
        cols = []
        for c in out_cols:
            v = None
            for i, cl in pairs:
                if cl.action == "delete":
                    continue
                branch = value(cl, c).cast(types[c])
                v = F.when(F.col("__clause") == i, branch) if v is None else v.when(F.col("__clause") == i, branch)
            b = base(c)
            cols.append((b if v is None else v.otherwise(b)).alias(c))
        return df.where(keep).select(*cols)

    t = tgt.select(*out_cols).alias("t")
    s = source.select(*source.columns, F.lit(True).alias("__s")).alias("s")
    key_eq = _and([F.col(f"t.{k}") == F.col(f"s.{k}") for k in on])

    # Target rows: unchanged, updated or deleted by the first matching clause.
    if matched:
        j = t.join(s, key_eq, "left").withColumn("__clause", chain(matched, F.col("s.__s").isNotNull()))
        keep = F.col("__clause") == -1
        for i, cl in matched:
            if cl.action == "update":
                keep = keep | (F.col("__clause") == i)
        kept = project(j, matched, keep, lambda c: F.col(f"t.{c}").cast(types[c]))
    else:
        kept = t.select(*[F.col(c) for c in out_cols])
    if not inserts:
        return kept

    # Source rows that matched no target row (NULL keys never match).
    src_keys = source.select(*on).where(_and([F.col(k).isNotNull() for k in on])).distinct()
    hit = tgt.select(*on).join(src_keys, on, "left_semi").distinct()
    fresh = source.join(hit, on, "left_anti").select(*source.columns, F.lit(True).alias("__s")).alias("s")
    ins = fresh.withColumn("__clause", chain(inserts, F.lit(True)))
    keep = F.lit(False)
    for i, cl in inserts:
        if cl.action == "insert":
            keep = keep | (F.col("__clause") == i)
    added = project(ins, inserts, keep, lambda c: F.lit(None).cast(types[c]))
    return kept.unionByName(added)


def insert_only_merge(target: DataFrame, source: DataFrame, on: Sequence[str],
                      where: str | Column | None = None) -> DataFrame:
    """``MERGE .. WHEN NOT MATCHED [AND cond] THEN INSERT *``: append new keys only.

    A left-anti join (no rewrite of matched rows); returns the rows to append.
    """
    new = source.join(target.select(*on), list(on), "left_anti")
    if where is not None:
        new = new.where(F.coalesce(_expr(where), F.lit(False)))
    return new.select(*target.columns)


def with_generated(df: DataFrame, name: str, expr: str | Column, data_type: str | None = None) -> DataFrame:
    """Generated column: computed at write; a supplied value must equal it.

    When ``df`` already carries ``name``, rows where the supplied value differs
    from the generated one make the job fail (``raise_error`` inside a filter,
    so it cannot be pruned).
    """
    gen = _expr(expr)
    if data_type:
        gen = gen.cast(data_type)
    if name not in df.columns:
        return df.withColumn(name, gen)
    ok = F.col(name).eqNullSafe(gen)
    guard = F.when(ok, F.lit(True)).otherwise(
        F.raise_error(F.lit(f"generated column {name} does not match its expression")).cast("boolean"))
    return df.where(guard)


def constraint_violations(df: DataFrame, constraints: Mapping[str, str | Column]) -> DataFrame:
    """Rows breaking any CHECK / NOT NULL constraint, one row per broken constraint.

    A NULL check result passes (SQL CHECK semantics); NOT NULL is written as
    ``col IS NOT NULL``.  One pass over ``df``: each row carries the array of
    constraint names it breaks, which is exploded.
    """
    broken = F.array(*[F.when(~F.coalesce(_expr(c), F.lit(True)), F.lit(name))
                       for name, c in constraints.items()])
    return (df.withColumn("constraint", F.explode(F.filter(broken, lambda x: x.isNotNull()))))


def enforce_constraints(df: DataFrame, constraints: Mapping[str, str | Column]) -> DataFrame:
    """Pass rows through unchanged; fail the job on the first violating row."""
    cond = _and([F.coalesce(_expr(c), F.lit(True)) for c in constraints.values()])
    names = ", ".join(constraints)
    guard = F.when(cond, F.lit(True)).otherwise(
        F.raise_error(F.lit(f"CHECK constraint violated ({names})")).cast("boolean"))
    return df.where(guard)
