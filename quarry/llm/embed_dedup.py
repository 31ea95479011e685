"""Embedding near-dedup by an epsilon grid order join.

Unit vectors with cosine >= c are at most ``eps = sqrt(2 - 2c)`` apart, and so
are their projections on any orthonormal directions.  The vectors are
projected on their leading principal directions, sorted by the grid cells (of
side eps) of that projection, and cut into sequence intervals of equal
length.  Intervals are joined recursively, coarse ones first: a pair is
followed to its halves only while the boxes around their projections are at
most eps apart.  What survives are pairs of short intervals, compared by
matrix products in double precision.

Defined results: null or empty vectors, zero vectors and vectors with null or
non-finite components link with nothing and are their own component; equal
vectors (one class, compared once) link with each other; vectors of unlike
lengths never link; rows with a null or repeated vec_id are rows like any
other (a null one never names a component unless all of it are null); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import components, hot_join, save, with_row_id
from quarry.llm.simhash import stars


def unit(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row places, unit vectors as doubles) per vector length of a batch of finite, non-zero vectors."""
    col = batch.column("embedding")
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(col.offsets.to_numpy())
    start = np.cumsum(size) - size
    out = []
    for d in np.unique(size).tolist():
        at = np.flatnonzero(size == d)
        x = flat[start[at][:, None] + np.arange(d)]
        x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
        out.append((at, x / np.sqrt((x * x).sum(axis=1, keepdims=True))))
    return out


def directions(classes: DataFrame, dims: int) -> dict[int, np.ndarray]:
    """Leading principal directions of the most frequent vector length.

    One pass; what reaches the driver is a single d x d matrix.  Vectors of
    other lengths are sorted by their first coordinates, which are orthonormal
    directions as well.
    """
    top = classes.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if top is None:
        return {}
    d = top["d"]

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((d + 1, d)), 0
        for b in batches:
            for _, x in unit(b):
                total[:d] += x.T @ x
                total[d] += x.sum(axis=0)
                n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel()),
                                              pa.array(np.full(total.size, n))], ["k", "v", "n"])

    sums = (classes.where(F.size("embedding") == d).select("embedding").mapInArrow(moments, "k long, v double, n long")
            .groupBy("k").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).orderBy("k").collect())
    m, n = np.array([r["v"] for r in sums]).reshape(d + 1, d), sums[0]["n"]
    mean = m[d] / n
    _, vectors = np.linalg.eigh(m[:d] / n - np.outer(mean, mean))
    return {d: vectors[:, ::-1][:, :dims].copy()}


def intervals(classes: DataFrame, eps: float, dims: int, block_rows: int) -> DataFrame:
    """``classes`` in epsilon grid order, with a ``block`` number and projections ``p0..``.

    Each written partition holds one range of the order; its rows are numbered
    in place and the partitions' counts (one number each) turn the places into
    global ones, so blocks have ``block_rows`` rows whatever the partitioning.
    """
    basis = directions(classes, dims)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = np.zeros((b.num_rows, dims))
            for at, x in unit(b):
                w = basis[x.shape[1]] if x.shape[1] in basis else np.eye(x.shape[1])[:, :dims]
                p[at, :w.shape[1]] = x @ w
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(p[:, k]) for k in range(dims)]],
                                             [*b.schema.names, *[f"p{k}" for k in range(dims)]])

    schema = "cid long, copies long, embedding array<float>, dim int"
    rows = classes.select("cid", "copies", "embedding", F.size("embedding").alias("dim")).mapInArrow(
        project, schema + "".join(f", p{k} double" for k in range(dims)))
    order = ["dim", *[f"g{k}" for k in range(dims)], "cid"]
    rows = rows.withColumns({f"g{k}": F.floor(F.col(f"p{k}") / F.lit(eps)) for k in range(dims)})

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, part = 0, TaskContext.get().partitionId()
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part)),
                                              pa.array(np.arange(n, n + b.num_rows))], [*b.schema.names, "part", "place"])
            n += b.num_rows

    fields = schema + "".join(f", p{k} double" for k in range(dims))
    rows = save(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                .select("cid", "copies", "embedding", "dim", *[f"p{k}" for k in range(dims)])
                .mapInArrow(number, fields + ", part long, place long"), "grid-order")
    base, at = [], 0
    for r in sorted(rows.groupBy("part").count().collect()):
        base.append((r["part"], at))
        at += r["count"]
    before = F.create_map(*[F.lit(x) for pair in base for x in pair]) if base else F.lit(None).cast("map<bigint,bigint>")
    return rows.withColumn("block", F.floor((before[F.col("part")] + F.col("place")) / F.lit(block_rows)))


def interval_pairs(rows: DataFrame, eps: float, dims: int, fan: int = 8) -> DataFrame:
    """Pairs ``(a, b)``, a <= b, of blocks that may hold vectors within eps.

    From the root of a tree with ``fan`` children a node, level by level: the
    children of a surviving pair are paired and kept if the boxes around their
    projections are at most eps apart (and their lengths overlap).
    """
    names = ["dim", *[f"p{k}" for k in range(dims)]]
    least = [F.min(c).alias(f"{c}_lo") for c in names]
    most = [F.max(c).alias(f"{c}_hi") for c in names]
    tree = [save(rows.groupBy("block").agg(*least, *most).withColumnRenamed("block", "node"), "boxes")]
    while (tree[-1].agg(F.max("node")).first()[0] or 0) > 0:
        up = tree[-1].groupBy(F.floor(F.col("node") / F.lit(fan)).alias("node"))
        tree.append(save(up.agg(*[F.min(f"{c}_lo").alias(f"{c}_lo") for c in names],
                                *[F.max(f"{c}_hi").alias(f"{c}_hi") for c in names]), "boxes"))
    pairs = tree[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in reversed(tree[:-1]):
        up = level.withColumn("up", F.floor(F.col("node") / F.lit(fan)))
        x = up.select(*[F.col(c).alias(f"a_{c}") for c in up.columns])
        y = up.select(*[F.col(c).alias(f"b_{c}") for c in up.columns])
        gap = F.lit(0.0)
        for k in range(dims):
            far = F.greatest(F.lit(0.0), F.col(f"a_p{k}_lo") - F.col(f"b_p{k}_hi"), F.col(f"b_p{k}_lo") - F.col(f"a_p{k}_hi"))
            gap = gap + far * far
        near = (gap <= F.lit(eps * eps * (1 + 1e-9))) & (F.col("a_dim_lo") <= F.col("b_dim_hi")) & (F.col("b_dim_lo") <= F.col("a_dim_hi"))
        pairs = save(pairs.join(x, F.col("a") == F.col("a_up")).join(y, F.col("b") == F.col("b_up"))
                     .where((F.col("a_node") <= F.col("b_node")) & near)
                     .select(F.col("a_node").alias("a"), F.col("b_node").alias("b")), "interval-pairs")
    return pairs


def compare(left: pa.Table, right: pa.Table | None, cosine: float, strip: int = 256) -> tuple[pa.Table, pa.Table]:
    """Links between two blocks (or inside one): (cid, links to others) and a star per component found."""
    parts = [left] if right is None else [left, right]
    cid = np.concatenate([t.column("cid").to_numpy() for t in parts])
    copies = np.concatenate([t.column("copies").to_numpy() for t in parts])
    first, found, degree = len(left), [], np.zeros(len(cid), np.int64)
    sides = [{x.shape[1]: (at, x) for at, x in unit(t.select(["embedding"]).combine_chunks().to_batches()[0])} for t in parts]
    low = cosine - 1e-9
    for d, (at, x) in sides[0].items():
        if d not in sides[-1]:
            continue
        to, y = sides[-1][d]
        for k in range(0, len(at), strip):
            s = x[k:k + strip] @ y.T
            i, j = np.nonzero(s >= low)
            near = s[i, j]
            i = i + k
            keep = np.ones(len(i), bool)
            for q in np.flatnonzero(near < cosine + 1e-9).tolist():  # on the edge: with less rounding
                keep[q] = math.fsum((x[i[q]] * y[j[q]]).tolist()) >= cosine
            a, b = at[i[keep]], to[j[keep]] + (first if right is not None else 0)
            if right is None:
                a, b = a[a < b], b[a < b]
            np.add.at(degree, a, copies[b])
            np.add.at(degree, b, copies[a])
            found.append((a, b))
            if sum(len(p[0]) for p in found) > 1 << 21:
                found = [stars(len(cid), found, np.arange(len(cid)))]
    some = degree > 0
    a, b = stars(len(cid), found, cid)
    return (pa.table({"a": cid[some], "b": pa.nulls(int(some.sum()), pa.int64()), "n": degree[some]}),
            pa.table({"a": a, "b": b, "n": pa.nulls(len(a), pa.int64())}))


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, dims: int = 6, block_rows: int = 2048) -> DataFrame:
    """Rows ``(rid, vec_id, n_links, component_id, kept)``, one per input row."""
    eps = math.sqrt(2 - 2 * cosine)
    e = F.col("embedding")
    good = F.coalesce((F.size(e) > 0) & F.forall(e, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
                      & F.exists(e, lambda x: x != 0), F.lit(False))
    rows = save(with_row_id(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding")))
                .withColumn("good", good), "vectors")
    big = F.lit((1 << 63) - 1)
    # equal vectors form one class
    classes = save(rows.where("good").groupBy("embedding").agg(
        F.count("*").alias("copies"), F.min("rid").alias("cid"), F.min(F.coalesce("vec_id", big)).alias("low")), "vector-classes")
    blocks = intervals(classes, eps, dims, block_rows)
    pairs = interval_pairs(blocks, eps, dims)
    sides = pairs.select("a", "b", F.explode(F.when(F.col("a") == F.col("b"), F.array(F.col("a"))).otherwise(F.array("a", "b"))).alias("block"))

    def work(table: pa.Table) -> pa.Table:
        a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        block = table.column("block").to_numpy()
        found = compare(table.filter(pa.array(block == a)), table.filter(pa.array(block == b)) if a < b else None, cosine)
        return pa.concat_tables(found)

    units = blocks.select("block", "cid", "copies", "embedding").join(sides, "block")
    found = save(units.groupBy("a", "b").applyInArrow(work, "a long, b long, n long"), "vector-links")
    n = found.where("n IS NOT NULL").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n"))
    parts = components(found.where("n IS NULL").select("a", "b"))
    named = save(classes.select("cid", "copies", "low", "embedding").join(n, "cid", "left")
                 .join(parts.withColumnRenamed("id", "cid"), "cid", "left")
                 .withColumn("component", F.coalesce("component", "cid")), "vector-parts")
    best = save(named.groupBy("component").agg(F.min("low").alias("best"), F.count("*").alias("classes")), "vector-best")
    named = save(hot_join(named, best, "component", "classes").select(
        "embedding", "copies", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.when(F.col("best") != big, F.col("best")).alias("component_id")), "vector-named")
    linked = hot_join(rows.where("good"), named, "embedding", "copies").select("rid", "vec_id", "n_links", "component_id")
    alone = rows.where("NOT good").select("rid", "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
