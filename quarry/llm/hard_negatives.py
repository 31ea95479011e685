"""Hard-negative mining by segment summaries.

Vectors become integers, ``floor(256 * x)`` per component, and a score is an
integer inner product.  Each vector keeps, for every segment of its
components, their mean and their deviation; over a segment of ``m``
components the product of two vectors lies within ``m * (mean * mean +-
deviation * deviation)``.  Bounds over one, four, sixteen and 32 segments rule out
vectors, coarse ones first, and only what is left is scored exactly.

The anchors are a stated query set.  They go to all rows in blocks of bounded
size: a block of anchors is broadcast (``block_bytes``, whatever the size of
the table), every task keeps the best rows it has for each anchor, and the
tasks' few winners meet in a window.  A first pass over a block finds the
anchors' positives, a second one their negatives, since what may be a negative
depends on the positive's score.

Defined results: rows with a null label, a null vector or a null or non-finite
component take no part; vectors of unlike lengths have no score and never meet
(empty ones score 0 with each other); a null vec_id is never an anchor and
comes last in ties; rows that repeat a vec_id are rows of their own (an anchor
that is repeated is two anchors, each the other's possible positive), told
apart by row id; components beyond the size at which ten times a score could
leave a long (about 370,000 with 64 components) count as that size; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import save, with_row_id
from quarry.session import scratch_dir

LEVELS = (1, 4, 16, 32)
NONE = (1 << 63) - 1


def usable(e: Column) -> Column:
    return F.coalesce(F.forall(e, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False))), F.lit(False))


def vectors(rows: DataFrame) -> DataFrame:
    """Rows ``(rid, vec_id, label, v)`` that take part; ``v`` as integers."""
    e = F.col("embedding")
    r = with_row_id(rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                                e.cast("array<double>").alias("embedding")))
    limit = F.floor(F.sqrt(F.lit(float(1 << 59)) / F.greatest(F.size(e), F.lit(1)))).cast("double")
    q = F.transform(e, lambda x: F.floor(F.greatest(-limit, F.least(limit, x * 256.0))).cast("int"))
    moved = F.when(F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False)), (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return r.where(F.col("label").isNotNull() & usable(e)).select("rid", "vec_id", moved.alias("label"), q.alias("v"))


def matrices(col: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per vector length: (places, integer vectors as doubles)."""
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(col.offsets.to_numpy())
    start = np.cumsum(size) - size
    return {d: (at, flat[start[at][:, None] + np.arange(d)]) for d in np.unique(size).tolist()
            for at in (np.flatnonzero(size == d),)}


def summaries(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per level: (components, means, deviations) of every segment, each but the last of equal length."""
    d, out = x.shape[1], []
    for n in LEVELS:
        if d == 0:
            break
        cuts = np.unique(np.arange(n) * d // n)
        m = np.diff(np.append(cuts, d)).astype(np.float64)
        mean = np.add.reduceat(x, cuts, axis=1) / m
        dev = np.sqrt(np.maximum(np.add.reduceat(x * x, cuts, axis=1) / m - mean * mean, 0.0))
        out.append((m, mean, dev))
    return out


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of ``x`` with all of ``y``; exact."""
    if x.shape[1] == 0:
        return np.zeros((len(x), len(y)), np.int64)
    if np.abs(x).max(initial=0) * np.abs(y).max(initial=0) * x.shape[1] < 1 << 53:
        return (x @ y.T).astype(np.int64)
    return x.astype(np.int64) @ y.astype(np.int64).T


def survivors(x: np.ndarray, y: np.ndarray, same: np.ndarray, least: np.ndarray, most: np.ndarray,
              sums: list, other: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score) of the pairs in ``same`` whose score lies in ``least[i]..most[i]``.

    ``sums`` and ``other`` are the summaries of ``x`` and ``y``.  A pair goes
    as soon as a level's bounds leave its range; rows and columns without a
    pair go with it before the next level.
    """
    i, j, live = np.arange(len(x)), np.arange(len(y)), same
    slack = 1.0 + 1e-9 * x.shape[1] * np.abs(x).max(initial=0) * np.abs(y).max(initial=0)
    for (m, xm, xd), (_, ym, yd) in zip(sums, other):
        rows, cols = live.any(axis=1), live.any(axis=0)
        i, j, live = i[rows], j[cols], live[np.ix_(rows, cols)]
        if not len(i) or not len(j):
            break
        middle, spread = (xm[i] * m) @ ym[j].T, (xd[i] * m) @ yd[j].T + slack
        live = live & (middle + spread >= least[i][:, None]) & (middle - spread <= most[i][:, None])
    if not live.any():
        return (np.zeros(0, np.int64),) * 3
    rows, cols = live.any(axis=1), live.any(axis=0)
    i, j, live = i[rows], j[cols], live[np.ix_(rows, cols)]
    if live.mean() < 0.02:  # so few that they are gathered, not multiplied as a whole
        a, b = np.nonzero(live)
        s = np.array([], np.int64)
        if len(a):
            s = np.concatenate([np.einsum("nd,nd->n", x[i[a[k:k + 65536]]].astype(np.int64), y[j[b[k:k + 65536]]].astype(np.int64))
                                for k in range(0, len(a), 65536)])
        ok = (s >= least[i[a]]) & (s <= most[i[a]])
        return i[a[ok]], j[b[ok]], s[ok]
    s = exact(x[i], y[j])
    a, b = np.nonzero(live & (s >= least[i][:, None]) & (s <= most[i][:, None]))
    return i[a], j[b], s[a, b]


class Best:
    """The first ``k`` rows of each key by score (high first), vec_id and row id."""

    def __init__(self, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor  # a row below its key's floor is not among the first k
        self.rows = [np.zeros(0, np.int64) for _ in range(4)]  # key, score, vec_id, rid

    def add(self, key: np.ndarray, score: np.ndarray, vec: np.ndarray, rid: np.ndarray) -> None:
        if not len(key):
            return
        key, score, vec, rid = (np.concatenate(p) for p in zip(self.rows, (key, score, vec, rid)))
        order = np.lexsort((rid, vec, -score, key))
        key = key[order]
        first = np.concatenate(([True], key[1:] != key[:-1]))
        rank = np.arange(len(key)) - np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
        keep = rank < self.k
        self.rows = [key[keep], *(c[order][keep] for c in (score, vec, rid))]
        full = rank[keep] == self.k - 1
        self.floor[self.rows[0][full]] = self.rows[1][full]


class Strip:
    """Some anchors of one vector length, with their ranges and the best rows so far."""

    def __init__(self, a: dict, who: np.ndarray, x: np.ndarray, ranges: np.ndarray, best: Best):
        self.x, self.ranges, self.best, self.sums = x, ranges, best, summaries(x)
        self.row = np.searchsorted(who, a["owner"][ranges])
        self.label, self.rid = a["label"][who], a["rid"][who]
        self.least, self.most = a["least"][ranges], a["most"][ranges]

    def meet(self, y: np.ndarray, other: list, label: np.ndarray, vec: np.ndarray, rid: np.ndarray, same: bool) -> None:
        # an anchor's range spans those of its keys that can still gain a row
        n, floor = len(self.x), np.maximum(self.least, self.best.floor[self.ranges])
        least, most = np.full(n, NONE), np.full(n, -NONE)
        np.minimum.at(least, self.row, floor)
        np.maximum.at(most, self.row, self.most)
        match = self.label[:, None] == label[None, :]
        match = match & (self.rid[:, None] != rid[None, :]) if same else ~match
        i, j, s = survivors(self.x, y, match, least, most, self.sums, other)
        order = np.argsort(i, kind="stable")
        j, s = j[order], s[order]
        cut = np.searchsorted(i[order], np.arange(n + 1))
        keys, parts = [], []
        for key, w, low, high in zip(self.ranges.tolist(), self.row.tolist(), floor.tolist(), self.most.tolist()):
            part = np.arange(cut[w], cut[w + 1])
            part = part[(s[part] >= low) & (s[part] <= high)]
            if len(part) > self.best.k:  # ties with the k-th stay
                part = part[s[part] >= np.partition(s[part], len(part) - self.best.k)[len(part) - self.best.k]]
            keys.append(np.full(len(part), key))
            parts.append(part)
        part = np.concatenate(parts)
        self.best.add(np.concatenate(keys), s[part], vec[j[part]], rid[j[part]])


def search(rows: DataFrame, sent: Broadcast, same: bool, k: int, strip: int = 128, held: int = 8192) -> DataFrame:
    """Rows ``(key, score, vec_id, rid, rank)``: the first ``k`` rows of each range.

    ``sent`` holds anchors: rid, label, v (places and a matrix per length),
    and ranges ``(owner, least, most)``, sorted by owner; a key is the place of a
    range.  ``same``: rows of the anchor's label but its own, else of other
    labels.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = sent.value
        floor = np.full(len(a["owner"]), -NONE)
        strips: dict[int, list[Strip]] = {}
        for d, (at, x) in a["v"].items():
            for lo in range(0, len(at), strip):
                who = at[lo:lo + strip]
                ranges = np.flatnonzero(np.isin(a["owner"], who))
                if len(ranges):
                    strips.setdefault(d, []).append(Strip(a, who, x[lo:lo + strip], ranges, Best(k, floor)))

        def judge(t: pa.Table) -> None:
            label, rid = t.column("label").to_numpy(), t.column("rid").to_numpy()
            vec = t.column("vec_id").fill_null(NONE).to_numpy()
            for d, (to, y) in matrices(t.column("v").combine_chunks()).items():
                other = summaries(y)
                for s in strips.get(d, ()):
                    s.meet(y, other, label[to], vec[to], rid[to], same)

        waiting, n = [], 0
        for b in batches:
            waiting.append(b)
            n += b.num_rows
            if n >= held:
                judge(pa.Table.from_batches(waiting))
                waiting, n = [], 0
        if n:
            judge(pa.Table.from_batches(waiting))
        for s in (s for group in strips.values() for s in group):
            key, score, vec, rid = s.best.rows
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(score), pa.array(vec, mask=vec == NONE), pa.array(rid)],
                                             ["key", "score", "vec_id", "rid"])

    w = Window.partitionBy("key").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "rid")
    found = rows.mapInArrow(work, "key long, score long, vec_id long, rid long")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 3, high: int = 9,
         block_bytes: int = 8 << 20) -> DataFrame:
    """Rows ``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    A negative's score is between ``low`` and ``high`` tenths of the
    positive's.  ``is_anchor`` is a condition on vec_id.
    """
    spark = rows.sparkSession
    table = save(vectors(rows), "integer-vectors")
    path = scratch_dir(spark, "hard-negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(path)

    def block(part: list) -> None:
        at: dict[int, list[int]] = {}
        for i, r in enumerate(part):
            at.setdefault(len(r["v"]), []).append(i)
        a = {"rid": np.array([r["rid"] for r in part], np.int64), "label": np.array([r["label"] for r in part], np.int64),
             "v": {d: (np.array(i), np.array([part[q]["v"] for q in i], np.float64).reshape(len(i), d)) for d, i in at.items()},
             "owner": np.arange(len(part)), "least": np.full(len(part), -NONE), "most": np.full(len(part), NONE)}
        sent = spark.sparkContext.broadcast(a)
        found = sorted((tuple(r) for r in search(table, sent, True, positives).select("key", "rank", "score", "vec_id").collect()), key=lambda r: r[:2])
        sent.destroy()
        if not found:
            return
        score = [s for _, _, s, _ in found]
        a |= {"owner": np.array([o for o, *_ in found]), "least": np.array([-(-low * s // 10) for s in score]),
              "most": np.array([high * s // 10 for s in score])}
        told = spark.createDataFrame([(k, part[o]["vec_id"], v, s) for k, (o, _, s, v) in enumerate(found)],
                                     "key long, anchor_id long, positive_id long, positive_score long")
        sent = spark.sparkContext.broadcast(a)
        hard = search(table, sent, False, negatives)
        # as many rows as this block's positives, so their size is bounded like the block's
        (hard.join(F.broadcast(told), "key").select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
         .write.mode("append").parquet(path))
        sent.destroy()

    part, size = [], 0
    # the driver holds one block (and one partition of the anchors) at a time
    for r in save(table.where(is_anchor), "anchors").toLocalIterator():
        part.append(r)
        size += 8 * len(r["v"]) + 64
        if size >= block_bytes:
            block(part)
            part, size = [], 0
    if part:
        block(part)
    return spark.read.schema(schema).parquet(path)
