"""SimHash near-dedup by a binary trie self-join.

Fingerprints are read as root-to-leaf paths of a binary trie.  Two nodes are
visited together; a step into unlike children adds one differing bit, and a
pair of nodes whose differing bits exceed the budget is pruned with all its
leaves.  For ``k`` allowed bits the 64 bits fall into ``k + 1`` blocks, one of
which must be equal in any linked pair; so the trie is joined once per block,
with that block rotated to the front, and only equal-prefix subtries meet.
Each subtrie is one unit of shuffled work; subtries above ``leaf_rows`` rows
are split further into pairs of child nodes, by plain DataFrame steps, before
any task gathers them.

Defined results: text is lower-cased A-Z only and cut into words at
``[\\x20\\x09-\\x0D]``; null, empty and blank texts have fingerprint zero and
link like any other; repeated rows and ties share a fingerprint and a
component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import components, hot_join, save, with_row_id, without_rows


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of the word shingles, each hashed by XXH64 with seed 42."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:]
    ones, xx = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 15):
        part = zip(first[at:at + (1 << 15)].tolist(), last[at:at + (1 << 15)].tolist())
        h = np.array([xx(line[a:b], 42) for a, b in part], dtype=np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << b for b in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """Rows ``(rid, doc_id, fp)``; ``fp`` is the fingerprint as a signed long."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("rid"), b.column("doc_id"), pa.array(fp.view(np.int64))],
                                             ["rid", "doc_id", "fp"])

    rows = with_row_id(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return rows.mapInArrow(work, "rid long, doc_id long, fp long")


# --- node pairs inside a task -------------------------------------------------

def trie_pairs(v: np.ndarray, nodes: tuple, depth: int, left: np.ndarray, width: int = 64,
               direct: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of ``v`` within the budget, by descending node pairs level by level.

    ``nodes``: start pairs as ranges ``(a from, a to, b from, b to)`` of ``v``,
    where a range is one trie node at ``depth``: its paths (uint64, sorted)
    agree in their first ``depth`` bits.  A node may meet itself.  ``left``:
    the bits each pair may still differ in.  Node pairs with at most
    ``direct`` leaf pairs are compared outright.  Yields candidates; the
    caller compares whole fingerprints.
    """
    alo, ahi, blo, bhi = nodes
    for level in range(depth, width + 1):
        own = alo == blo
        size = (ahi - alo) * (bhi - blo)
        live = (size > 0) & ~(own & (ahi - alo < 2))
        small = live & ((size <= direct) | (level == width))
        if small.any():
            yield from expand(alo[small], ahi[small], blo[small], bhi[small], own[small])
        live &= ~small
        if not live.any():
            return
        alo, ahi, blo, bhi, left, own = (x[live] for x in (alo, ahi, blo, bhi, left, own))
        bit = (v >> np.uint64(width - 1 - level)) & np.uint64(1)
        ones = np.concatenate(([0], np.cumsum(bit, dtype=np.int64)))
        am, bm = ahi - (ones[ahi] - ones[alo]), bhi - (ones[bhi] - ones[blo])
        # children: both zero, both one, and the two unlike pairs (one of them when a node meets itself)
        alo, ahi, blo, bhi, left = (np.concatenate(x) for x in (
            (alo, am, alo, am[~own]), (am, ahi, am, ahi[~own]), (blo, bm, bm, blo[~own]), (bm, bhi, bhi, bm[~own]),
            (left, left, left - 1, left[~own] - 1)))
        ok = left >= 0
        alo, ahi, blo, bhi, left = (x[ok] for x in (alo, ahi, blo, bhi, left))


def expand(alo, ahi, blo, bhi, own, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All leaf pairs of the given node pairs, at most about ``most`` at a time."""
    na, nb = ahi - alo, bhi - blo
    # one row of a node pair at a time, so a large pair is dealt out too
    at = np.repeat(np.arange(len(na)), na)
    i = np.arange(len(at)) - np.repeat(np.cumsum(na) - na, na) + alo[at]
    start = np.where(own[at], i + 1, blo[at])
    n = bhi[at] - start
    keep = n > 0
    i, start, n = i[keep], start[keep], n[keep]
    total = np.cumsum(n)
    cut = 0
    while cut < len(n):
        base = total[cut - 1] if cut else 0
        end = max(cut + 1, int(np.searchsorted(total, base + most, side="right")))
        m = n[cut:end]
        a = np.repeat(i[cut:end], m)
        b = np.arange(len(a)) - np.repeat(np.cumsum(m) - m, m) + np.repeat(start[cut:end], m)
        yield a, b
        cut = end


def stars(n: int, pairs: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star per component of ``pairs`` over ``0..n-1``: (id, smallest id), without roots."""
    order = np.argsort(ids, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    low = np.arange(n)
    if pairs:
        a, b = (rank[np.concatenate(x)] for x in zip(*pairs))
        while True:
            m = np.minimum(low[a], low[b])
            new = low.copy()
            for x in (low[a], low[b], a, b):
                np.minimum.at(new, x, m)
            while (new != new[new]).any():
                new = new[new]
            if (new == low).all():
                break
            low = new
    named = ids[order]
    keep = named != named[low]
    return named[keep], named[low][keep]


# --- the distributed join -----------------------------------------------------

def blocks(bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of ``bits + 1`` blocks of the 64 bits, from the top."""
    cuts = [64 * i // (bits + 1) for i in range(bits + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def links(classes: DataFrame, bits: int = 4, leaf_rows: int = 50_000) -> DataFrame:
    """Star edges ``(a, b)`` that connect what links of ``classes(fp, cid)`` connect.

    Every pair of fingerprints at ``bits`` or fewer differing bits is visited;
    each task returns only a star per component it found, so the edges stay
    below ``(bits + 1)`` times the rows and the links of a dense group are
    never shuffled.
    """
    parts = blocks(bits)
    rotated = [F.struct(F.lit(r).alias("r"),
                        (F.shiftleft("fp", at) if not at else
                         F.shiftleft("fp", at).bitwiseOR(F.shiftrightunsigned("fp", 64 - at))).alias("path"))
               for r, (at, _) in enumerate(parts)]
    # a unit of work is a pair of trie nodes: (rotation, prefix a, prefix b, depth, differing bits so far);
    # side 0: the row is below both (a = b), 1: below a, 2: below b
    width = F.element_at(F.array(*[F.lit(w) for _, w in parts]), F.col("r") + 1)
    rows = (classes.select("fp", "cid", F.explode(F.array(*rotated)).alias("x")).select("fp", "cid", "x.*")
            .withColumn("depth", width)
            .withColumn("pa", F.expr("shiftrightunsigned(path, 64 - depth)")).withColumn("pb", F.col("pa"))
            .withColumn("diff", F.lit(0)).withColumn("side", F.lit(0)))
    key = ["r", "depth", "pa", "pb", "diff"]
    done = []
    while True:
        # only node pairs with too many rows come back here; their number of levels is at most 64.  Their list is
        # written, so its size is known when the join is planned: beyond the broadcast threshold it is shuffled
        big = save(rows.groupBy(*key).count().where(F.col("count") > leaf_rows).select(*key), "trie-big")
        if big.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(big, key, "left_anti"))
        rows = save(split(rows.join(big, key, "left_semi"), bits), "trie-split")
    units = done[0]
    for more in done[1:]:
        units = units.unionByName(more)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            cols = {c: b.column(c).to_numpy() for c in ("r", "depth", "pa", "pb", "diff", "side", "path", "fp", "cid")}
            new = np.ones(len(cols["r"]), bool)
            if len(new):
                new[1:] = np.any([cols[c][1:] != cols[c][:-1] for c in ("r", "depth", "pa", "pb", "diff")], axis=0)
                held.append(cols)
                n += len(new)
            if n >= 1 << 17:  # join the whole units held, keep the last, which may go on
                cols = {c: np.concatenate([h[c] for h in held]) for c in held[0]}
                new = np.any([cols[c][1:] != cols[c][:-1] for c in ("r", "depth", "pa", "pb", "diff")], axis=0)
                cut = int(np.flatnonzero(new)[-1]) + 1 if new.any() else 0
                if cut:
                    yield joined({c: x[:cut] for c, x in cols.items()})
                held, n = [{c: x[cut:] for c, x in cols.items()}], len(cols["r"]) - cut
        if n:
            yield joined({c: np.concatenate([h[c] for h in held]) for c in held[0]})

    def joined(c: dict[str, np.ndarray]) -> pa.RecordBatch:
        fp, path = c["fp"].view(np.uint64), c["path"].view(np.uint64)
        new = np.any([c[k][1:] != c[k][:-1] for k in ("r", "depth", "pa", "pb", "diff")], axis=0)
        bounds = np.concatenate(([0], np.flatnonzero(new) + 1, [len(fp)]))
        lo, hi = bounds[:-1], bounds[1:]
        own = c["side"][lo] == 0
        found = []

        def check(pairs):
            for i, j in pairs:
                x = fp[i] ^ fp[j]
                ok = np.bitwise_count(x) <= bits
                for r, (at, w) in enumerate(parts):  # the first rotation with an equal block reports the pair
                    same = (x << np.uint64(at)) >> np.uint64(64 - w) == 0
                    ok &= ~(same & (r < c["r"][i]))
                if ok.any():
                    found.append((i[ok], j[ok]))
                    if sum(len(p[0]) for p in found) > 1 << 21:
                        a, b = stars(len(fp), found, np.arange(len(fp)))
                        found[:] = [(a, b)]

        for depth in np.unique(c["depth"][lo]).tolist():
            at = (c["depth"][lo] == depth)
            use = at & own
            if use.any():
                check(trie_pairs(path, (lo[use], hi[use], lo[use], hi[use]), depth, bits - c["diff"][lo[use]]))
            use = at & ~own
            if use.any():
                ones = np.concatenate(([0], np.cumsum(c["side"] == 2)))
                mid = hi[use] - (ones[hi[use]] - ones[lo[use]])
                check(trie_pairs(path, (lo[use], mid, mid, hi[use]), depth, bits - c["diff"][lo[use]]))
        a, b = stars(len(fp), found, c["cid"])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return (units.repartition(*[F.col(k) for k in key])
            .sortWithinPartitions(*key, "side", F.col("path").bitwiseXOR(F.lit(-(1 << 63))))
            .mapInArrow(work, "a long, b long"))


def split(rows: DataFrame, bits: int) -> DataFrame:
    """Deal the rows of each node pair out to the pairs of its children."""
    bit = F.expr("cast(shiftrightunsigned(path, 63 - depth) & 1 AS bigint)")

    def to(side, x, y, worse):
        return F.struct(F.lit(side).alias("side"), (F.col("pa") * 2 + x).alias("pa"), (F.col("pb") * 2 + y).alias("pb"),
                        (F.col("diff") + F.lit(worse)).alias("diff"))

    b = F.col("bit")
    own = F.array(to(0, b, b, 0), F.when(b == 0, to(1, F.lit(0), F.lit(1), 1)).otherwise(to(2, F.lit(0), F.lit(1), 1)))
    at_a = F.array(*[F.struct(F.lit(1).alias("side"), (F.col("pa") * 2 + b).alias("pa"), (F.col("pb") * 2 + y).alias("pb"),
                              (F.col("diff") + (b != y).cast("int")).alias("diff")) for y in (0, 1)])
    at_b = F.array(*[F.struct(F.lit(2).alias("side"), (F.col("pa") * 2 + x).alias("pa"), (F.col("pb") * 2 + b).alias("pb"),
                              (F.col("diff") + (b != x).cast("int")).alias("diff")) for x in (0, 1)])
    kinds = F.when(F.col("side") == 0, own).when(F.col("side") == 1, at_a).otherwise(at_b)
    return (rows.withColumn("bit", bit).select("r", "depth", "path", "fp", "cid", F.explode(kinds).alias("x"))
            .select("fp", "cid", "r", "path", (F.col("depth") + 1).alias("depth"), "x.pa", "x.pb", "x.diff", "x.side")
            .where(F.col("diff") <= bits))


def near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4, leaf_rows: int = 50_000) -> DataFrame:
    """Rows ``(rid, doc_id, fp, component_id, component)``: the smallest doc_id reachable by links, and the smallest row id."""
    rows = save(fingerprints(docs, shingle), "simhash")
    # a null doc_id takes no part in the minimum unless the whole class has none
    big = F.lit((1 << 63) - 1)
    classes = save(rows.groupBy("fp").agg(F.min(F.coalesce("doc_id", big)).alias("low"), F.count("*").alias("copies"),
                                          F.min("rid").alias("cid")), "simhash-classes")
    parts = components(links(classes.select("fp", "cid"), bits, leaf_rows))
    named = save(classes.join(parts.withColumnRenamed("id", "cid"), "cid", "left")
                 .withColumn("component", F.coalesce("component", "cid")), "simhash-parts")
    best = named.groupBy("component").agg(F.min("low").alias("component_id"), F.count("*").alias("classes"))
    named = save(hot_join(named, save(best, "simhash-best"), "component", "classes"), "simhash-named")
    return hot_join(rows, named.select("fp", "component_id", "component", "copies"), "fp", "copies").select(
        "rid", "doc_id", "fp", F.when(F.col("component_id") != big, F.col("component_id")).alias("component_id"), "component")


def keep_one(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """One document of each component (its smallest doc_id, then first row), all columns."""
    found = near_duplicates(docs, shingle, bits)
    # not by component_id: doc_ids may repeat or be null, row ids do not
    first = found.groupBy("component").agg(F.min_by("rid", F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("rid"))
    return without_rows(docs, found.join(first, "rid", "left_anti").select(F.col("rid").alias("__rid")))
