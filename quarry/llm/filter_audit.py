"""Which filters overlap: an audit of filter orders by a Gray-code walk over subsets.

Every document becomes a mask with one bit per filter it fails; documents with
the same mask form a cell, so what is left of a part are at most 32 counted
cells.  The walk visits the subsets of filters in Gray-code order: one filter
is toggled at a time, each cell keeps a counter of the active filters it
fails, and the running survivors change only by cells whose counter leaves or
reaches zero.  The 32 states are kept, and a step of any filter order is the
difference of two of them.

Defined results: a null text is the empty text (it fails A, no word is
distinct or repeated); a null part value is the empty string; a document with
a null doc_id is neither a copy of a smaller id nor smaller than one, rows
that repeat a doc_id are not smaller than each other; a document counts as
good or toxic when any row of ``labels`` with its doc_id says so, and a null
doc_id has no label; an empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import UPPER, hot_join, save

FILTERS = "ABCDE"
COUNTS = ["docs", "good", "toxic"]
#: The characters filter D looks for.
MARKS = b"#$%&*|"


def text_mask(text: str | None, min_words: int = 200) -> tuple[int, bytes]:
    """(bits of the failed filters A to D, digest of the whole text)."""
    raw = (text or "").encode()
    words = raw.split()  # at [\x20\x09-\x0D], as bytes have no other white space
    few = len(words) < min_words
    repeated = 100 * len(set(words)) < 50 * len(words)
    capitals = 100 * (len(raw) - len(raw.translate(None, UPPER.encode()))) > 3 * len(text or "")
    marked = len(raw.translate(None, MARKS)) < len(raw)
    return few | repeated << 1 | capitals << 2 | marked << 3, hashlib.sha256(raw).digest()


def masks(docs: DataFrame, part: Column) -> DataFrame:
    """Rows ``(doc_id, part, mask)``, one per document, all five filters judged."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            judged = [text_mask(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), pa.array([m for m, _ in judged], pa.int32()),
                 pa.array([d for _, d in judged], pa.binary())], ["doc_id", "part", "mask", "digest"])

    rows = save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(part.cast("string"), F.lit("")).alias("part"),
                            F.col("text").cast("string").alias("text"))
                .mapInArrow(work, "doc_id long, part string, mask int, digest binary"), "filter-masks")
    # a group of copies leaves one row a map task; texts that occur once need no join
    copies = save(rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
                  .where("copies > 1"), "filter-copies")
    found = hot_join(rows, copies, "digest", "copies", "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return found.select("doc_id", "part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"))


def cells(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows ``(part, mask, docs, good, toxic)``.

    Documents are counted by (doc_id, part, mask) before they meet their
    labels, so a doc_id that many rows repeat is one row of that join for each
    of its parts and masks.
    """
    counted = masked.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("docs"))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    joined = counted.join(known.where("doc_id IS NOT NULL"), "doc_id", "left")
    flagged = [F.sum(F.col("docs") * F.coalesce(F.col(c), F.lit(0))).alias(c) for c in COUNTS[1:]]
    return joined.groupBy("part", "mask").agg(*flagged, F.sum("docs").alias("docs")).select("part", "mask", *COUNTS)


def walk(counts: dict[int, tuple[int, ...]], n: int) -> list[tuple[int, ...]]:
    """Survivors (one number per count) of each subset of ``n`` filters, by a Gray-code walk."""
    width = len(next(iter(counts.values()), (0,)))
    failing = dict.fromkeys(counts, 0)  # per cell, the active filters it fails
    alive = [sum(c[k] for c in counts.values()) for k in range(width)]
    states: list[tuple[int, ...]] = [()] * (1 << n)
    active = 0
    states[0] = tuple(alive)
    for i in range(1, 1 << n):
        bit = i & -i
        active ^= bit
        step = 1 if active & bit else -1
        for mask, c in counts.items():
            if mask & bit:
                was, failing[mask] = failing[mask], failing[mask] + step
                if not was or not failing[mask]:
                    for k in range(width):
                        alive[k] -= step * c[k]
        states[active] = tuple(alive)
    return states


def orders(counts: dict[int, tuple[int, ...]], names: str = FILTERS) -> list[tuple]:
    """Per filter order and step: order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    n = len(names)
    states = walk(counts, n)
    fails = [sum(c[0] for m, c in counts.items() if m >> f & 1) for f in range(n)]
    shapley, out = [0] * n, []
    for order in itertools.permutations(range(n)):
        before = 0
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            lost = [x - y for x, y in zip(states[before], states[after])]
            shapley[f] += lost[0]
            out.append((order, step, states[after][0], lost, f))
            before = after
    return [("".join(names[f] for f in order), step, kept, lost[0], fails[f] - lost[0], counts.get(1 << f, (0,))[0], lost[1], lost[2],
             shapley[f]) for order, step, kept, lost, f in out]


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Per part, filter order and step: what is kept and lost (see the module's text)."""
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in names)

    def work(t: pa.Table) -> pa.Table:
        counts = {m: tuple(c) for m, *c in zip(*(t.column(x).to_pylist() for x in ("mask", *COUNTS)))}
        columns = list(zip(*orders(counts)))
        kinds = [pa.string(), pa.int32(), *[pa.int64()] * len(names)]
        arrays = [pa.array([t.column("part")[0].as_py()] * len(columns[0]), pa.string()), *(pa.array(c, k) for c, k in zip(columns, kinds))]
        return pa.table(arrays, ["part", "filter_order", "step", *names])

    # a group is the cells of one part: 32 rows at most
    return cells(masks(docs, F.col(part)), labels).groupBy("part").applyInArrow(work, schema)
