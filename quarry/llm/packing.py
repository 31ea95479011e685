"""Mixture-controlled packing into fixed windows by deficit round-robin.

Every source is a queue of tokens.  In each window of ``window`` tokens a
source is granted its share of the target proportions; what rounding withholds
is its deficit and is carried to the next window, across partitions.  The
sources are the leaves of a balanced binary tree, and each node splits its
grant between its two sides by their integer weights,

    left(x) = floor(x * w_left / w),    right(x) = x - left(x),

so grants never fall, always add up to x, and no deficit exceeds the depth of
the tree.  This is a closed form that can be inverted: each document finds its
windows from its own place in its queue, and no task carries state for
another.  When a queue runs dry its share goes to the others (a new phase).
Weights default to the sources' own token counts, so that all queues run dry
together.

All sequences are full; what remains at the end is cut at powers of two, so
nothing is padded.

Defined results: a null text is empty and yields the end token alone; a null
source is a source; rows with a null or repeated doc_id are documents of their
own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import file_bytes, save


# --- grants -------------------------------------------------------------------

@dataclass
class Phase:
    start: int  # tokens placed before this phase
    paths: dict[str, list[tuple[bool, int, int]]]  # of each source, from the root: (to the right?, left weight, weight)
    given: dict[str, int]  # tokens of each queue placed before this phase

    def first(self, s: str, y: int) -> int:
        """The fewest tokens of this phase that grant ``y`` to source ``s``."""
        for right, left, whole in reversed(self.paths[s]):
            y = (y - 1) * whole // (whole - left) + 1 if right else -(-y * whole // left)
        return y

    def grants(self, s: str, lo: int, hi: int) -> tuple[int, int, int]:
        """Granted to ``s`` after ``lo`` and after ``hi`` tokens, and what sources before it get in between."""
        before = 0
        for right, left, whole in self.paths[s]:
            a, b = lo * left // whole, hi * left // whole
            if right:
                before, lo, hi = before + b - a, lo - a, hi - b
            else:
                lo, hi = a, b
        return lo, hi, before


def tree(weights: list[tuple[str, int]]) -> dict[str, list[tuple[bool, int, int]]]:
    """Paths of a balanced binary tree over the sources."""
    if len(weights) == 1:
        return {weights[0][0]: []}
    cut = len(weights) // 2
    left, whole = sum(w for _, w in weights[:cut]), sum(w for _, w in weights)
    return {s: [(right, left, whole), *path] for right, part in ((False, weights[:cut]), (True, weights[cut:]))
            for s, path in tree(part).items()}


@dataclass
class Plan:
    """Grants of all queues; positions count tokens of the packed output."""
    total: int
    window: int
    phases: list[Phase] = field(default_factory=list)

    def pieces(self, s: str, start: int, n: int) -> Iterator[tuple[int, int, int]]:
        """(place in the output, tokens into the document, length) of queue ``s`` from ``start`` for ``n`` tokens."""
        at, end = start, start + n
        for k, ph in enumerate(self.phases):
            if s not in ph.paths:
                continue
            until = self.phases[k + 1].start if k + 1 < len(self.phases) else self.total
            done = ph.given[s]
            last = done + ph.grants(s, 0, until - ph.start)[1]
            while at < min(end, last):
                # the segment (a window, cut where a phase begins or ends) that grants token ``at``
                w = (ph.start + ph.first(s, at - done + 1) - 1) // self.window
                lo, hi = max(w * self.window, ph.start), min((w + 1) * self.window, until)
                g0, g1, before = ph.grants(s, lo - ph.start, hi - ph.start)
                m = min(end, done + g1) - at
                yield lo + before + at - done - g0, at - start, m
                at += m
            if at == end:
                return

    def place(self, x: int) -> tuple[int, int, int]:
        """(sequence, offset, tokens left in it) of output position ``x``; the tail is cut at powers of two."""
        full = self.total // self.window
        if x < full * self.window:
            return x // self.window, x % self.window, self.window - x % self.window
        seq, at, rest = full, full * self.window, self.total - full * self.window
        while True:
            size = 1 << (rest.bit_length() - 1)
            if x < at + size:
                return seq, x - at, at + size - x
            seq, at, rest = seq + 1, at + size, rest - size


def plan(totals: Mapping[str, int], window: int, weights: Mapping[str, int] | None = None) -> Plan:
    """Phases of round-robin over queues of ``totals`` tokens; a source without a weight counts as 1."""
    out = Plan(sum(totals.values()), window)
    left, start = {s: n for s, n in sorted(totals.items()) if n > 0}, 0
    given = dict.fromkeys(left, 0)
    while left:
        ph = Phase(start, tree([(s, totals[s] if weights is None else weights.get(s, 1)) for s in left]), dict(given))
        # up to where some queue would be granted more than it holds
        n = min(sum(left.values()), min(ph.first(s, m + 1) - 1 for s, m in left.items()))
        out.phases.append(ph)
        for s in left:
            g = ph.grants(s, 0, n)[1]
            given[s] += g
            left[s] -= g
        left = {s: m for s, m in left.items() if m}
        start += n
    return out


# --- tokens -------------------------------------------------------------------

#: Words whose parts are plain to see: Latin-1 letters, digits and ASCII marks but for the apostrophe.
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9!-&(-/:-@\[-`{-~]*")
_PLAIN_TEXT = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9!-&(-/:-@\[-`{-~ \t\n]*")
_PARTS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 \t\n]+")


def byte_letters() -> dict[int, str]:
    """The characters that a byte-level vocabulary writes for bytes: printable ones as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def word_encoder(model: bytes, most: int = 300_000) -> Callable[[list[str]], list[bytes]]:
    """Encode texts with a tokenizer that drops white space, each distinct word once.

    Such a tokenizer never joins what a space, tab or line end parts, so a
    text's ids are those of its words in turn.  A plain text or word goes to the
    tokenizer's model part by part (runs of letters, single digits, runs of
    marks, as its pre-tokenizer parts them); any other goes through the whole
    tokenizer.  Known words are kept (at most ``most``); ids are little-endian
    unsigned 32-bit.
    """
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(model.decode())
    letters, bpe = byte_letters(), t.model
    memo: dict[str, bytes] = {}
    known: dict[str, bytes] = {}

    def learn(parts: list[str]) -> None:
        for x in parts:
            if x not in known:
                seen = x if x.isascii() else "".join([letters[b] for b in x.encode()])
                known[x] = array("I", [k.id for k in bpe.tokenize(seen)]).tobytes()

    def plain(text: str) -> bytes:
        parts = _PARTS.findall(text.lower())
        try:
            return b"".join([known[x] for x in parts])
        except KeyError:
            learn(parts)
            return b"".join([known[x] for x in parts])

    def mixed(text: str) -> bytes:
        words = text.replace("\n", " ").replace("\t", " ").split(" ")
        odd = []
        for w in {w for w in words if w not in memo}:
            if _PLAIN.fullmatch(w) and "<|" not in w:
                memo[w] = plain(w)
            else:
                odd.append(w)
        for w, e in zip(odd, t.encode_batch_fast(odd, add_special_tokens=False)):
            memo[w] = np.array(e.ids, "<u4").tobytes()
        return b"".join([memo[w] for w in words])

    def encode(texts: list[str]) -> list[bytes]:
        for d in (memo, known):
            if len(d) > most:
                d.clear()
        return [plain(x) if _PLAIN_TEXT.fullmatch(x) and "<|" not in x else mixed(x) for x in texts]

    return encode


def tokenized(docs: DataFrame, model_path: str, end_id: int) -> DataFrame:
    """Rows (doc_id, source, part, within, n, ids): queues of each partition, in its order.

    ``within`` counts the tokens of the same source before the row in the same
    partition.  ids are 16-bit (all below 65536) or 32-bit, little-endian.
    """
    sent = docs.sparkSession.sparkContext.broadcast(file_bytes(model_path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, part, seen = word_encoder(sent.value), TaskContext.get().partitionId(), {}
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                chunk = b.slice(at, 256)
                ids = [x + end for x in encode([t or "" for t in chunk.column("text").to_pylist()])]
                sources, within, n = chunk.column("source").to_pylist(), [], [len(x) // 4 for x in ids]
                for s, m in zip(sources, n):
                    within.append(seen.get(s, 0))
                    seen[s] = within[-1] + m
                wide = [np.frombuffer(x, "<u4") for x in ids]
                ids = [x.astype("<u2").tobytes() if x.max() < 1 << 16 else x.tobytes() for x in wide]
                yield pa.RecordBatch.from_arrays(
                    [chunk.column("doc_id"), chunk.column("source"), pa.array([part] * len(n), pa.int64()), pa.array(within, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "source", "part", "within", "n", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("source"), "text")
    return rows.mapInArrow(work, "doc_id long, source string, part long, within long, n long, ids binary")


# --- the operator -------------------------------------------------------------

def pack(docs: DataFrame, model_path: str, window: int = 4096, end_id: int = 2,
         weights: Mapping[str, int] | None = None) -> DataFrame:
    """Rows (doc_id, source, start, length, ids, doc_tokens, sequence_id, offset).

    ``ids``: the piece's tokens, little-endian unsigned 32-bit.  ``weights``:
    target proportions by source name, positive integers.  What reaches the driver is one number
    per source.  Queues go by partition, then by row.
    """
    rows = save(tokenized(docs, model_path, end_id), "tokens")
    sums = save(rows.groupBy("part", "source").agg(F.sum("n").alias("n")), "token-sums")
    totals = {r["source"]: r["n"] for r in sums.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    named = None if weights is None else {f"={k}": v for k, v in weights.items()}
    grants = plan(totals, window, named)
    order = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("part", "source", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

        def flush(out):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        out, weight = [], 0
        for b in batches:
            for doc, s, at, n, ids in zip(*(b.column(c).to_pylist() for c in ("doc_id", "source", "at", "n", "ids"))):
                ids = np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4").tobytes()
                for x, into, m in grants.pieces(s, at, n):
                    while m:
                        seq, offset, room = grants.place(x)
                        take = min(m, room)
                        out.append((doc, s[1:] if s else None, into, take, ids[4 * into:4 * (into + take)], n, seq, offset))
                        x, into, m = x + take, into + take, m - take
                weight += len(ids)
                if weight > 1 << 22:
                    yield flush(out)
                    out, weight = [], 0
        if out:
            yield flush(out)

    placed = rows.join(base, ["part", "source"]).select("doc_id", "source", (F.col("base") + F.col("within")).alias("at"), "n", "ids")
    return placed.mapInArrow(work, "doc_id long, source string, start long, length long, ids binary, doc_tokens long, "
                                   "sequence_id long, offset long")
