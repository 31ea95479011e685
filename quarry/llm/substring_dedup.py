"""Substring dedup over sliding spans of sentences.

A sentence ends at ``.``, ``!`` or ``?`` before white space, or at a line end.
Every run of at least ``min_sentences`` consecutive sentences with at least
``min_words`` words counts, a run of fewer sentences if it has ``ALONE`` words,
and a whole text that has no such run.  The shortest runs from and up to every
sentence stand for all of them.  These spans are hashed in normal form (lower
case, single spaces), hashes are joined globally, the first occurrence of each
(smallest doc_id, then first row, then place) stays, and every sentence that
any other occurrence covers is removed.

Only whole sentences are compared and removed: a passage cut or glued inside
sentences loses those that lie in it whole, and its two edges stay.

Defined results: null and empty texts have no sentences and come back as they
are; rows with a null doc_id come last; repeated rows are occurrences of their
own, so a second copy loses all its spans; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import hot_join, save, with_row_id


def sentences(text: str) -> list[tuple[int, int]]:
    """``(start, end)`` of the sentences; together they are the whole text."""
    out = []
    for m in re.finditer(r"[^\n]*\n|[^\n]+\Z", text):
        line, at = m[0], m.start()
        start = 0
        for c in re.finditer(r"[.!?]+[^\S\n]+", line):
            out.append((at + start, at + c.end()))
            start = c.end()
        if start < len(line):
            out.append((at + start, at + len(line)))
    return out


#: Words from which a run counts though it has fewer sentences than asked for.
ALONE = 50


def spans(text: str, min_sentences: int, min_words: int) -> list[tuple[int, int, int]]:
    """``(first sentence, number of sentences, hash)`` of every span.

    The shortest span from each sentence on and the shortest up to each one:
    what holds for a run holds for a longer one, so these cover the same
    sentences as all runs that are long enough.
    """
    words = [text[a:b].lower().split() for a, b in sentences(text)]
    real = [i for i, w in enumerate(words) if w]  # blank lines are no sentences
    size = np.cumsum([0] + [len(words[i]) for i in real])
    joined = [" ".join(words[i]).encode() for i in real]
    n = len(real)
    k = np.arange(n)
    end = np.maximum(k + min_sentences, np.searchsorted(size, size[:-1] + min_words))
    end = np.minimum(end, np.searchsorted(size, size[:-1] + ALONE))
    start = np.minimum(k + 1 - min_sentences, np.searchsorted(size, size[1:] - min_words, "right") - 1)
    start = np.maximum(start, np.searchsorted(size, size[1:] - ALONE, "right") - 1)
    found = {(i, j) for i, j in zip(k.tolist(), end.tolist()) if j <= n} | {(i, j + 1) for i, j in zip(start.tolist(), k.tolist()) if i >= 0}
    out = []
    for i, j in sorted(found) or [(0, n)] * (n > 0):
        # a whole text under the minimum equals whole texts only
        h = xxhash.xxh3_64_intdigest(b"\n".join(joined[i:j]), 0 if found else 1)
        out.append((real[i], real[j - 1] - real[i] + 1, h - (1 << 64) if h >> 63 else h))
    return out


def remove(text: str, covered: set[int]) -> str:
    """The text without the given sentences."""
    return "".join(text[a:b] for i, (a, b) in enumerate(sentences(text)) if i not in covered)


def deduplicate(docs: DataFrame, min_sentences: int = 2, min_words: int = 12) -> DataFrame:
    """Rows (rid, doc_id, text, n_sentences, n_removed); ``text`` is what remains.

    Only hashes and places are joined; a hash that many documents share is
    reduced to its first place and count before it is shuffled.
    """
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part, out = b.slice(k, 512), []
                for rid, doc, text in zip(*(part.column(c).to_pylist() for c in ("rid", "doc_id", "text"))):
                    out += [(rid, doc, *s) for s in spans(text or "", min_sentences, min_words)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                        zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()))], ["rid", "doc_id", "at", "n", "h"])

    source = with_row_id(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    found = save(source.mapInArrow(find, "rid long, doc_id long, at int, n int, h long"), "sentence-spans")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid", "at")
    first = save(found.groupBy("h").agg(F.min(place).alias("first"), F.count("*").alias("copies")).where("copies > 1"), "repeated-spans")
    again = hot_join(found, first, "h", "copies").where(
        (F.col("rid") != F.col("first.rid")) | (F.col("at") != F.col("first.at")))
    # runs of spans rather than sentences: (at, n) pairs of one document, however many, in one row
    hits = again.groupBy("rid").agg(F.collect_list(F.struct("at", "n")).alias("hits")).withColumnRenamed("rid", "hit_rid")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part, out = b.slice(k, 512), []
                for rid, doc, text, hit in zip(*(part.column(c).to_pylist() for c in ("rid", "doc_id", "text", "hits"))):
                    covered = {i for x in hit or () for i in range(x["at"], x["at"] + x["n"])}
                    total = len(sentences(text or ""))
                    out.append((rid, doc, remove(text, covered) if covered else text, total, len(covered)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                    ["rid", "doc_id", "text", "n_sentences", "n_removed"])

    return (source.join(hits, F.col("rid") == F.col("hit_rid"), "left").select("rid", "doc_id", "text", "hits")
            .mapInArrow(cut, "rid long, doc_id long, text string, n_sentences long, n_removed long"))
