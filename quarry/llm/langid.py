"""Language identification by words first, then shorter and shorter n-grams.

Training counts words and character n-grams per language over a bounded
sample of labelled documents (``sample_docs`` per language on average, a
documented parameter).  A known word scores its log frequency in each
language; an unknown one scores the mean over its known n-grams of the longest
length that has any, from ``max_n`` down to single characters.  Many texts are
scored at a time by array operations: words and n-grams are found by 64-bit
hashes in sorted arrays.  ``word_scores`` is the same rule for a single word.

Defined results: a null text, or one without a letter, is ``und`` with score
0; ties go to the first language by name; with no labelled text every document
is ``und``; repeated rows are scored alike; an empty table gives an empty
result; other columns are kept, but columns called ``lang_pred`` or ``score``
give way to the result's.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import save, with_row_id
from quarry.llm.sp_codec import slices

LETTERS = r"\p{L}+"
#: An odd multiplier for the hashes of words and n-grams, and its inverse modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


@dataclass
class Model:
    langs: list[str]
    words: dict[str, int]  # word -> row of word_rows
    word_rows: np.ndarray  # log frequency per language
    grams: dict[str, int]  # n-gram, lengths 1..max_n -> row of gram_rows
    gram_rows: np.ndarray
    max_n: int


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word with its edges marked; single characters are unmarked."""
    if n == 1:
        return list(word)
    w = f"^{word}$"
    return [w[i:i + n] for i in range(len(w) - n + 1)]


def train(labelled: DataFrame, sample_docs: int = 1500, max_n: int = 4) -> Model:
    """Fit on ``labelled(text, lang)``; null texts and langs are ignored.

    Every language keeps a fixed share of its documents, chosen by a hash of
    text and row so that about ``sample_docs`` remain, repeated rows or not.
    Every word and n-gram of the sample is in the model, also those seen once.
    """
    rows = with_row_id(labelled.select("text", "lang"), "__rid").where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = sorted((r["lang"], r["count"]) for r in rows.groupBy("lang").count().collect())
    if not sizes:
        return Model([], {}, np.zeros((0, 0)), {}, np.zeros((0, 0)), max_n)
    langs = [x for x, _ in sizes]
    share = F.lit(0)
    for lang, n in sizes:
        share = F.when(F.col("lang") == lang, F.lit(min(1 << 20, -(-sample_docs * (1 << 20) // n)))).otherwise(share)
    sample = rows.where(F.pmod(F.xxhash64("text", "__rid", F.lit("sample")), F.lit(1 << 20)) < share).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = regex.compile(LETTERS)
        seen: dict[str, Counter] = {}

        def flush() -> pa.RecordBatch:
            out = []
            for lang, c in seen.items():
                pieces: list[Counter] = [Counter() for _ in range(max_n + 1)]
                pieces[0] = c
                for w, k in c.items():
                    for n in range(1, max_n + 1):
                        for g in grams(w, n):
                            pieces[n][g] += k
                out += [(lang, n, t, k) for n, p in enumerate(pieces) for t, k in p.items()]
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["lang", "n", "token", "k"])

        for b in batches:
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
                seen.setdefault(lang, Counter()).update(word.findall(text.lower()))
            if sum(map(len, seen.values())) > 200_000:
                yield flush()
        if any(seen.values()):
            yield flush()

    counts = save(sample.mapInArrow(count, "lang string, n long, token string, k long")
                  .groupBy("lang", "n", "token").agg(F.sum("k").alias("k")), "lang-counts")
    total: Counter = Counter()
    total.update({(r["lang"], r["n"]): r["k"] for r in counts.groupBy("lang", "n").agg(F.sum("k").alias("k")).collect()})
    table = counts.toArrow()  # as large as the sample's vocabulary
    kept = zip(*(table.column(c).to_pylist() for c in ("lang", "n", "token", "k")))
    at = {x: i for i, x in enumerate(langs)}
    rows_of: dict[bool, dict[str, list[float]]] = {False: {}, True: {}}
    floors = [[-float(np.log(2.0 * (total[x, n] + 1))) for x in langs] for n in range(max_n + 1)]
    for lang, n, token, k in sorted(kept):
        row = rows_of[n > 0].setdefault(token, list(floors[n]))
        row[at[lang]] = float(np.log(k / (total[lang, n] + 1)))
    parts = [({t: i for i, t in enumerate(d)}, np.array(list(d.values())).reshape(-1, len(langs))) for d in rows_of.values()]
    return Model(langs, *parts[0], *parts[1], max_n)


def word_scores(model: Model, word: str) -> np.ndarray | None:
    """Log frequency per language of a known word, else of its longest known n-grams."""
    found = model.words.get(word)
    if found is not None:
        return model.word_rows[found]
    for n in range(min(model.max_n, len(word) + 2), 0, -1):
        rows = [r for g in grams(word, n) if (r := model.grams.get(g)) is not None]
        if rows:
            return model.gram_rows[rows].mean(axis=0)
    return None


def hashes(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs ``start:end`` of code points ``c``: sums of code * BASE ** place."""
    up = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(len(c), BASE))))
    down = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(len(c), INVERSE))))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(c * up[:-1])))
    return (total[end] - total[start]) * down[start]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


@dataclass
class Probe:
    """A model as arrays: level 0 holds words, level n the n-grams of length n."""
    letters: np.ndarray  # one bit a code point
    keys: list[np.ndarray]  # sorted hashes
    rows: list[np.ndarray]
    langs: list[str]


def probe(model: Model) -> Probe:
    """The arrays of a model; a word and an n-gram are known by their hash."""
    is_letter = np.zeros(0x110000, bool)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for m in regex.finditer(LETTERS, every):
        is_letter[code_points(m[0])] = True
    keys, rows = [], []
    for level in range(model.max_n + 1):
        held = model.words if level == 0 else {g: r for g, r in model.grams.items() if len(g) == level}
        c = code_points("".join(held)).astype(np.uint64)
        end = np.cumsum([len(t) for t in held], dtype=np.int64)
        h = hashes(c, np.concatenate((np.zeros(1, np.int64), end))[:-1], end)
        order = np.argsort(h)
        values = model.word_rows if level == 0 else model.gram_rows
        keys.append(h[order])
        rows.append(values[np.array(list(held.values()), np.int64)][order])
    return Probe(np.packbits(is_letter), keys, rows, model.langs)


def look_up(keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in ``h`` of known hashes, their places in ``keys``)."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    hit = np.flatnonzero(keys[at] == h)
    return hit, at[hit]


def back_off(p: Probe, c: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores, whether any) of unknown words, all together: means over their longest known n-grams."""
    n, size = len(start), end - start + 2
    scores, known = np.zeros((n, len(p.langs))), np.zeros(n, bool)
    todo = np.arange(n)
    for level in range(len(p.keys) - 1, 0, -1):
        if not len(todo):
            break
        # the words end to end, each between its marks
        width = size[todo]
        first = np.cumsum(width) - width
        owner = np.repeat(np.arange(len(todo)), width)
        place = np.arange(len(owner)) - first[owner]
        w = c[np.clip(start[todo][owner] + place - 1, 0, len(c) - 1)]
        w[first], w[first + width - 1] = ord("^"), ord("$")
        # single characters are unmarked
        ok = np.flatnonzero((place > 0) & (place < width[owner] - 1) if level == 1 else place <= width[owner] - level)
        h = np.zeros(len(ok), np.uint64)
        for k in range(level - 1, -1, -1):
            h = h * BASE + w[ok + k]
        hit, at = look_up(p.keys[level], h)
        who = owner[ok[hit]]
        count = np.bincount(who, minlength=len(todo))
        for x in range(len(p.langs)):
            scores[todo, x] = np.bincount(who, p.rows[level][at, x], len(todo)) / np.maximum(count, 1)
        known[todo] = count > 0
        todo = todo[count == 0]
    return scores, known


def judge(p: Probe, is_letter: np.ndarray, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Languages and scores of several texts, their words looked up together."""
    low = [(t or "").lower() for t in texts]
    raw = code_points("\n".join(low) + "\n")
    mark = np.flatnonzero(np.diff(is_letter[raw], prepend=False))
    start, end = mark[::2], mark[1::2]
    doc = np.searchsorted(np.cumsum([len(t) + 1 for t in low]), start, side="right")
    c = raw.astype(np.uint64)
    unique, one, which = np.unique(hashes(c, start, end), return_index=True, return_inverse=True)
    scores, known = np.zeros((len(unique), len(p.langs))), np.zeros(len(unique), bool)
    hit, at = look_up(p.keys[0], unique)
    scores[hit], known[hit] = p.rows[0][at], True
    new = np.flatnonzero(~known)
    scores[new], known[new] = back_off(p, c, start[one[new]], end[one[new]])
    n = len(texts)
    words = np.bincount(doc, minlength=n)
    used = np.bincount(doc, known[which].astype(float), n)
    mean = np.stack([np.bincount(doc, scores[which, x], n) for x in range(len(p.langs))], 1) / np.maximum(used, 1)[:, None]
    share = np.exp(mean - mean.max(1, keepdims=True))
    # letters that no language has seen: all languages alike, the first by name
    best, score = mean.argmax(1).tolist(), np.where(words > 0, 1 / share.sum(1), 0.0)
    return [p.langs[b] if k else "und" for b, k in zip(best, words.tolist())], score


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs(text, ..)`` with ``lang_pred`` and ``score`` added; the text is dropped.

    The score is the best language's share when the mean log frequency per
    word of each language is turned back into a probability.  Texts are
    scored in slices of about 1 MB (a longer text alone), by arrays.
    """
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(probe(model).__dict__))
    docs = docs.drop("lang_pred", "score")
    keep = [c for c in docs.columns if c != "text"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Probe(**pickle.loads(sent.value))
        is_letter = np.unpackbits(p.letters).astype(bool)
        for b in batches:
            for part in slices(b, "text", chars=1 << 20):
                texts = part.column("text").to_pylist()
                langs, scores = judge(p, is_letter, texts) if p.langs else (["und"] * len(texts), np.zeros(len(texts)))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(langs, pa.string()),
                                                  pa.array(scores, pa.float64())], [*keep, "lang_pred", "score"])

    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"]
                       + ["lang_pred string", "score double"])
    return docs.mapInArrow(work, fields)
