"""Toxicity by maximum-scoring segments of token log-odds.

Training counts, over a bounded sample of labelled texts, in how many toxic
and how many clean ones a word occurs.  A word's score is its log-odds under a
Dirichlet prior, moved ``z`` standard errors towards zero and lowered by
``drift``, so that clean text drifts down.  Words that training did not see,
or saw too rarely and in toxic texts only, back off to their prefix.  A linear-time scan finds all maximal scoring
segments of a text, and a segment of score S in a text of n words has the
extreme-value expectation ``E = K n exp(-lambda S)``; segments with ``E`` up to
``expect`` are its toxic passages.  The passages' ``-ln E`` add up to one
statistic per document (the best segment's where none is significant), which
a logistic curve turns into a probability.

The sample of texts the words are counted in is the only bounded one
(``sample_docs`` distinct texts of each label); lambda, K and the curve come
from every labelled text outside it, equal texts counted once.

Defined results: a null text and one without a letter have no segment and the
score of the least statistic; a document whose doc_id is null or has no label
teaches nothing; of several labels of a doc_id the highest counts, of several
labels of one text the mean, rounded (a half is toxic); without a labelled text
every score is 0; repeated rows are scored alike; an empty table gives an empty
result; other columns are kept by ``scan`` and ``score``, but columns with the
names of theirs give way.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import save, with_row_id

WORD = re.compile(r"[^\W\d_]+")
PREFIX = 5
SCAN = "n_words long, segments array<struct<start: int, end: int, score: double>>"
#: Edges and width of the bins the curve is fitted on.
LOW, HIGH, WIDTH = -10.0, 20.0, 0.25


@dataclass(frozen=True)
class Model:
    words: dict[str, float]  # words and ``prefix*`` entries with a score of their own
    drift: float
    rate: float = 1.0  # lambda
    scale: float = 0.1  # K
    curve: tuple[float, float] | None = None  # None: nothing was labelled
    expect: float = 0.01


class Lexicon(dict):
    """Word -> score; an unknown word has its prefix's score, else the drift."""

    def __init__(self, model: Model):
        super().__init__({w: s for w, s in model.words.items() if not w.endswith("*")})
        self.prefixes = {w[:-1]: s for w, s in model.words.items() if w.endswith("*")}
        self.drift = -model.drift

    def __missing__(self, word: str) -> float:
        return self.prefixes.get(word[:PREFIX], self.drift)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, last, score)`` in linear time (Ruzzo and Tompa 1999)."""
    total = np.cumsum(scores)
    at = np.flatnonzero(scores > 0)
    left, right = (total[at] - scores[at]).tolist(), total[at].tolist()
    held: list[tuple[float, float, int, int, int]] = []  # left sum, right sum, first, last, nearest held one with a smaller left sum
    for k, (a, b) in enumerate(zip(left, right)):
        first = k
        j = len(held) - 1
        while True:
            while j >= 0 and held[j][0] >= a:
                j = held[j][4]
            if j < 0 or held[j][1] >= b:
                held.append((a, b, first, k, j))
                break
            a, _, first, _, back = held[j]
            del held[j:]
            j = back
    return [(int(at[f]), int(at[l]), b - a) for a, b, f, l, _ in held]


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """``docs(text, ..)`` (but columns called ``score`` or ``predicted``) with ``n_words`` and all maximal ``segments`` added; the text is dropped.

    ``start`` and ``end`` (exclusive) of a segment are code points of the text
    in lower case, which has the length of the text but for a few letters.
    """
    docs = docs.drop("n_words", "segments", "score", "predicted")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c != "text"]

    def judge(lexicon: Lexicon, text: str | None) -> tuple[int, list[dict]]:
        low = (text or "").lower()
        words = WORD.findall(low)
        if not words:
            return 0, []
        found = maximal_segments(np.array([lexicon[w] for w in words]))
        if not found:
            return len(words), []
        spans = [m.span() for m in WORD.finditer(low)]
        return len(words), [{"start": spans[f][0], "end": spans[l][1], "score": s} for f, l, s in found]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(sent.value)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                out = [judge(lexicon, t.as_py()) for t in b.column("text")]
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array([n for n, _ in out], pa.int64()),
                                                  pa.array([s for _, s in out], kind)], [*keep, "n_words", "segments"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name != "text")
    return docs.mapInArrow(work, fields + SCAN)


# --- extreme values -----------------------------------------------------------

def surprise(model: Model, score: Column) -> Column:
    """-ln E of a segment in a text of ``n_words`` words."""
    return score * model.rate - F.log(F.greatest(F.col("n_words"), F.lit(1)) * model.scale)


def passages(scanned: DataFrame, model: Model) -> DataFrame:
    """``scanned`` with its significant ``passages`` (start, end, score, expect)."""
    told = F.transform("segments", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score"),
                                                      F.exp(-surprise(model, s["score"])).alias("expect")))
    return scanned.withColumn("passages", F.filter(told, lambda s: s["expect"] <= model.expect))


def statistic(model: Model) -> Column:
    """Sum of -ln E over the significant segments; without one the best segment's."""
    each = F.transform("segments", lambda s: surprise(model, s["score"]))
    many = F.filter(each, lambda x: x >= -math.log(model.expect))
    best = F.greatest(F.coalesce(F.array_max(each), surprise(model, F.lit(0.0))), surprise(model, F.lit(0.0)))
    return F.when(F.size(many) > 0, F.aggregate(many, F.lit(0.0), lambda a, x: a + x)).otherwise(best)


def score(scanned: DataFrame, model: Model) -> DataFrame:
    """``scanned`` with ``score`` (0 to 1) and ``predicted`` added."""
    if model.curve is None:
        p = F.lit(0.0)
    else:
        a, b = model.curve
        p = 1.0 / (1.0 + F.exp(-(F.lit(a) + F.lit(b) * F.greatest(F.lit(LOW), F.least(F.lit(HIGH), statistic(model))))))
    return scanned.withColumn("score", p).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def fit_extremes(texts: DataFrame) -> tuple[float, float]:
    """(lambda, K) of clean texts' ``(n_words, best)`` segment scores, by maximum likelihood.

    One aggregate: for each lambda of a grid the sum that gives K and the
    likelihood.  Texts whose best segment has no score say nothing.
    """
    grid = [0.05 * 1.12 ** i for i in range(40)]
    r = texts.select("n_words", F.col("best").alias("s")).where("s > 0").agg(F.count("*").alias("n"), F.sum("s").alias("s"), F.sum(F.log("n_words")).alias("l"),
                 *[F.sum(F.col("n_words") * F.exp(F.col("s") * -x)).alias(f"e{i}") for i, x in enumerate(grid)]).first()
    if not r["n"]:
        return 1.0, 0.1
    n = r["n"]

    def likelihood(i: int) -> float:
        return n * math.log(grid[i]) + n * math.log(n / r[f"e{i}"]) - grid[i] * r["s"]

    i = max(range(len(grid)), key=likelihood)
    return grid[i], n / r[f"e{i}"]


def fit_curve(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Logistic curve (a, b >= 0) over ``(statistic, toxic texts, clean texts)``, by ridge Newton steps."""
    x, y, n = (np.array(c, float) for c in zip(*[(v, t, t + c) for v, t, c in bins]))
    start = np.array([math.log((y.sum() + 0.5) / (n.sum() - y.sum() + 0.5)), 0.5])
    w, hold = start.copy(), np.array([0.1, 1.0])
    design = np.stack([np.ones_like(x), x])

    def loss(v: np.ndarray) -> float:
        m = v @ design
        return float((n * np.logaddexp(0, m) - y * m).sum() + 0.5 * (hold * (v - start) ** 2).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(w @ design, -40, 40)))
        slope = design @ (y - n * p) - hold * (w - start)
        step = np.linalg.solve((design * (n * p * (1 - p))) @ design.T + np.diag(hold), slope)
        while loss(w + step) > loss(w) and np.abs(step).max() > 1e-12:
            step = step / 2
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(w[1], 0.0))


# --- words --------------------------------------------------------------------

def log_odds(toxic: Column, clean: Column, n_toxic: int, n_clean: int, prior: float, z: float, drift: float) -> Column:
    """Log-odds of occurring in a toxic text against a clean one, shrunk and lowered.

    The prior of a word is ``prior`` texts spread by the word's share of both
    kinds, half a text at least.
    """
    alpha = F.greatest(F.lit(0.5), (toxic + clean) * (prior / (n_toxic + n_clean)))

    def logit(y: Column, n: int) -> Column:
        return F.log((y + alpha) / (F.lit(float(n)) + prior + 1.0 - y - alpha))

    delta = logit(toxic, n_toxic) - logit(clean, n_clean)
    error = F.sqrt(1.0 / (toxic + alpha) + 1.0 / (clean + alpha))
    return F.signum(delta) * F.greatest(F.lit(0.0), F.abs(delta) - F.lit(z) * error) - F.lit(drift)


def count_words(texts: DataFrame) -> DataFrame:
    """Rows ``(word, toxic, clean)``: texts of ``texts(text, toxic)`` with each word, and with each ``prefix*``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, kinds = [], []
            for text, toxic in zip(b.column("text"), b.column("toxic").to_pylist()):
                seen = set(WORD.findall((text.as_py() or "").lower()))
                seen |= {f"{w[:PREFIX]}*" for w in seen if len(w) >= PREFIX}
                words += seen
                kinds += [toxic] * len(seen)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(kinds, pa.int32())], ["word", "toxic"])

    return texts.mapInArrow(work, "word string, toxic int").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, sample_docs: int = 8000, prior: float = 10.0,
          z: float = 2.0, drift: float = 0.1, expect: float = 0.01) -> tuple[Model, DataFrame]:
    """(model, ``scan`` of all ``docs(doc_id, text, ..)``).

    Fitted on the rows for which ``learn`` holds (all, without one) and which
    ``labels(doc_id, toxic)`` names.  The scan is written once: texts meet no
    join, what meets the labels are row ids, digests and segments.
    """
    rows = with_row_id(docs, "__rid")
    ids = rows.where(learn) if learn is not None else rows
    ids = save(ids.select("__rid", F.col("doc_id").cast("long").alias("doc_id"),
                          F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256).alias("digest")), "toxic-digests")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # a text is one row from here on, whatever its copies
    labelled = save(ids.join(known, "doc_id").groupBy("digest").agg(
        F.min("__rid").alias("__rid"), (F.avg("toxic") >= 0.5).cast("int").alias("toxic")), "toxic-texts")
    size = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    if not size:
        model = Model({}, drift, expect=expect)
        return model, scan(docs, model)
    share = F.lit(0)
    for kind, n in size.items():  # two thirds of a small table, a bounded number of a large one
        share = F.when(F.col("toxic") == kind, F.lit(min((2 << 20) // 3, -(-sample_docs * (1 << 20) // n)))).otherwise(share)
    labelled = labelled.withColumn("counted", F.pmod(F.xxhash64("digest", F.lit("words")), F.lit(1 << 20)) < share)
    sample = labelled.where("counted").select("__rid", "toxic")
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    # about 2 * sample_docs row ids
    texts = rows.select("__rid", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "__rid")
    found = save(count_words(texts.select("text", "toxic")), "toxic-words")
    odds = found.withColumn("s", log_odds(F.col("toxic"), F.col("clean"), n.get(1, 0), n.get(0, 0), prior, z, drift))
    # without evidence a word backs off like an unknown one, but for words that clean texts hold
    own = odds.where(~F.col("word").endswith("*")).withColumn("prefix", F.concat(F.substring("word", 1, PREFIX), F.lit("*")))
    telling = save(odds.where(F.col("word").endswith("*") & (F.col("s") != -drift)).select(F.col("word").alias("prefix"), "s"), "toxic-prefixes")
    words = own.where(F.col("s") != -drift).select("word", "s").unionByName(
        own.where((F.col("s") == -drift) & (F.col("clean") > 0)).join(telling.select("prefix"), "prefix", "left_semi").select("word", "s")
    ).unionByName(telling.select(F.col("prefix").alias("word"), "s"))
    model = Model({r["word"]: r["s"] for r in words.collect()}, drift, expect=expect)  # at most the words of the sample
    scanned = save(scan(rows, model), "toxic-scanned")
    # every labelled text outside the sample
    rest = save(labelled.where("NOT counted").select("__rid", "toxic"), "toxic-rest")
    best = scanned.select("__rid", "n_words", F.array_max(F.transform("segments", lambda x: x["score"])).alias("best"))
    rate, scale = fit_extremes(best.join(rest.where("toxic = 0"), "__rid"))
    model = Model(model.words, drift, rate, scale, (0.0, 0.0), expect)
    t = F.greatest(F.lit(LOW), F.least(F.lit(HIGH), statistic(model)))
    bins = scanned.select("__rid", F.round(t / WIDTH).cast("int").alias("bin")).join(rest, "__rid").groupBy("bin").agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")).collect()
    curve = fit_curve([(r["bin"] * WIDTH, r["toxic"], r["clean"]) for r in bins] or [(0.0, size.get(1, 0), size.get(0, 0))])
    return Model(model.words, drift, rate, scale, curve, expect), scanned.drop("__rid")
