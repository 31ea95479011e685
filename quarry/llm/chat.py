"""Chat formatting with loss masks aligned by token offsets.

A conversation is rendered as ``<|im_start|>role<|im_sep|>text<|im_end|>`` per
turn, and what is rendered is written as one row, or as several rows of whole
turns where it is long: no token crosses a control string, so the ids are those
of the whole string.  Texts and roles may contain control strings: every ``<`` followed by
backslashes and ``|`` gets one more backslash, which makes ``<|`` impossible
inside them and is undone exactly by taking one away.  Every rendered string is
encoded once, with offsets; the assistant spans and the token spans are both
sorted, and binary search marks the tokens under the loss.

Defined results: rows go by turn (nulls first), then role, then text, so ties
have an order; a null text or role is the empty string; repeated rows are
turns of their own; rows with a null conv_id form one conversation; an empty
table gives an empty result; other columns are ignored.

A conversation of any length: turns are dealt out by ranges of (conv_id, turn),
so many tasks share a hot conversation, and each holds one piece of it (about
``piece_chars`` characters, or one longer turn) at a time.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import file_bytes, save

#: The template's control strings.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
_TURN = re.compile(r"<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>", re.S)


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int, str]]]:
    """The formatted conversation and its text spans ``(start, end, role)`` in code points."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEP}", escape(text)
        spans.append((at + len(head), at + len(head) + len(body), role))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns, read back from a formatted conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def loss_mask(tokens: list[tuple[int, int]], spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens overlap a span; both lists are sorted, spans do not overlap."""
    t = np.array(tokens, np.int64).reshape(-1, 2)
    s = np.array([x for x in spans if x[1] > x[0]], np.int64).reshape(-1, 2)
    if not len(s):
        return np.zeros(len(t), bool)
    # the last span that starts before the token ends
    k = np.searchsorted(s[:, 0], t[:, 1], side="left") - 1
    return (k >= 0) & (t[:, 0] < s[k, 1]) & (t[:, 1] > t[:, 0])


def masked_text(formatted: str, tokens: list[tuple[int, int]], mask: np.ndarray) -> str:
    """The characters under the mask, each once, unescaped turn by turn.

    Tokens that share a character (a character cut into bytes) count once.
    """
    out, run_from, run_to = [], -1, -1
    for (a, b), on in zip(tokens, mask.tolist()):
        if not on:
            continue
        if a > run_to:
            if run_to >= 0:
                out.append(unescape(formatted[run_from:run_to]))
            run_from = a
        run_to = max(run_to, b)
    if run_to >= 0:
        out.append(unescape(formatted[run_from:run_to]))
    return "".join(out)


class Formatted(NamedTuple):
    formatted: str
    ids: list[int]
    offsets: list[tuple[int, int]]
    mask: np.ndarray


def tokenizer(model: bytes):
    """The byte-level tokenizer with the control strings as tokens of their own."""
    from tokenizers import AddedToken, Tokenizer
    t = Tokenizer.from_str(model.decode())
    t.add_special_tokens([AddedToken(x, normalized=False) for x in (START, SEP, END)])
    return t


def format_conversation(turns: list[tuple[str, str]], t, loss_role: str = "assistant") -> Formatted:
    formatted, spans = render(turns)
    e = t.encode(formatted, add_special_tokens=False)
    return Formatted(formatted, e.ids, e.offsets, loss_mask(e.offsets, [(a, b) for a, b, r in spans if r == loss_role]))


PIECE = "part int, piece long, whole boolean, conv_id long, formatted string, ids array<int>, starts array<int>, ends array<int>, loss_mask array<boolean>"


def format_chats(rows: DataFrame, model_path: str, loss_role: str = "assistant", piece_chars: int = 1 << 20) -> DataFrame:
    """Rows ``(part, piece, whole, conv_id, formatted, ids, starts, ends, loss_mask)``, written.

    A conversation is its rows in the order of ``part`` and ``piece``;
    ``whole`` rows are all of theirs.  Offsets count code points of the row's
    own ``formatted``.
    """
    sent = rows.sparkSession.sparkContext.broadcast(file_bytes(model_path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        t, part = tokenizer(sent.value), TaskContext.get().partitionId()
        out, weight = [], 0

        def flush() -> pa.RecordBatch:
            kinds = [pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.string(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.bool_())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                              [f.split()[0] for f in PIECE.split(", ")])

        for i, (conv, turns, whole) in enumerate(pieces(batches, piece_chars)):
            f = format_conversation(turns, t, loss_role)
            at = np.array(f.offsets, np.int32).reshape(-1, 2)
            out.append((part, i, whole, conv, f.formatted, f.ids, at[:, 0], at[:, 1], f.mask))
            weight += len(f.formatted)
            if weight > 1 << 21:
                yield flush()
                out, weight = [], 0
        if out:
            yield flush()

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # ranges by the short columns only: their bounds come from a sample on the driver
    turns = (rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), text.alias("text"))
             .repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text"))
    return save(turns.mapInArrow(work, PIECE), "chats")


def pieces(batches: Iterator[pa.RecordBatch], piece_chars: int) -> Iterator[tuple[int | None, list[tuple[str, str]], bool]]:
    """(conv_id, consecutive turns of it, whether they are all of its turns), from batches sorted by it.

    The first and the last conversation of a partition may go on in another
    one, so they are never called whole.
    """
    conv, turns, size, cut, first = None, [], 0, False, True
    for b in batches:
        for c, role, text in zip(*(b.column(x) for x in ("conv_id", "role", "text"))):
            c, role, text = c.as_py(), role.as_py(), text.as_py()
            if turns and c != conv:
                yield conv, turns, not (cut or first)
                turns, size, cut, first = [], 0, False, False
            elif turns and size + len(text) > piece_chars:
                yield conv, turns, False
                turns, size, cut = [], 0, True
            conv = c
            turns.append((role, text))
            size += len(role) + len(text)
    if turns:
        yield conv, turns, False


def _digests(state: dict, s: str, starts, ends, mask) -> None:
    """Add one piece to the running digests of its conversation."""
    mask = np.array(mask.as_py(), bool)
    loss = masked_text(s, list(zip(starts.as_py(), ends.as_py())), mask)
    for role, text in parse(s):
        state["told"].update(f"{role}\n{text}\n".encode())
        state["turns"] += 1
    state["loss"].update(loss.encode())
    state["n"] += np.array([len(loss), len(s), len(mask), int(mask.sum())])


def read_back(chats: DataFrame) -> DataFrame:
    """Digest columns derived from ``format_chats``' own output, by parsing it.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    n_tokens, n_loss_tokens.  Whole conversations are read where they are; the
    pieces of the others go to one task in order, which holds one at a time.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, out = None, []

        def end() -> None:
            n = state["n"].tolist()
            out.append((state["conv"], state["turns"], state["told"].hexdigest(), n[0], state["loss"].hexdigest(), *n[1:]))

        for b in batches:
            for whole, conv, s, starts, ends, mask in zip(*(b.column(c) for c in ("whole", "conv_id", "formatted", "starts", "ends", "loss_mask"))):
                conv = conv.as_py()
                if state is None or whole.as_py() or state["whole"] or conv != state["conv"]:
                    if state is not None:
                        end()
                    state = {"conv": conv, "whole": whole.as_py(), "turns": 0, "told": hashlib.sha256(), "loss": hashlib.sha256(),
                             "n": np.zeros(4, np.int64)}
                _digests(state, s.as_py(), starts, ends, mask)
            if out:
                yield table(out)
                out = []
        if state is not None:
            end()
            yield table(out)

    def table(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n.endswith("256") else pa.int64()) for c, n in zip(zip(*out), names)], names)

    kinds = ", ".join(f"{n} {'string' if n.endswith('256') else 'long'}" for n in names)
    cut = chats.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    return chats.where("whole").mapInArrow(work, kinds).unionByName(cut.mapInArrow(work, kinds))
