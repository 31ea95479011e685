"""SentencePiece encoding and decoding by a batched numpy Viterbi.

Pieces never hold the space mark after another character, so a text splits
into words (space marks, then other characters) that can be segmented apart.
The different words of a slice of texts lie one after the other in one array
and advance together, whatever their lengths: from every character the trie of
the pieces is followed until no piece goes on, and what was found is taken up by
the place of its end in its word, as many steps as the longest word has
characters.

A long word (text without spaces) is cut first, where no piece crosses: its
parts can be segmented apart as well, and join the other words.  A part that
stays long walks alone, with the pieces found for a window of its characters at
once.

Two kinds of model differ in what is maximised.  ``unigram``: the sum of the
pieces' scores (ties: the longest last piece).  ``bpe``: the result of merging
pairs in the order of their scores.  It is the only segmentation in which every
piece is what merging makes of it and no neighbours would have merged across
their border, so a step is allowed only after a piece that it is compatible
with, and exactly one survives at each place.  Characters without a piece come out
as byte pieces.

Defined results: null texts encode to null, empty ones to no ids; repeated
rows are encoded alike; a word may have any length; the space mark itself decodes to a space; an empty table gives an empty
result.
"""

from __future__ import annotations

import pickle
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from quarry.llm.common import file_bytes

SPACE = "▁"
#: Odd multiplier, for the places of keys.
MIX = np.uint64(0xD6E8FEB86659FD93)
#: A place without a key.
FREE = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Words of more characters are cut, into parts of about half of that where that is possible.
LONG = 64
#: Characters of a long word that are probed at once.
WINDOW = 1 << 16
#: Characters of words that advance together, which bounds the arrays of a step.
STEP = 1 << 17
#: log2 of the borders that are remembered.
BORDER_BITS = 18


@dataclass
class Trie:
    """The prefixes of all pieces, numbered from 1; 0 is the empty one."""
    key: np.ndarray  # by place: a prefix and its next character
    child: np.ndarray  # by place: the longer prefix
    spelled: np.ndarray  # of each prefix: the id of the piece that it is, or -1
    inner: np.ndarray  # of each prefix: whether longer ones exist

    def follow(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The prefixes longer by a character, or -1."""
        key = (node.astype(np.uint64) << np.uint64(21)) | code
        at = place(key, len(self.key))
        held = self.key[at]
        out = np.where(held == key, self.child[at], np.int32(-1))
        rest = np.flatnonzero((held != key) & (held != FREE))
        key, at = key[rest], at[rest]
        while len(rest):
            at = (at + 1) % len(self.key)
            held = self.key[at]
            hit = held == key
            out[rest[hit]] = self.child[at[hit]]
            go = ~hit & (held != FREE)
            rest, key, at = rest[go], key[go], at[go]
        return out


@dataclass
class Pieces:
    trie: Trie
    longest: int  # characters of the longest piece
    score: np.ndarray  # of each id
    text: list[str | bytes]  # of each id: its string, or its byte
    raw: list[bytes]  # of each id: what it decodes to
    byte_ids: list[int]
    unknown: float
    merges: Merges | None  # of a bpe model


@dataclass
class Merges:
    """Ranks (the earlier a merge, the lower; single characters first) and merges of a bpe model."""
    rank: np.ndarray  # of each id
    left: np.ndarray  # of each rank: ranks of what its last merge joined, or itself
    right: np.ndarray
    pairs: np.ndarray  # sorted keys (left rank * n + right rank) of all pairs that make a piece
    made: np.ndarray  # the rank of that piece
    seen: np.ndarray | None = None  # by place: the last border asked for (key of its ranks), and whether it stays

    def joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the piece that two pieces make, or a very large one."""
        key = a * len(self.left) + b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.made[at], 1 << 40) if len(self.pairs) else np.full(len(a), 1 << 40)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces a, b (ranks) stay apart when their characters are merged together.

        Undoes the merges inside a and b, latest first.  Whatever then stands
        left and right of the border must not make a piece before the merge
        that was undone last.
        """
        n = len(a)
        ok, limit = np.ones(n, bool), np.full(n, 1 << 30)
        at, a, b = np.arange(n), a.copy(), b.copy()
        while len(at):
            clash = self.joined(a, b) < limit
            ok[at[clash]] = False
            leaf_a, leaf_b = self.right[a] == a, self.left[b] == b
            go = ~clash & ~(leaf_a & leaf_b)
            at, a, b, limit, leaf_a, leaf_b = (x[go] for x in (at, a, b, limit, leaf_a, leaf_b))
            undo_a = ~leaf_a & (leaf_b | (a > b))
            limit = np.where(undo_a, a, b + 1)  # of equal merges the left one goes first
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return ok

    def apart(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """``compatible`` of ids; remembers the last border of each place."""
        if self.seen is None:
            self.seen = np.full(1 << BORDER_BITS, -1)
        n = len(self.left)
        key = self.rank[first] * n + self.rank[second]
        at = place(key.astype(np.uint64), len(self.seen))
        held = self.seen[at]
        new = np.flatnonzero(held >> 1 != key)
        if len(new):
            pair, back = np.unique(key[new], return_inverse=True)
            held[new] = (2 * pair + self.compatible(pair // n, pair % n))[back]
            self.seen[at[new]] = held[new]
        return held & 1 == 1


def merges(text: list[str | bytes], normal: list[int], score: list[float]) -> tuple[Merges, list[int]]:
    """Merges of a bpe model, and the ids that merging can reach."""
    order = sorted(normal, key=lambda i: (len(text[i]) > 1, -score[i] if len(text[i]) > 1 else 0, i))
    rank_of = {text[i]: r for r, i in enumerate(order)}
    n = len(order)
    left, right, reached = np.arange(n), np.arange(n), []
    keys, made = [], []
    for r, i in enumerate(order):
        t = text[i]
        parts = list(t)
        last = None
        while len(parts) > 1:
            best = min(((rank_of.get(parts[k] + parts[k + 1], n), k) for k in range(len(parts) - 1)))
            if best[0] == n:
                break
            k = best[1]
            last = rank_of[parts[k]], rank_of[parts[k + 1]]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        if len(parts) == 1:
            reached.append(i)
            if last:
                left[r], right[r] = last
        for k in range(1, len(t)):
            x, y = rank_of.get(t[:k]), rank_of.get(t[k:])
            if x is not None and y is not None:
                keys.append(x * n + y)
                made.append(r)
    by = np.argsort(np.array(keys, np.int64), kind="stable")
    rank = np.zeros(len(text), np.int64)
    rank[order] = np.arange(n)
    return Merges(rank, left, right, np.array(keys, np.int64)[by], np.array(made, np.int64)[by]), reached


def codes(words: list[str]) -> np.ndarray:
    """Code points of words, one after the other."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4")


def place(key: np.ndarray, places: int) -> np.ndarray:
    """Where a key stands, or is looked for first, among places (a power of two)."""
    return ((key * MIX) >> np.uint64(65 - places.bit_length())).astype(np.int64)


def trie(text: list[str | bytes], ids: list[int]) -> Trie:
    """The trie of the pieces with these ids."""
    nodes: dict[int, int] = {}
    ends = []
    for i in ids:
        at = 0
        for ch in text[i]:
            at = nodes.setdefault(at << 21 | ord(ch), len(nodes) + 1)
        ends.append(at)
    spelled, inner = np.full(len(nodes) + 1, -1, np.int32), np.zeros(len(nodes) + 1, bool)
    spelled[ends] = ids
    key, child = np.array(list(nodes), np.uint64), np.array(list(nodes.values()), np.int32)
    inner[(key >> np.uint64(21)).astype(np.int64)] = True
    places = 1 << (4 * len(nodes) + 4).bit_length()
    out = Trie(np.full(places, FREE), np.full(places, -1, np.int32), spelled, inner)
    at = place(key, places)
    while len(key):  # each to its place, or to the next free one after it
        free = np.flatnonzero(out.key[at] == FREE)
        out.key[at[free]], out.child[at[free]] = key[free], child[free]
        rest = out.key[at] != key
        key, child, at = key[rest], child[rest], (at[rest] + 1) % places
    return out


def pieces(model: bytes, kind: str = "bpe") -> Pieces:
    """The normal pieces of a SentencePiece model."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    n = sp.get_piece_size()
    text: list[str | bytes] = [sp.id_to_piece(i) for i in range(n)]
    score = [sp.get_score(i) for i in range(n)]
    byte_ids, normal = [0] * 256, []
    for i in range(n):
        if sp.is_byte(i):
            v = int(text[i][3:5], 16)
            byte_ids[v], text[i] = i, bytes([v])
        elif sp.is_control(i) or sp.is_unknown(i):
            text[i] = ""
        else:
            normal.append(i)
    table = None
    if kind == "bpe":
        table, normal = merges(text, normal, score)
    raw = [t if isinstance(t, bytes) else t.encode() for t in text]
    return Pieces(trie(text, normal), max((len(text[i]) for i in normal), default=0), np.array(score), text, raw, byte_ids,
                  min((score[i] for i in normal), default=0.0) - 10.0, table)


def probe(c: np.ndarray, p: Pieces, room: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, places, ids) of the pieces that start at the places of a run of code points, shortest first.

    ``room``: how many characters a piece may have at each place (else: up to the end of the run).
    """
    room = np.arange(len(c), 0, -1) if room is None else room
    at, node = np.arange(len(c)), np.zeros(len(c), np.int32)
    for size in range(1, max(p.longest, 1) + 1):
        node = p.trie.follow(node, c[at + (size - 1)])
        on = np.flatnonzero(node >= 0)
        at, node = at[on], node[on]
        ids = p.trie.spelled[node]
        piece = np.flatnonzero(ids >= 0)
        yield size, at[piece], ids[piece]
        on = np.flatnonzero(p.trie.inner[node] & (room[at] > size))
        at, node = at[on], node[on]
        if not len(at):
            break


def segment(c: np.ndarray, length: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words, all advanced together, and how many each gets; the words: code points, and how many each has."""
    n, word = len(length), np.repeat(np.arange(len(length)), length)
    start = np.cumsum(length) - length
    hits = list(probe(c, p, (start + length)[word] - np.arange(len(c))))
    # a character alone, where no piece is: in a unigram model always possible, at a price
    lone = np.ones(len(c), bool)
    if p.merges:
        lone[hits[0][1]] = False
    lone = np.flatnonzero(lone)
    hits.insert(0, (1, lone, np.full(len(lone), -1, np.int32)))
    row, ids = (np.concatenate([h[k] for h in hits]) for k in (1, 2))
    size = np.repeat(np.array([h[0] for h in hits], np.int32), [len(h[1]) for h in hits])
    del hits
    # by the place of the end in the word, then by size; a word has a border more than characters
    upto = row + size - start[word[row]]
    ends = np.concatenate(([0], np.cumsum(np.bincount(upto, minlength=2)[1:]))).tolist()
    order = np.argsort(upto.astype(np.min_scalar_type(len(ends))), kind="stable")
    low, ids, size = (row + word[row])[order], ids[order], size[order]
    del row, upto, order
    first = start + np.arange(n)
    # at each border: the id of the last piece (-1: none) and its length
    which, back = np.full(len(c) + n, -2, np.int32), np.ones(len(c) + n, np.int32)
    which[first] = -1
    best = np.zeros(0 if p.merges else len(c) + n)
    for a, b in zip(ends, ends[1:]):
        at, i, step = low[a:b], ids[a:b], size[a:b]
        before = which[at]
        ok = before > -2
        if p.merges:
            pair = np.flatnonzero((before >= 0) & (i >= 0))
            ok[pair] = p.merges.apart(before[pair], i[pair])
        ok = np.flatnonzero(ok)
        at, i, step = at[ok], i[ok], step[ok]
        to = at + step
        if not p.merges:  # the best comes last and stays; of equal ones the longest
            x = best[at] + np.where(i < 0, p.unknown, p.score[i])
            order = np.argsort(x, kind="stable")
            to, i, step = to[order], i[order], step[order]
            best[to] = x[order]
        which[to], back[to] = i, step
    # walk all words back together
    path, at = np.zeros(len(c) + n, bool), first + length
    while len(at):
        path[at] = True
        at = at - back[at]
        go = at > first
        at, first = at[go], first[go]
    there = np.flatnonzero(path)
    out, of = which[there], np.repeat(np.arange(n), length + 1)[there]
    if (out < -1).any():
        raise ValueError("a word without a segmentation")
    lacking = np.flatnonzero(out < 0)
    if len(lacking):  # unknown characters, as byte pieces
        odd = c[there[lacking] - of[lacking] - 1]
        times = np.ones(len(out), np.int64)
        times[lacking] += sum((odd >= least).astype(np.int64) for least in (0x80, 0x800, 0x10000))
        out, of = np.repeat(out, times), np.repeat(of, times)
        out[out < 0] = np.array(p.byte_ids)[np.frombuffer(odd.tobytes().decode("utf-32-le").encode(), np.uint8)]
    return out, np.bincount(of, minlength=n)


def segment_all(c: np.ndarray, length: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """``segment`` of any number of words, about ``STEP`` characters at a time."""
    ends, out, a = np.cumsum(length), [(np.zeros(0, np.int32), np.zeros(0, np.int64))], 0
    while a < len(length):
        done = ends[a] - length[a]
        b = max(int(np.searchsorted(ends, done + STEP, side="right")), a + 1)
        out.append(segment(c[done:ends[b - 1]], length[a:b], p))
        a = b
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


def viterbi(words: list[str], p: Pieces) -> list[bytes]:
    """Ids (little-endian 32 bit) of words, all advanced together."""
    ids, size = segment_all(codes(words), np.array([len(w) for w in words], np.int64), p)
    blob, ends = ids.astype("<i4").tobytes(), 4 * np.cumsum(size)
    return [blob[a:b] for a, b in zip((ends - 4 * size).tolist(), ends.tolist())]


def cut(word: str, p: Pieces) -> list[str]:
    """A long word in parts that no piece joins, as long as they can be up to half of ``LONG``."""
    c, over = codes([word]), max(p.longest, 1) - 1
    crossed = np.zeros(len(c) + 1, bool)
    for s in range(0, len(c), WINDOW):
        part = c[s:s + WINDOW + over]
        change = np.zeros(len(part) + 1, np.int32)
        for size, row, _ in probe(part, p):
            change[row + 1] += 1  # the borders row + 1 .. row + size - 1
            change[row + size] -= 1
        crossed[s:s + len(change)] |= np.cumsum(change) > 0
    free = np.flatnonzero(~crossed)  # holds both ends
    out, k = [], 0
    while k + 1 < len(free):
        last = max(int(np.searchsorted(free, free[k] + LONG // 2, side="right")) - 1, k + 1)
        out.append(word[free[k]:free[last]])
        k = last
    return out


class Alone:
    """The best segmentation of one long word, a character at a time; remembers which pieces stay apart."""

    def __init__(self, p: Pieces, most: int = 1 << 18):
        self.p, self.most, self.memo = p, most, {}
        if p.merges:
            self.rank, self.left, self.right = p.merges.rank.tolist(), p.merges.left.tolist(), p.merges.right.tolist()
            self.made = dict(zip(p.merges.pairs.tolist(), p.merges.made.tolist()))

    def apart(self, first: int, second: int) -> bool:
        """``Merges.compatible`` of two ids."""
        known = self.memo.get((first, second))
        if known is not None:
            return known
        a, b, limit, n = self.rank[first], self.rank[second], 1 << 30, len(self.left)
        while True:
            ok = self.made.get(a * n + b, 1 << 40) >= limit
            leaf_a, leaf_b = self.right[a] == a, self.left[b] == b
            if not ok or (leaf_a and leaf_b):
                break
            if not leaf_a and (leaf_b or a > b):
                limit, a = a, self.right[a]
            else:
                limit, b = b + 1, self.left[b]
        if len(self.memo) >= self.most:
            self.memo.clear()
        self.memo[first, second] = ok
        return ok

    def __call__(self, word: str) -> bytes:
        p, c, none = self.p, codes([word]), float("-inf")
        over = max(p.longest, 1) - 1
        best, which = array("d", [0.0]) * (len(c) + 1), array("i", [-1]) * (len(c) + 1)
        for s in range(0, len(c), WINDOW):
            low, end = max(0, s - over), min(len(c), s + WINDOW)
            hits = [(row + low + size, np.full(len(row), size), ids,
                     np.zeros(len(row)) if p.merges else p.score[ids])
                    for size, row, ids in probe(c[low:end], p)]
            upto, size, ids, score = (np.concatenate(x) for x in zip(*hits))
            order = np.argsort(upto, kind="stable")  # by end, then by size
            order = order[upto[order] > s]
            first = np.searchsorted(upto[order], np.arange(s + 1, end + 2)).tolist()
            size, ids, score = size[order].tolist(), ids[order].tolist(), score[order].tolist()
            for j in range(s + 1, end + 1):
                a, b = first[j - s - 1], first[j - s]
                lone = not p.merges or a == b or size[a] > 1
                top, last = best[j - 1] + p.unknown if lone else none, -1
                for k in range(a, b):
                    at = j - size[k]
                    x = best[at] + score[k]
                    if x >= top and x > none and (not p.merges or which[at] < 0 or self.apart(which[at], ids[k])):
                        top, last = x, ids[k]
                best[j], which[j] = top, last
        out, j = array("i"), len(c)
        while j:
            i = which[j]
            j -= len(p.text[i]) if i >= 0 else 1
            if i >= 0:
                out.append(i)
            else:
                out.extend([p.byte_ids[x] for x in reversed(word[j].encode())])
        return np.array(out[::-1], "<i4").tobytes()


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, with spaces for space marks, and how many there are before and after each text.

    A text that is not empty has a space put before it; a word starts at each
    space that follows no space.
    """
    texts = pc.replace_substring(pc.fill_null(texts.cast(pa.string()), ""), SPACE, " ")
    texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    text = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[:ends[-1]]
    begin = text == 32
    begin[1:] &= text[:-1] != 32
    begin[ends[:-1][ends[1:] > ends[:-1]]] = True
    begin[:ends[0]] = False
    start = np.flatnonzero(begin).astype(np.int32)
    words = pa.StringArray.from_buffers(len(start), pa.py_buffer(np.append(start, ends[-1])), pa.py_buffer(text))
    return words, np.searchsorted(start, ends)


def gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``size`` values from each ``start`` on, one after the other, and how many there are before and after each."""
    upto = np.concatenate(([0], np.cumsum(size)))
    return values[np.arange(upto[-1]) + np.repeat(start - upto[:-1], size)], upto


class Encoder:
    """Encodes batches; remembers the ids of words (at most ``most``, and those of the last slice)."""

    def __init__(self, p: Pieces, most: int = 200_000):
        self.p, self.most, self.alone = p, most, None
        self.words = pa.array([], pa.string())
        self.ids, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64)  # of all of them; how many each has

    def long(self, words: list[str]) -> list[np.ndarray]:
        """The ids of long words by their parts; what could not be cut walks alone."""
        parts = [cut(w, self.p) for w in words]
        distinct = list(dict.fromkeys(chain.from_iterable(parts)))
        short = [w for w in distinct if len(w) <= LONG]
        done = dict(zip(short, viterbi(short, self.p)))
        for w in distinct:
            if w not in done:
                self.alone = self.alone or Alone(self.p)
                done[w] = self.alone(w)
        return [np.frombuffer(b"".join([done[x] for x in xs]), "<i4") for xs in parts]

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many there are before and after each."""
        words, ends = words_of(texts)
        coded = words.dictionary_encode()
        words, place_of = coded.dictionary, coded.indices.to_numpy()
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy()
        length = pc.utf8_length(words).to_numpy().astype(np.int64)
        # new words after the known ones, then long ones, which are not remembered
        new, far = np.flatnonzero((at < 0) & (length <= LONG)), np.flatnonzero(length > LONG)
        c = codes(words.take(pa.array(new)).to_pylist())
        ids, size = segment_all(np.where(c == 32, np.uint32(ord(SPACE)), c), length[new], self.p)
        beyond = self.long([w.replace(" ", SPACE) for w in words.take(pa.array(far)).to_pylist()])
        held = np.concatenate((self.ids, ids, *beyond))
        sizes = np.concatenate((self.size, size, np.array([len(x) for x in beyond], np.int64)))
        starts = np.cumsum(sizes) - sizes
        at = at.copy()
        at[new], at[far] = len(self.size) + np.arange(len(new)), len(self.size) + len(new) + np.arange(len(far))
        if len(self.words) + len(new) <= self.most:
            self.words = pa.concat_arrays([self.words, words.take(pa.array(new))])
            self.size = sizes[:len(self.words)]
            self.ids = held[:self.size.sum()].copy()
        else:
            keep = np.flatnonzero(length <= LONG)
            self.words, self.size = words.take(pa.array(keep)), sizes[at[keep]]
            self.ids = gather(held, starts[at[keep]], self.size)[0]
        at = at[place_of]
        out, upto = gather(held, starts[at], sizes[at])
        return out, upto[ends]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        ids, upto = self.flat(pa.array(texts, pa.string()))
        return np.split(ids, upto[1:-1]) if texts else []


def decode(ids: pa.Array, raw: pa.Array) -> list[str | None]:
    """The texts of lists of ids: pieces joined, byte pieces as UTF-8, marks as spaces, without the first; null for null."""
    ends = ids.offsets.to_numpy()
    joined = raw.take(ids.values.slice(ends[0], ends[-1] - ends[0]))
    upto = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset + ends - ends[0]].tolist()
    blob = memoryview(joined.buffers()[2] or b"")
    return [None if null else str(blob[a:b], "utf-8", "replace").replace(SPACE, " ")[1:]
            for null, a, b in zip(ids.is_null().to_pylist(), upto, upto[1:])]


def slices(batch: pa.RecordBatch, column: str, rows: int = 1024, chars: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most ``rows`` rows and, but for a single row, about ``chars`` bytes of text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(size, (size[at - 1] if at else 0) + chars, side="right"))
        end = min(max(end, at + 1), at + rows)
        yield batch.slice(at, end - at)
        at = end


def encode(docs: DataFrame, model_path: str, column: str = "text", out: str = "ids", kind: str = "bpe") -> DataFrame:
    """``docs`` with ``out``, the ids of ``column`` (null for a null text); ``kind`` is the model's type."""
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(vars(pieces(file_bytes(model_path), kind))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = Encoder(Pieces(**pickle.loads(sent.value)))
        for b in batches:
            for part in slices(b, column, chars=1 << 21):
                texts = part.column(column)
                ids, upto = run.flat(texts)
                col = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(ids, pa.int32()), mask=texts.is_null())
                yield pa.RecordBatch.from_arrays([*part.columns, col], [*part.schema.names, out])

    return docs.mapInArrow(work, _schema(docs, f"`{out}` array<int>"))


def decode_column(rows: DataFrame, model_path: str, column: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with ``out``, the text of the ids in ``column`` (null for null)."""
    # merges play no part in decoding
    sent = rows.sparkSession.sparkContext.broadcast(pieces(file_bytes(model_path), "unigram").raw)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = pa.array(sent.value, pa.large_binary())
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                texts = decode(part.column(column), raw)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, out])

    return rows.mapInArrow(work, _schema(rows, f"`{out}` string"))


def _schema(df: DataFrame, more: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [more])
