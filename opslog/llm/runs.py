"""Periodic runs in the word sequence of a document, by constant-time extensions on suffix trees.

Ukkonen's algorithm builds the suffix tree of the words and of their reversal.
An Euler tour of a tree with a sparse table of minima answers "how far do the
words from i and from j agree" in constant time, as the string depth of the
lowest common ancestor of two leaves. Every run has a Lyndon root that is the
longest Lyndon word at its place, in the order of the words or in the reversed
order; those are found from the order of the suffixes (a leaf order of the tree)
by next-smaller-value, so there are two candidates a position. Each candidate
(i, j), of period j - i, is extended to the right on the tree of the words and to
the left on the tree of the reversal.

Trees are built for the stretches that can hold a run only. A run of at least
``max(MIN_WORDS, 3 * period)`` words, ``MIN_WORDS`` being 24, repeats each of its
eight-word sequences within itself, so every run lies in a stretch of positions
whose eight words occur again in the document; all other positions are in no run.
The sequences are compared by a 64-bit sum, which can only widen a stretch.
Memory is linear in the longest stretch, about 0.6 KB a word.

Words are ``[^\\x20\\x09-\\x0D]+``. ``refrain`` prepares the query's texts: for a tenth
of the ids, the words from a place on repeat with a period, both given by the id.

Defined cases: a null text has no words; no run gives four nulls, the hash of no
text and the hash of all words; a null id is no tenth id and leaves its words as
they are; repeated rows and ids come out as they came in; ties of the exponent
go to the smaller start, then the smaller period.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 24
POWER = 3
# Words of the sequences that bound the stretches: at most (MIN_WORDS + 5) // 3, see ``stretches``.
GRAM = 8

Run = tuple[int, int, int]  # start, length, period


def suffix_tree(s: list[int], symbols: int) -> tuple[list[int], list[int], dict[int, int]]:
    """Ukkonen's suffix tree of ``s``, whose last symbol, 0, occurs nowhere else.

    Returns the first position and the end of every node's edge label, and the
    children: node * symbols + first symbol -> child.
    """
    n = len(s)
    start, stop, link, to = [0], [0], [0], {}
    node = edge = length = rest = 0
    for i, c in enumerate(s):
        rest += 1
        fresh = 0  # an inner node of this phase that still needs its suffix link
        while rest:
            if not length:
                edge = i
            key = node * symbols + s[edge]
            child = to.get(key)
            if child is None:
                to[key] = len(start)
                start.append(i), stop.append(n), link.append(0)
                if fresh:
                    link[fresh], fresh = node, 0
            else:
                span = stop[child] - start[child]
                if length >= span:
                    node, edge, length = child, edge + span, length - span
                    continue
                at = start[child]
                if s[at + length] == c:
                    length += 1
                    if fresh:
                        link[fresh] = node
                    break
                inner = len(start)
                to[key] = inner
                start += [at, i]
                stop += [at + length, n]
                link += [0, 0]
                start[child] = at + length
                to[inner * symbols + c] = inner + 1
                to[inner * symbols + s[at + length]] = child
                if fresh:
                    link[fresh] = inner
                fresh = inner
            rest -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - rest + 1
    return start, stop, to


class Tree:
    """Suffix tree of ``words`` (numbers from 1) with common extensions and suffix orders."""

    def __init__(self, words: np.ndarray):
        s = [*words.tolist(), 0]
        self.n, self.symbols = len(s), int(words.max(initial=0)) + 1
        start, stop, to = suffix_tree(s, self.symbols)
        keys = np.fromiter(to, np.int64, len(to))
        order = np.argsort(keys)
        self.child = np.fromiter(to.values(), np.int64, len(to))[order].tolist()
        self.first_child = np.searchsorted(keys[order] // self.symbols, np.arange(len(start) + 1)).tolist()
        self.label = (np.array(stop) - np.array(start)).tolist()
        self.ends = np.isin(np.arange(len(start)), [v for k, v in to.items() if not k % self.symbols]).tolist()

    def suffixes(self, reverse: bool) -> list[int]:
        """Suffix starts in order: by the words' numbers, or by their reversed order; an end is smallest in both."""
        child, first, label, n = self.child, self.first_child, self.label, self.n
        out, stack, depth = [], [0], [0]
        while stack:
            x, d = stack.pop(), depth.pop()
            a, z = first[x], first[x + 1]
            if a == z:
                out.append(n - d)
                continue
            kids = child[a:z]
            if not reverse:
                kids.reverse()
            elif self.ends[kids[0]]:
                kids.append(kids.pop(0))
            stack += kids
            depth += [d + label[k] for k in kids]
        return out

    def euler(self) -> None:
        """The tour's string depths, each leaf's place in it, and minima over spans of powers of two."""
        child, first, label, n = self.child, self.first_child, self.label, self.n
        tour: list[int] = []
        place = np.zeros(n, np.int64)
        stack, depth = [0], [0]  # a node below zero marks the return to a parent
        while stack:
            x, d = stack.pop(), depth.pop()
            tour.append(d)
            if x < 0:
                continue
            a, z = first[x], first[x + 1]
            if a == z:
                place[n - d] = len(tour) - 1
                continue
            for k in child[a:z]:
                stack += (-1, k)
                depth += (d, d + label[k])
        self.place, rows = place, [np.array(tour, np.int32)]
        while 2 << (len(rows) - 1) <= len(tour):
            half = 1 << (len(rows) - 1)
            rows.append(np.minimum(rows[-1][:-half], rows[-1][half:]))
        self.rows, self.offset = np.concatenate(rows), np.cumsum([0, *map(len, rows[:-1])])

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i and from j on agree, for pairs of different places."""
        a, b = self.place[i], self.place[j]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        k = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        at = self.offset[k]
        return np.minimum(self.rows[at + lo], self.rows[at + hi + 1 - (1 << k)]).astype(np.int64)


def lyndon_ends(order: list[int]) -> np.ndarray:
    """End of the longest Lyndon word at each place: the next place with a smaller suffix."""
    n = len(order) - 1  # the end mark's own suffix is the first of the order
    rank = [0] * (n + 1)
    for k, i in enumerate(order):
        rank[i] = k
    out, stack = np.full(n, n, np.int64), [n]
    for i in range(n - 1, -1, -1):
        r = rank[i]
        while rank[stack[-1]] > r:
            stack.pop()
        out[i] = stack[-1]
        stack.append(i)
    return out


def runs_within(words: np.ndarray, least: int = MIN_WORDS, power: int = POWER) -> set[Run]:
    """Runs of ``words`` (numbers from 1) of at least ``max(least, power * period)`` words; ``power`` is 2 or more."""
    n = len(words)
    tree = Tree(words)
    i = np.tile(np.arange(n), 2)
    j = np.concatenate([lyndon_ends(tree.suffixes(reverse)) for reverse in (False, True)])
    near = (j - i) * power <= n
    i, j = i[near], j[near]
    tree.euler()
    right = tree.extension(i, j)
    tree = Tree(words[::-1])
    tree.euler()
    left = tree.extension(n - i, n - j)
    period = j - i
    length = left + period + right
    found = length >= np.maximum(least, power * period)
    return set(zip((i - left)[found].tolist(), length[found].tolist(), period[found].tolist()))


def stretches(codes: np.ndarray, least: int = MIN_WORDS) -> list[tuple[int, int]]:
    """[from, to) stretches outside of which no word is in a run of ``least`` words and three periods.

    Let a run have period q. One of its k-word sequences occurs again q words on or before,
    within the run, if the run has 2q + k - 1 words: true of 3q words where q >= k - 1, and of
    ``least`` words where q < k - 1 and least >= 3k - 5.
    """
    k = min(GRAM, (least + 5) // 3)
    if len(codes) < least:
        return []
    rng = np.random.default_rng(13)
    h = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    total = np.zeros(len(h) - k + 1, np.uint64)
    for at in range(k):
        total += h[at:at + len(total)] * np.uint64(int(rng.integers(1, 1 << 62)) * 2 + 1)
    _, which, count = np.unique(total, return_inverse=True, return_counts=True)
    again = np.concatenate(([0], (count[which] > 1).astype(np.int8), [0]))
    turns = np.flatnonzero(np.diff(again))
    return [(a, z + k - 1) for a, z in zip(turns[::2].tolist(), turns[1::2].tolist()) if z + k - 1 - a >= least]


def runs_of(words: list[bytes], least: int = MIN_WORDS) -> list[Run]:
    """All runs of a word list, by start, then period."""
    number: dict[bytes, int] = {}
    codes = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    out: list[Run] = []
    for a, z in stretches(codes, least):
        own = np.unique(codes[a:z], return_inverse=True)[1] + 1
        out += [(a + s, n, p) for s, n, p in runs_within(own, least)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def refrain(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a planted refrain where crc32 of the id is a multiple of ten."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words but those that a run holds after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


RESULT = [("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
          ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: bool = False,
                  least: int = MIN_WORDS) -> DataFrame:
    """Per row: its number of runs, the run of the greatest exponent, and digests of the runs and of the
    text with its runs collapsed. ``planted`` gives a tenth of the documents a refrain first."""
    def row(doc: int | None, text: str | None) -> tuple:
        words = text.encode().split() if text else []  # bytes are cut at exactly the six ASCII blanks
        if planted:
            words = refrain(words, doc)
        runs = runs_of(words, least)
        top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        milli = 1000 * top[1] // top[2] if runs else None
        return (doc, len(runs), *top, milli, sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest(),
                sha256(b" ".join(collapsed(words, runs))).hexdigest())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [row(d, t.as_py()) for d, t in zip(b.column(0).to_pylist(), b.column(1))]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(RESULT)],
                                             [n for n, _ in RESULT])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return src.mapInArrow(run, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
                               "runs_sha256 string, collapsed_sha256 string")


def collapse(docs: DataFrame, text_col: str = "text", least: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` with the runs of their texts collapsed to one period; texts without a run
    stay as they are, others have their kept words joined by one space."""
    at = docs.columns.index(text_col)

    def text_of(text: str | None) -> str | None:
        words = (text or "").encode().split()
        runs = runs_of(words, least)
        return b" ".join(collapsed(words, runs)).decode() if runs else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.set_column(at, b.schema.field(at), pa.array([text_of(t.as_py()) for t in b.column(at)], b.column(at).type))

    return docs.mapInArrow(run, docs.schema)
