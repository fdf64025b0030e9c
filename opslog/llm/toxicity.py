"""Toxicity scores from averaged subword embeddings and a linear softmax.

A word is the bag of its character 3- to 5-grams between ``<`` and ``>`` and of
itself whole, each hashed to a row of one embedding table; its vector is their
mean, so a misspelling that was never seen shares most of its vectors with the
word it stands for. The vectors of the distinct words in a window of ``WINDOW``
words are averaged (places of a repeated or missing word count as zero) and go
through a linear softmax with two classes. A text is as toxic as its most
toxic window, so that a passage does not vanish in a long text; whole texts are
scored, in windows side by side, the last one reaching back to full width.

Embeddings and softmax are trained jointly in numpy (Adagrad): in every epoch
each training text stands by the window that scores highest under the model so
far, in the first epochs by all its windows as one bag.

The fit uses at most ``TRAIN_ROWS`` labelled rows chosen by a hash of the id, half
of each class as far as there are any, each class weighted by the square root of
its size, and at most ``TRAIN_WINDOWS`` windows of each, evenly spread over the text
(documented bounds). At scoring the softmax is linear in the vectors, so each
distinct word is reduced to one number, kept in a bounded table per task.

Defined cases: null texts count as empty and score the model's bias; labels other
than 0 and 1 are ignored; with labels of one class or none the score is near that
class or 0.5; null ids train nothing; repeated rows come out
as they came in.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_ROWS = 4000
TRAIN_WINDOWS = 64
WINDOW = 12
BUCKETS = 1 << 16
DIM = 8
GRAMS = (3, 4, 5)
EPOCHS = 28
# Epochs in which a text is one bag, before its highest window stands for it.
WHOLE = 1
# Table rows of fewer training texts than this stay zero: they cannot tell a rule from a wrong label.
MIN_TEXTS = 4
# Share of a word's rows left out at random in a training step, so that no single one carries the word.
DROPPED = 0.5
BATCH = 256
RATE = 0.3
DECAY = 3e-4
SEED = 11
WORDS_KEPT = 300_000
# Words of whole texts looked up together.
GATHERED = 200_000
THRESHOLD = 0.3


def held_out(id_col: str) -> Column:
    """True where crc32 of the id as text leaves remainder 2 modulo 4 (null ids: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _hashed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(40)).astype(np.int64) % BUCKETS


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of lower-case words, one word after the other, and how many each has.

    A word is taken without punctuation at its ends. Its character n-grams and itself are hashed
    together for all words, as sums over their code points.
    """
    texts = [f"<{w.strip(punctuation) or w}>" for w in words]
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    c = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    word = np.repeat(np.arange(len(texts)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(c))  # characters from here to the word's end
    factor = np.uint64(0x100000001B3)
    whole, power = np.zeros(len(texts), np.uint64), np.ones(1, np.uint64)
    if len(c):
        power = np.cumprod(np.full(int(size.max()), factor))
        whole = np.add.reduceat(c * power[(np.repeat(size, size) - left)], np.cumsum(size) - size)
    rows, owner = [_hashed(whole + np.uint64(7))], [np.arange(len(texts))]
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = h * factor + c[at + k]
        rows.append(_hashed(h))
        owner.append(word[at])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(rows)[order], np.bincount(owner, minlength=len(texts))


def windows(words: list[str], most: int | None = None) -> list[set[str]]:
    """Distinct words of windows side by side, the last one reaching back so that it is full;
    with ``most``, at most so many, evenly spread."""
    n = len(words)
    starts = [*range(0, n - WINDOW, WINDOW), max(0, n - WINDOW)]
    if most and len(starts) > most:
        starts = [starts[k * (len(starts) - 1) // (most - 1)] for k in range(most)]
    return [set(words[a:a + WINDOW]) for a in starts]


@dataclass
class Scorer:
    """A fitted model at scoring: what each table row adds to the log-odds, and the bias."""

    adds: np.ndarray
    bias: float

    def learn(self, table: dict[str, float], lists: list[list[str]]) -> None:
        """Put the log-odds, without the bias, of all words of ``lists`` into ``table``."""
        fresh = list(set().union(*lists).difference(table))
        if len(table) + len(fresh) > WORDS_KEPT:
            table.clear()
            fresh = list(set().union(*lists))
        if fresh:
            rows, n = subwords(fresh)
            table.update(zip(fresh, (np.add.reduceat(self.adds[rows], np.cumsum(n) - n) / n).tolist()))

    def logit(self, words: list[str], table: dict[str, float]) -> float:
        return self.bias + max(sum(map(table.__getitem__, w)) for w in windows(words)) / WINDOW

    def logits(self, texts: Iterable[str | None], table: dict[str, float]) -> list[float]:
        out: list[float] = []
        held: list[list[str]] = []
        n = 0
        for text in texts:
            held.append((text or "").lower().split())
            n += len(held[-1])
            if n >= GATHERED:
                self.learn(table, held)
                out += [self.logit(w, table) for w in held]
                held, n = [], 0
        self.learn(table, held)
        return out + [self.logit(w, table) for w in held]


def spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions first[k] .. first[k] + sizes[k] - 1 of all k, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + sizes, sizes)


def fit(rows: list[tuple[int, float, list[str]]]) -> Scorer:
    """Train on (label, weight, windows) rows, each window a text of its words."""
    total = sum(r[1] for r in rows)
    share = (sum(r[1] for r in rows if r[0]) + 1) / (total + 2)
    number: dict[str, int] = {}
    bags = [np.array([number.setdefault(w, len(number)) for w in text.split()], np.int32) for r in rows for text in r[2]]
    if len({r[0] for r in rows}) < 2 or not number:
        return Scorer(np.zeros(BUCKETS), float(np.log(share / (1 - share))))
    sizes = np.array([len(b) for b in bags], np.int64)  # a text without words has one empty window
    words = np.concatenate(bags)
    del bags
    first = np.cumsum(sizes) - sizes
    of_doc = np.array([len(r[2]) for r in rows])
    doc_first = np.cumsum(of_doc) - of_doc
    in_doc = np.add.reduceat(sizes, doc_first)
    part, n_parts = subwords(list(number))
    part = part.astype(np.int32)
    part_first = np.cumsum(n_parts) - n_parts
    y = np.array([r[0] for r in rows])
    weight = np.array([r[1] for r in rows]) * len(rows) / total

    texts_of = np.zeros(BUCKETS, np.int64)
    for at, n in zip(first[doc_first].tolist(), in_doc.tolist()):
        own = np.unique(words[at:at + n])
        texts_of[np.unique(part[spread(part_first[own], n_parts[own])])] += 1
    known = texts_of >= MIN_TEXTS

    rng = np.random.default_rng(SEED)
    emb = rng.uniform(-1, 1, (BUCKETS, DIM)) / DIM * known[:, None]
    soft, bias = rng.normal(0, 0.1, (2, DIM)), np.log([1 - share, share])
    g_emb, g_soft, g_bias = np.full((BUCKETS, DIM), 1e-3), np.full((2, DIM), 1e-3), np.full(2, 1e-3)
    for epoch in range(EPOCHS):
        if epoch < WHOLE:
            lo, span, width = first[doc_first], in_doc, WINDOW * of_doc  # all windows of a text
        else:
            adds = emb @ (soft[1] - soft[0])
            alone = np.add.reduceat(adds[part], part_first) / n_parts
            sums = np.concatenate(([0.0], np.cumsum(alone[words])))
            each = sums[first + sizes] - sums[first]
            best = np.lexsort((-each, np.repeat(np.arange(len(rows)), of_doc)))[doc_first]
            lo, span, width = first[best], sizes[best], np.full(len(rows), WINDOW)
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            used, where = np.unique(words[spread(lo[pick], span[pick])], return_inverse=True)
            doc = np.repeat(np.arange(len(pick)), span[pick])
            to_doc = 1 / width[pick][doc]
            size = n_parts[used]
            rows_of, word = part[spread(part_first[used], size)], np.repeat(np.arange(len(used)), size)
            kept = (rng.random(len(rows_of)) >= DROPPED) & known[rows_of]
            rows_of, word = rows_of[kept], word[kept]
            to_word = (1 / (size * (1 - DROPPED)))[word]
            vec = np.stack([np.bincount(word, to_word * emb[rows_of, k], len(used)) for k in range(DIM)], 1)
            mean = np.stack([np.bincount(doc, to_doc * vec[where, k], len(pick)) for k in range(DIM)], 1)
            z = mean @ soft.T + bias
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
            p[np.arange(len(pick)), y[pick]] -= 1
            p *= weight[pick, None]
            d_soft, d_bias, d_mean = p.T @ mean, p.sum(axis=0), p @ soft
            d_vec = np.stack([np.bincount(where, to_doc * d_mean[doc, k], len(used)) for k in range(DIM)], 1)
            row, back = np.unique(rows_of, return_inverse=True)
            d_emb = np.stack([np.bincount(back, to_word * d_vec[word, k], len(row)) for k in range(DIM)], 1) + DECAY * emb[row]
            for param, grad, hist, sel in ((emb, d_emb, g_emb, row), (soft, d_soft, g_soft, slice(None)), (bias, d_bias, g_bias, slice(None))):
                hist[sel] += grad * grad
                param[sel] -= RATE * grad / np.sqrt(hist[sel])
    return Scorer((emb @ (soft[1] - soft[0])).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> Scorer:
    """Fit on a bounded sample of the labelled rows outside the held-out quarter."""
    own = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
           .where(F.col("y").isin(0, 1) & F.col("id").isNotNull() & ~held_out("id")))
    counts = {r["y"]: r["n"] for r in own.groupBy("y").agg(F.count("*").alias("n")).collect()}
    span = 1 << 30
    keep = {y: min(span, span * (train_rows // 2) // n) for y, n in counts.items()}
    draw = F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(span))
    # the hash keeps train_rows labels on average; twice that is the bound of what is broadcast
    picked = F.broadcast(own.where(draw < F.when(F.col("y") == 1, keep.get(1, 0)).otherwise(keep.get(0, 0)))
                         .limit(2 * train_rows))

    def bags(text: str | None) -> list[str]:
        return [" ".join(sorted(w)) for w in windows((text or "").lower().split(), TRAIN_WINDOWS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([bags(t.as_py()) for t in b.column(1)], pa.list_(pa.string()))], ["y", "windows"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    sample = texts.join(picked, "id").select("y", "t").mapInArrow(run, "y int, windows array<string>").collect()
    sample = sorted((r["y"], r["windows"]) for r in sample)  # the same order in every run
    seen = Counter(y for y, _ in sample)
    return fit([(y, counts[y] ** 0.5 / seen[y], w) for y, w in sample])


def score(docs: DataFrame, model: Scorer, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[str, float] = {}
        for b in batches:
            z = np.array(shared.value.logits((t.as_py() for t in b.column(1)), table), np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], ["doc_id", "score"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return (src.mapInArrow(run, "doc_id long, score double")
            .select("doc_id", held_out("doc_id").alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
