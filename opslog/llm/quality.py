"""Quality scores by a factorisation machine.

Features of a whole text: its words hashed to buckets (counts, scaled to unit
length), and structure statistics and length metadata, each cut into bins.
The machine has a bias, a weight per feature and a low-rank vector per
feature; all pairwise interactions are summed in linear time by the identity
sum_{i<j} <v_i, v_j> x_i x_j = (|sum v_i x_i|^2 - sum |v_i x_i|^2) / 2.

Trained on at most ``TRAIN_ROWS`` labelled rows, chosen by a hash of the id
over all labelled training rows, half of each class as far as there are any,
weighted back to the classes' true shares; scored in one narrow pass.

Defined cases: null texts count as empty and are scored; labels other than 0
and 1 are ignored; with labels of one class or none the score is that class's
smoothed share or 0.5; documents labelled twice train once a label row; null
ids train nothing (they have no label); repeated rows come out as they came in.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import held_out, map_texts

TRAIN_ROWS = 6000
BUCKETS = 1 << 15
RANK = 8
BINS = 16
EPOCHS = 12
BATCH = 128
SEED = 7

STATS = ("log_chars", "log_words", "log_lines", "mean_word", "upper", "digit", "symbol", "distinct", "repeat",
         "caps_words", "symbol_ends", "lone_symbols", "line_words", "same_lines", "top_word", "short_words")


def features(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word buckets, their unit-length weights, structure statistics) of a whole text."""
    text = text or ""
    raw = text.encode()
    words = text.split()
    n, chars = max(1, len(words)), max(1, len(text))
    counts = Counter(words)
    lines = text.split("\n")
    nb = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    digit = int(nb[48:58].sum())
    symbol = int(nb[33:48].sum() + nb[58:65].sum() + nb[91:97].sum() + nb[123:127].sum())
    upper = int(nb[65:91].sum())
    caps = sum(k for w, k in counts.items() if len(w) > 1 and w.isupper())
    ends = sum(k for w, k in counts.items() if len(w) > 2 and not w[-1].isalnum() and not w[-2].isalnum())
    lone = sum(k for w, k in counts.items() if len(w) == 1 and not w.isalnum())
    short = sum(k for w, k in counts.items() if len(w) <= 3)
    again = sum(map(str.__eq__, words, words[1:]))
    stats = np.array([np.log1p(len(text)), np.log1p(len(words)), np.log1p(len(lines)), len(text) / n, upper / chars,
                      digit / chars, symbol / chars, len(counts) / n, again / n, caps / n, ends / n, lone / n,
                      len(words) / len(lines), 1 - len(set(lines)) / len(lines),
                      max(counts.values(), default=0) / n, short / n])
    where = np.fromiter((zlib.crc32(w.lower().encode()) % BUCKETS for w in counts), np.int64, len(counts))
    idx, inv = np.unique(where, return_inverse=True)
    val = np.sqrt(np.bincount(inv, weights=np.fromiter(counts.values(), np.float64, len(counts)), minlength=len(idx)))
    return idx, val / max(1e-9, np.linalg.norm(val)), stats


@dataclass
class Machine:
    """Bins of the statistics, bias, weights and low-rank vectors."""

    edges: np.ndarray
    bias: float
    weight: np.ndarray
    vectors: np.ndarray

    def row(self, idx: np.ndarray, val: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers and values: hashed words, then one bin of every statistic."""
        bins = (self.edges < stats[:, None]).sum(axis=1)
        own = BUCKETS + np.arange(len(STATS)) * (BINS + 1) + bins
        return np.concatenate((idx, own)), np.concatenate((val, np.full(len(STATS), 1 / np.sqrt(len(STATS)))))

    def logit(self, idx: np.ndarray, val: np.ndarray) -> float:
        vx = self.vectors[idx] * val[:, None]
        s = vx.sum(axis=0)
        return float(self.bias + self.weight[idx] @ val + 0.5 * (s @ s - (vx * vx).sum()))


def fit(rows: list[tuple[int, float, np.ndarray, np.ndarray, np.ndarray]]) -> Machine:
    """Train on (label, weight, idx, val, stats) rows: weighted logistic loss, Adagrad steps."""
    rng = np.random.default_rng(SEED)
    n = BUCKETS + len(STATS) * (BINS + 1)
    total = sum(r[1] for r in rows)
    share = (sum(r[1] for r in rows if r[0]) + 1) / (total + 2)
    m = Machine(np.zeros((len(STATS), BINS)), float(np.log(share / (1 - share))), np.zeros(n), np.zeros((n, RANK)))
    if len({r[0] for r in rows}) < 2:
        return m
    stats = np.array([r[4] for r in rows])
    m.edges = np.quantile(stats, np.linspace(0, 1, BINS + 2)[1:-1], axis=0).T.copy()
    m.vectors = rng.normal(0, 0.02, (n, RANK))
    xs = [m.row(*r[2:]) for r in rows]
    y = np.array([float(r[0]) for r in rows])
    w = np.array([r[1] for r in rows]) * len(rows) / total
    gw, gv, gb = np.full(n, 1e-4), np.full((n, RANK), 1e-4), 1e-4
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            lens = np.array([len(xs[i][0]) for i in pick])
            idx, val = np.concatenate([xs[i][0] for i in pick]), np.concatenate([xs[i][1] for i in pick])
            row, first = np.repeat(np.arange(len(pick)), lens), np.cumsum(lens) - lens
            vx = m.vectors[idx] * val[:, None]
            s = np.add.reduceat(vx, first)
            z = m.bias + np.add.reduceat(m.weight[idx] * val, first) + 0.5 * (
                (s * s).sum(axis=1) - np.add.reduceat((vx * vx).sum(axis=1), first))
            g = w[pick] * (1 / (1 + np.exp(-z)) - y[pick])
            u, inv = np.unique(idx, return_inverse=True)
            gx = (g[row] * val)
            dw = np.bincount(inv, weights=gx, minlength=len(u)) + 1e-4 * m.weight[u]
            dv = np.zeros((len(u), RANK))
            np.add.at(dv, inv, gx[:, None] * (s[row] - vx))
            dv += 1e-3 * m.vectors[u]
            gw[u] += dw * dw
            gv[u] += dv * dv
            gb += float(g.sum()) ** 2
            m.weight[u] -= 0.3 * dw / np.sqrt(gw[u])
            m.vectors[u] -= 0.05 * dv / np.sqrt(gv[u])
            m.bias -= 0.1 * float(g.sum()) / np.sqrt(gb)
    return m


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", train_rows: int = TRAIN_ROWS) -> Machine:
    """Fit on a bounded sample of the labelled rows outside the held-out third."""
    own = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
           .where(F.col("y").isin(0, 1) & F.col("id").isNotNull() & ~held_out("id")))
    counts = {r["y"]: r["n"] for r in own.groupBy("y").agg(F.count("*").alias("n")).collect()}
    span = 1 << 30
    keep = {y: min(span, span * (train_rows // 2) // n) for y, n in counts.items()}
    draw = F.pmod(F.xxhash64("id"), F.lit(span))
    # the hash keeps train_rows labels on average; twice that is the bound of what is broadcast
    picked = F.broadcast(own.where(draw < F.when(F.col("y") == 1, keep.get(1, 0)).otherwise(keep.get(0, 0)))
                         .limit(2 * train_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [features(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([np.asarray(g[k], t).tobytes() for g in got], pa.binary())
                                for k, t in enumerate(("<i4", "<f4", "<f8")))], ["y", "idx", "val", "stats"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    sample = map_texts(texts.join(picked, "id").select("y", "t"), run, "y int, idx binary, val binary, stats binary").collect()
    sample = sorted(tuple(r) for r in sample)  # the same order in every run
    seen = Counter(r[0] for r in sample)
    return fit([(y, counts[y] / seen[y], np.frombuffer(i, "<i4").astype(np.int64),
                 np.frombuffer(v, "<f4").astype(np.float64), np.frombuffer(s, "<f8")) for y, i, v, s in sample])


def _scores(model: Machine, column: pa.Array) -> np.ndarray:
    z = np.array([model.logit(*model.row(*features(t.as_py()))) for t in column], np.float64)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score(docs: DataFrame, model: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_scores(shared.value, b.column(1)))], ["doc_id", "score"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return (map_texts(src, run, "doc_id long, score double")
            .select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def good_rows(docs: DataFrame, model: Machine, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, unchanged, in one narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_scores(shared.value, b.column(at)) >= threshold))

    return map_texts(docs, run, docs.schema)
