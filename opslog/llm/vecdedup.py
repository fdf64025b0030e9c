"""Near-duplicate vectors by a forest of random-projection trees.

Every tree cuts space recursively: a node projects its vectors on a random
direction and splits them at the median; vectors near the cut spill over to
both sides. Vectors of one label that meet in a leaf of any tree are compared
with each other in double precision, and links at or above the threshold are
united into components.

Spill: unit vectors with cosine c are at most sqrt(2 - 2c) apart, which on a
random direction in d dimensions is a difference of standard deviation
sqrt(2 - 2c) / sqrt(d). A pair can only be parted by a cut if it differs by
more than the spill band, ``SPILL`` such deviations; over all trees the chance
that it never meets vanishes. A node whose band would hold over half of its
vectors (a dense cluster) is not cut.

Scale: cuts are fitted on a bounded sample (``SAMPLE`` distinct vectors) and
every vector is routed. Equal vectors of a label are one row with a count. A
leaf with more than ``BLOCK`` vectors of a label is compared in pairs of
blocks, so every task has at most two blocks, whatever the leaf, and no pair is
left out. Pairs are never rows: a leaf emits for each vector the copies it
links to, counting a pair only in the first leaf that both share, and the root
of its component within the leaf.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, null labels and null ids link with nothing; vectors of different
length do not link; repeated rows are one vector; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import connected_components, stored
from opslog.llm.vectors import matrix, packed

TREES = 4
SPILL = 2.5
SAMPLE = 20_000
LEAF = 2_000
MIN_NODE_SAMPLE = 64
BLOCK = 1_024
SEED = 11


@dataclass
class Tree:
    """Inner nodes as arrays; children are node numbers, leaves -(leaf + 1)."""

    direction: np.ndarray
    cut: np.ndarray
    children: np.ndarray

    def route(self, x: np.ndarray, band: float) -> list[tuple[int, np.ndarray]]:
        """(leaf, row numbers) for unit vectors, spilled rows in several leaves."""
        out, todo = [], [(0 if len(self.cut) else -1, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out.append((-node - 1, rows))
                continue
            p = x[rows] @ self.direction[node] - self.cut[node]
            todo.append((int(self.children[node][0]), rows[p <= band]))
            todo.append((int(self.children[node][1]), rows[p >= -band]))
        return [(leaf, rows) for leaf, rows in out if len(rows)]


def grow(x: np.ndarray, band: float, smallest: int, rng: np.random.Generator) -> Tree:
    """One tree over a sample of unit vectors."""
    directions, cuts, children = [], [], []
    leaf = 0

    def split(rows: np.ndarray):
        for _ in range(3):
            v = rng.normal(size=x.shape[1])
            v /= np.linalg.norm(v)
            p = x[rows] @ v
            cut = float(np.median(p))
            left, right = rows[p - cut <= band], rows[p - cut >= -band]
            if len(left) + len(right) <= 1.5 * len(rows):
                return v, cut, left, right
        return None

    todo = [(np.arange(len(x)), None)]
    while todo:
        rows, parent = todo.pop()
        found = split(rows) if len(rows) >= 2 * smallest else None
        if found is None:
            number, leaf = -(leaf + 1), leaf + 1
        else:
            v, cut, left, right = found
            number = len(cuts)
            directions.append(v)
            cuts.append(cut)
            children.append([0, 0])
            todo += [(left, (number, 0)), (right, (number, 1))]
        if parent:
            children[parent[0]][parent[1]] = number
    return Tree(np.array(directions).reshape(-1, x.shape[1]), np.array(cuts), np.array(children).reshape(-1, 2))


def unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)  # components near the ends of the range must not overflow
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


Forest = tuple[int, float, list[Tree]]  # vector length, band, trees


def fit_forests(classes: DataFrame, threshold: float, trees: int, sample: int, leaf: int, block: int) -> list[Forest]:
    """A forest for every vector length that more than ``block`` vectors have (fewer make one leaf of one block).

    All samples together hold about ``sample`` vectors, each length's by its share but at least
    ``MIN_NODE_SAMPLE``, and at most ``sample // MIN_NODE_SAMPLE`` lengths get one: the most common.
    """
    dims = classes.groupBy((F.length("vec") / 8).cast("int").alias("d")).agg(F.count("*").alias("n")).where(F.col("n") > block)
    rows = sorted(((r["n"], r["d"]) for r in dims.orderBy(F.desc("n"), "d").limit(max(1, sample // MIN_NODE_SAMPLE)).collect()),
                  reverse=True)
    total, span = sum(n for n, _ in rows), 1 << 30
    out = []
    for n, d in rows:
        own = max(MIN_NODE_SAMPLE, sample * n // total)
        part = classes.where((F.length("vec") == 8 * d) & (F.pmod(F.xxhash64("rep"), F.lit(span)) < min(span, span * own // n)))
        x = unit(matrix([bytes(r["vec"]) for r in part.select("rep", "vec").orderBy("rep").collect()] or [np.ones(d).tobytes()], d))
        band = float(SPILL * np.sqrt(max(0.0, 2 - 2 * threshold)) / np.sqrt(d) / 2)
        smallest = max(MIN_NODE_SAMPLE, int(leaf * len(x) / n) // 2)
        rng = np.random.default_rng(SEED)
        out.append((d, band, [grow(x, band, smallest, rng) for _ in range(trees)]))
    return out


def _routed(classes: DataFrame, forests: list[Forest], kind: str) -> DataFrame:
    """Adds codes: every (tree, leaf) of the vector as one rising number each, trees numbered over all
    lengths; the vectors of a length without a forest get one code.

    ``vec`` leaves as ``kind``: single precision where the source column is, since every leaf gets a copy.
    """
    shared = classes.sparkSession.sparkContext.broadcast(forests)
    names = classes.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(names.index("vec")).to_pylist()
            codes: list[list[int]] = [[-len(v)] for v in raw]
            before = 0
            for d, band, trees in shared.value:
                own = np.array([i for i, v in enumerate(raw) if len(v) == 8 * d], np.int64)
                if len(own):
                    x = unit(matrix([raw[i] for i in own], d))
                    for i in own:
                        codes[i] = []
                    for t, tree in enumerate(trees, before):
                        for leaf, rows in sorted(tree.route(x, band), key=lambda r: r[0]):
                            for i in own[rows]:
                                codes[i].append((t << 24) + leaf)
                before += len(trees)
            slim = pa.array([np.frombuffer(v, "<f8").astype(kind).tobytes() for v in raw], pa.binary())
            columns = [slim if name == "vec" else b.column(i) for i, name in enumerate(names)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(codes, pa.list_(pa.int64()))], [*names, "codes"])

    return classes.mapInArrow(run, "label string, vec binary, rep long, n long, codes array<long>")


def compare(group: pd.DataFrame, threshold: float, kind: str) -> pd.DataFrame:
    """Link counts and local roots of one leaf, or of one pair of its blocks."""
    code, low, high = int(group.code.iat[0]), int(group.low.iat[0]), int(group.high.iat[0])
    group = group.sort_values("rep", ignore_index=True)
    x = unit(np.frombuffer(b"".join(group.vec), kind).reshape(len(group), -1).astype(np.float64))
    link = x @ x.T >= threshold
    np.fill_diagonal(link, False)
    block = group.block.to_numpy()
    if low != high:
        link &= block[:, None] != block[None, :]
    i, j = np.nonzero(link)
    # a pair counts here unless both also share a leaf with a smaller code
    seen, sets = {}, group.codes.tolist()
    for codes in sets:
        for c in codes:
            if c < code:
                seen.setdefault(c, len(seen))
    first = np.ones(len(i), bool)
    if seen and len(i):
        member = np.zeros((len(group), len(seen)), np.float32)
        for k, codes in enumerate(sets):
            member[k, [seen[c] for c in codes if c < code]] = 1
        first = (member @ member.T)[i, j] == 0
    links = np.bincount(i[first], weights=group.n.to_numpy(np.float64)[j[first]], minlength=len(group)).astype(np.int64)
    root = np.arange(len(group))  # rows are in rising order of rep, so the smallest row is the smallest rep
    starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else np.zeros(0, np.int64)
    while len(i):
        new = root.copy()
        new[i[starts]] = np.minimum(root[i[starts]], np.minimum.reduceat(root[j], starts))
        new = new[new]
        if (new == root).all():
            break
        root = new
    reps = group.rep.to_numpy()
    out = pd.DataFrame({"rep": reps, "links": links, "root": reps[root]})
    return out[(out.links > 0) | (out.rep != out.root)]


def vector_groups(rows: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                  label_col: str = "label", trees: int = TREES, sample: int = SAMPLE, leaf: int = LEAF,
                  block: int = BLOCK) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept."""
    own = stored(packed(rows, id_col, vector_col, label_col), "vectors")
    part = own.where("vec is not null and label is not null and vec_id is not null")
    classes = (part.distinct().groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")))
    classes = stored(classes, "vector-classes")
    forests = fit_forests(classes, threshold, trees, sample, leaf, block)
    kind = "<f4" if rows.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8"
    routed = stored(_routed(classes, forests, kind), "vector-leaves")
    met = routed.select("label", F.explode("codes").alias("code"))
    sizes = (met.groupBy("label", "code").agg(F.count("*").alias("m")).where("m > 1")
             .select(F.col("label").alias("l"), F.col("code").alias("c"), F.ceil(F.col("m") / block).alias("blocks")))
    rows_in = routed.select("label", "rep", "n", "vec", "codes", F.explode("codes").alias("code"))
    rows_in = rows_in.join(sizes, (F.col("label") == F.col("l")) & (F.col("code") == F.col("c"))).drop("l", "c")
    rows_in = (rows_in.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
               .select("label", "rep", "n", "vec", "codes", "code", "block", F.least("block", "other").alias("low"),
                       F.greatest("block", "other").alias("high")))
    found = stored(rows_in.groupBy("label", "code", "low", "high").applyInPandas(
        lambda g: compare(g, threshold, kind), "rep long, links long, root long"), "vector-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("rep <> root").select(F.col("rep").alias("u"), F.col("root").alias("v")))
    done = (classes.join(links, "rep", "left").join(parts, F.col("rep") == F.col("node"), "left")
            .select(F.col("label").alias("l"), F.col("vec").alias("v"),
                    (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                    F.coalesce("component", "rep").alias("component_id")))
    out = own.join(stored(done, "vector-done"), (F.col("label") == F.col("l")) & (F.col("vec") == F.col("v")), "left")
    linked = F.col("vec_id").isNotNull()
    cid = F.when(linked, F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.when(linked, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
                      cid.alias("component_id"), (F.col("vec_id") == cid).alias("kept"))
